"""Near-duplicates by b-bit MinHash, confirmed on whole shingle sets.

One pass hashes the word shingles of each text into a set, takes the minima of 1024 hash
functions, groups the first 128 into bands (one 64-bit key each) and keeps the low two bits of
each minimum as two bit planes of 1024 bits. Two minima that differ still agree in two bits
with probability 1/4, so of a share m of agreeing places the similarity (m - 1/4) / (3/4) is
estimated, by counting bits.

1. Documents with the same set are one class, named by their smallest id.
2. In each band bucket every class is paired with a hub, the member that shares the most buckets with
   others: at most one pair for a class and band. Pairs whose estimate is hopeless go; the rest are
   confirmed on whole sets, and what is linked is joined into components. In a group of near copies the
   hub is one of the least edited texts, so that it is linked with most of the others.
3. Links that could still be missing run between components of one bucket: a member outside the hub's
   component against members of other components. Only those pairs are formed, if their estimate
   allows it, and confirmed. Copies and near copies are never expanded into all pairs. What can
   still grow with the square of a bucket are texts that are nearly as alike as the threshold
   and not linked.

No join broadcasts a side: all sides grow with the texts, and the band keys of a document, a row each, count
as one row in Spark's sizes.

Band width follows from the threshold: a pair just at it is missed by all bands with
probability below one in a million.

Defined results: a text that is null or without words has no shingles and is linked with
nothing; fewer words than a shingle make one shingle of all of them; a null id is carried
along, in the component of its class; a class without any id has a null component.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortgraph.llm.common import documents, guarded, keep, unsent
from cohortgraph.llm.components import components
from cohortgraph.llm.hashing import hashed_texts, mix, slices, texts_of

PLACES, BAND_PLACES = 1024, 128
MISS = 1e-6
#: Standard deviations that an estimate may lie below the threshold.
DOUBT = 5
SLICE_BYTES = 1 << 20


def band_width(percent: int) -> int:
    """Most minima in a band at which a pair at the threshold is all but surely found."""
    fits = [r for r in range(1, 9) if (1 - (percent / 100) ** r) ** (BAND_PLACES // r) < MISS]
    return max(fits, default=1)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each lower-cased text."""
    h, firsts = hashed_texts([t.lower() for t in texts])
    rolled = np.zeros(max(len(h) - k + 1, 0), np.uint64)
    for i in range(k):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(rolled)]
    rolled = mix(rolled)
    sets = []
    for start, end in zip(firsts[:-1], firsts[1:], strict=True):
        if end - start >= k:
            found = np.sort(rolled[start : end - k + 1])
            found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        else:
            whole = np.uint64(end - start)
            for x in h[start:end]:
                whole = np.uint64((int(whole) * 0x9E3779B97F4A7C15 + int(x)) % 2**64)
            found = mix(np.array([whole])) if end > start else h[:0]
        sets.append(found)
    return sets


def _functions(seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed)
    factors, terms = (draw.integers(0, 2**63, PLACES, np.uint64) * np.uint64(2) for _ in range(2))
    return factors + np.uint64(1), terms


def signatures(sets: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (sets x bands) and bit planes (sets x words of 64 bits) of non-empty ``sets``."""
    values = np.concatenate(sets)
    firsts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    minima = np.empty((PLACES, len(sets)), np.uint64)
    for i, (factor, term) in enumerate(zip(*_functions(), strict=True)):
        minima[i] = np.minimum.reduceat(values * factor + term, firsts)
    minima = mix(minima)
    bands = BAND_PLACES // width
    keys = np.arange(bands, dtype=np.uint64)[:, None] + np.zeros_like(minima[:bands])
    for j in range(width):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + minima[j : bands * width : width])
    low = np.stack([(minima >> np.uint64(b)) & np.uint64(1) for b in (0, 1)])  # bit, place, set
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    planes = (low.reshape(2, PLACES // 64, 64, -1) * weights[None, None, :, None]).sum(axis=2, dtype=np.uint64)
    return keys.T.view(np.int64), planes.reshape(len(PLANES), -1).T.view(np.int64)


HALF = PLACES // 64
PLANES = [f"_plane{i}" for i in range(2 * HALF)]


def signed(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Adds ``_size``, ``_digest``, ``_bands`` and the planes; drops ``text``."""
    width = band_width(percent)
    schema = T.StructType(
        [
            *docs.drop("text").schema.fields,
            T.StructField("_size", T.LongType()),
            T.StructField("_digest", T.BinaryType()),
            T.StructField("_bands", T.ArrayType(T.LongType())),
            *(T.StructField(name, T.LongType()) for name in PLANES),
        ]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            rest = batch.drop_columns(["text"])
            for start, end in slices(texts, SLICE_BYTES):
                sets = shingle_sets(texts[start:end], shingle)
                full = [i for i, s in enumerate(sets) if len(s)]
                bands, planes = np.zeros((len(sets), BAND_PLACES // width), np.int64), np.zeros((len(sets), len(PLANES)), np.int64)
                if full:
                    bands[full], planes[full] = signatures([sets[i] for i in full], width)
                ends = np.arange(len(sets) + 1, dtype=np.int32) * bands.shape[1]
                added = [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.ravel())),
                    *(pa.array(np.ascontiguousarray(planes[:, i])) for i in range(len(PLANES))),
                ]
                part = rest.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=schema.names)

    return docs.mapInArrow(sign, schema)


def sets_of(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, set) of docs (id, text)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for start, end in slices(texts, SLICE_BYTES):
                sets = shingle_sets(texts[start:end], shingle)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(start, end - start), pa.ListArray.from_arrays(pa.array(ends), values)],
                    names=["id", "set"],
                )

    return docs.select("id", "text").mapInArrow(gather, "id long, set array<bigint>")


def similar_enough(percent: int) -> Column:
    """Whether estimate and sizes of x and y leave the threshold possible."""
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    differ = sum(
        F.bit_count(
            x(PLANES[i]).bitwiseXOR(y(PLANES[i])).bitwiseOR(x(PLANES[i + HALF]).bitwiseXOR(y(PLANES[i + HALF])))
        )
        for i in range(HALF)
    )
    agree = percent / 100 * 0.75 + 0.25
    doubt = DOUBT * (agree * (1 - agree) / PLACES) ** 0.5
    sizes = 100 * F.least(x("_size"), y("_size")) >= percent * F.greatest(x("_size"), y("_size"))
    return sizes & (differ <= int(PLACES * (1 - agree + doubt)))


def whole_sets(ids: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(id, set), one row for each of ``ids``; ``docs`` has (id, text), where rows may be repeated."""
    return sets_of(docs.join(unsent(ids), "id", "left_semi"), shingle).groupBy("id").agg(F.min("set").alias("set"))


def confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose whole sets reach the threshold."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    sets = keep(whole_sets(ids, docs, shingle), "sets")
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("_left"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("_right"))
    shared = F.size(F.array_intersect("_left", "_right"))
    return (
        pairs.join(unsent(left), "a")
        .join(unsent(right), "b")
        .select("a", "b", shared.alias("n"), (F.size("_left") + F.size("_right")).alias("both"))
        .where(100 * F.col("n") >= percent * (F.col("both") - F.col("n")))
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (doc_id, text, more) without text, with ``_size`` and ``_component``.

    A class is known by its smallest id, so ids must tell different texts apart.
    """
    table = keep(signed(docs, shingle, percent), "signatures")
    known = table.where("_size > 0 AND doc_id IS NOT NULL")
    classes = keep(
        known.groupBy("_digest").agg(
            F.min(F.struct("doc_id", "_size", "_bands", *PLANES)).alias("s"),
        ).select("_digest", F.col("s.doc_id").alias("id"), "s._size", "s._bands", *(f"s.{p}" for p in PLANES)),
        "classes",
    )
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    signs = classes.select("id", "_size", "_bands", *PLANES)
    joined = _linked(classes.select("id", F.explode("_bands").alias("key")), signs, texts, shingle, percent)

    of_class = classes.select("_digest", "id").join(unsent(joined), "id", "left")
    of_class = of_class.select("_digest", F.coalesce("component", "id").alias("_component"))
    found = table.drop("_bands", *PLANES).join(unsent(of_class), "_digest", "left")
    alone = F.col("_size") == 0
    return found.withColumn("_component", F.when(alone, F.col("doc_id")).otherwise(F.col("_component"))).drop("_digest")


def _linked(members: DataFrame, signs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(id, component) of all ids with a link, out of their band keys ``members`` (id, key)."""
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = members.join(unsent(sizes), "key")
    fame = shared.groupBy("id").agg(F.struct(F.sum("n").alias("n"), (-F.col("id")).alias("of")).alias("fame"))
    famous = keep(shared.select("key", "id").join(unsent(fame), "id"), "members")
    hubs = famous.groupBy("key").agg((-F.max("fame").getField("of")).alias("hub"))
    held = keep(famous.select("key", "id").join(unsent(hubs), "key"), "members")

    to_hub = held.where("id != hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    x, y = signs.alias("x"), signs.alias("y")
    likely = to_hub.join(unsent(x), F.col("a") == F.col("x.id")).join(unsent(y), (F.col("b") == F.col("y.id")) & similar_enough(percent))
    tried = keep(likely.select("a", "b"), "pairs")
    links = keep(confirmed(tried, texts, shingle, percent), "links")
    joined = components(links)

    rows = held.join(unsent(joined), "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = keep(rows, "members")
    mixed = rows.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.max(F.when(F.col("id") == F.col("hub"), F.col("component"))).alias("main"),
    ).where("low != high").select("key", "main")
    rows = keep(rows.drop("hub").join(unsent(mixed), "key").join(unsent(signs), "id"), "mixed")
    x, y = rows.where("component != main").alias("x"), rows.alias("y")
    across = x.join(
        unsent(y),
        (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component"))
        & ((F.col("y.component") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))) & similar_enough(percent)
        # A pair comes out of the first of the buckets that it shares.
        & (F.col("x.key") == F.array_min(F.array_intersect("x._bands", "y._bands"))),
    )
    rest = across.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    rest = keep(rest.join(unsent(tried), ["a", "b"], "left_anti"), "pairs")
    if rest.isEmpty():
        return joined
    more = keep(confirmed(rest, texts, shingle, percent), "links")
    return joined if more.isEmpty() else components(links.unionByName(more))


@guarded
def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component and all texts without words, all columns unchanged.

    Of rows that share id and text the first by their other columns stays. Rows without an id can't be
    told apart; all of them stay.
    """
    found = near_duplicates(docs.select("doc_id", "text"))
    stays = found.where("_size = 0 OR doc_id = _component").select("doc_id").distinct()
    known = docs.join(unsent(stays), "doc_id", "left_semi")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    first = F.min(F.struct(*rest, "text")).alias("_first")
    known = known.groupBy("doc_id", F.xxhash64("text").alias("_of")).agg(first).select("doc_id", "_first.*")
    return known.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), shingle=3, percent=85)
    return found.select(
        "doc_id",
        F.col("_size").alias("n_shingles"),
        F.col("_component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("_component"), F.lit(False)).alias("kept"),
    )


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [ws]
                            ELSE list_distinct([ws[i : i + 2] FOR i IN range(1, len(ws) - 1)]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s AS a JOIN s AS b USING (g) GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
      WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM r GROUP BY a) USING (doc_id)"""
