"""Document fingerprints: invertible Bloom lookup sketches of paragraph parts.

Each line of a text is hashed in runs of at most ``RUN`` words, so that a change inside a
long paragraph leaves the rest of it recognisable. A sketch has three sub-tables; each part
is added to one cell of each: its count, its digest and a check value of the digest, summed
modulo powers of two. The sketch of one version minus that of another holds only what
differs; cells of a single part are peeled off until all parts are recovered. If peeling
gets stuck, the pair is sketched again with four times the cells. The likeness of two texts
is the number of common parts over all parts of both. The fingerprint is the smallest sketch.

The edited text of a document takes its end from the next document in descending order of
ids. For that, documents are dealt out once into ranges of ids; the first document of each
range is also sent to the range before it, so no range waits for another.

Defined results: a null text is empty and has no parts; two texts without parts are alike
(1), one without and one with are not (0); equal ids are ordered by text, a null id last; a
single document is its own next; an empty table gives an empty table. Extra columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.llm.common import documents
from cohortgraph.llm.hashing import mix, word_hashes

RUN = 4
CELLS = 24
GROWTH = 4
HASHES = 3
SLICE_BYTES = 1 << 20


def parts(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct digests of the parts of each text."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    joined = b"\n".join(data)
    hashes, at = word_hashes(joined)
    breaks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 10)
    line = np.searchsorted(breaks, at)
    opens = np.concatenate([[True], line[1:] != line[:-1]]) if len(line) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(opens, np.arange(len(line)), 0)) if len(line) else line
    heads = np.flatnonzero((np.arange(len(line)) - first) % RUN == 0)
    ends = np.append(heads[1:], len(line))
    digest = np.zeros(len(heads), np.uint64)
    for i in range(RUN):
        live = heads + i < ends
        digest[live] = mix(digest[live] * np.uint64(0x9E3779B97F4A7C15) + hashes[heads[live] + i])
    edges = np.searchsorted(at[heads], np.cumsum([0, *(len(d) + 1 for d in data)]))
    return [np.unique(digest[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _check(keys: np.ndarray) -> np.ndarray:
    return mix(keys ^ np.uint64(0xA5A5A5A55A5A5A5A))


def _places(keys: np.ndarray, owner: np.ndarray, first: np.ndarray, width: np.ndarray) -> list[np.ndarray]:
    """Cell of each key in each sub-table of its owner's sketch, which starts at ``first``."""
    wide = width[owner]
    start = first[owner]
    return [
        start + i * wide + (mix(keys + np.uint64(2 * i + 1)) % wide.astype(np.uint64)).astype(np.int64) for i in range(HASHES)
    ]


class Sketches:
    """Sketches of several owners in shared arrays; ``width`` cells in each owner's sub-tables."""

    def __init__(self, width: np.ndarray):
        self.width = width
        self.first = np.concatenate([[0], np.cumsum(HASHES * width)])[:-1]
        total = int(HASHES * width.sum())
        self.count = np.zeros(total, np.int64)
        self.key, self.check = np.zeros(total, np.uint64), np.zeros(total, np.uint64)

    def add(self, keys: np.ndarray, owner: np.ndarray, sign: np.ndarray) -> list[np.ndarray]:
        """Adds or (sign -1) takes away; returns the cells."""
        unsigned = sign.astype(np.uint64)  # -1 wraps: products below are modulo 2^64
        signed_key, signed_check = keys * unsigned, _check(keys) * unsigned
        cells = _places(keys, owner, self.first, self.width)
        for place in cells:
            np.add.at(self.count, place, sign)
            np.add.at(self.key, place, signed_key)
            np.add.at(self.check, place, signed_check)
        return cells

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each owner: parts recovered with sign +1 and with -1, and whether nothing is left."""
        owners = len(self.width)
        plus, minus = np.zeros(owners, np.int64), np.zeros(owners, np.int64)
        touched = np.arange(len(self.count))
        owner_of = np.repeat(np.arange(owners), HASHES * self.width)
        while len(touched):
            single = touched[np.abs(self.count[touched]) == 1]
            sign = self.count[single]
            keys = self.key[single] * sign.astype(np.uint64)
            pure = self.check[single] * sign.astype(np.uint64) == _check(keys)
            single, sign, keys = single[pure], sign[pure], keys[pure]
            owner = owner_of[single]
            once = np.unique(np.stack([owner.astype(np.uint64), keys]), axis=1, return_index=True)[1] if len(keys) else []
            keys, owner, sign = keys[once], owner[once], sign[once]
            if not len(keys):
                break
            np.add.at(plus, owner[sign > 0], 1)
            np.add.at(minus, owner[sign < 0], 1)
            touched = np.unique(np.concatenate(self.add(keys, owner, -sign)))
        rest = (self.count != 0) | (self.key != 0)
        left = np.bincount(owner_of[rest], minlength=owners)
        return plus, minus, left == 0


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(s) for s in sets]
    keys = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return keys, np.repeat(np.arange(len(sets)), sizes)


def likeness(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Common parts over all parts, by subtracting sketches and peeling, larger until it succeeds."""
    sizes = np.array([(len(a), len(b)) for a, b in zip(left, right, strict=True)]).reshape(-1, 2)
    result = np.ones(len(left))
    live = np.flatnonzero(sizes.sum(axis=1))
    cells = CELLS
    while len(live):
        # A difference in size that outnumbers the cells can't be peeled; those pairs wait.
        now = live[np.abs(sizes[live, 0] - sizes[live, 1]) <= cells]
        sketch = Sketches(np.full(len(now), cells // HASHES))
        for sets, sign in ((left, 1), (right, -1)):
            keys, owner = _flat([sets[i] for i in now])
            sketch.add(keys, owner, np.full(len(keys), sign))
        plus, minus, done = sketch.peel()
        common = sizes[now, 0] - plus
        union = sizes[now].sum(axis=1) - common
        # A false peel is told by counts that don't add up.
        done &= (common == sizes[now, 1] - minus) & (common >= 0)
        result[now[done]] = common[done] / union[done]
        live = np.setdiff1d(live, now[done])
        cells *= GROWTH
    return result


def fingerprints(sets: list[np.ndarray]) -> list[str]:
    sketch = Sketches(np.full(len(sets), CELLS // HASHES))
    keys, owner = _flat(sets)
    sketch.add(keys, owner, np.ones(len(keys), np.int64))
    rows = np.zeros((len(sets), CELLS), np.dtype([("n", "u1"), ("k", "<u8"), ("c", "<u4")]))
    rows["n"] = (sketch.count % 256).reshape(rows.shape)
    rows["k"] = sketch.key.reshape(rows.shape)
    rows["c"] = (sketch.check >> np.uint64(32)).reshape(rows.shape)
    return [base64.b64encode(r.tobytes()).decode() for r in rows]


def in_ranges(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) dealt into ranges: (_range, _next, doc_id, text), each range in descending order.

    ``_next`` marks the document that follows the range's last. Driver: one number a range.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.array(sorted(set(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n))) if n > 1 else [])

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.where(ids.isna(), -1, np.searchsorted(bounds, ids.fillna(0), side="right")), dtype="int32")

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).withColumn("r", range_of("doc_id"))
    tops = sorted(ids.groupBy("r").agg(F.max("doc_id").alias("top")).collect())
    follows = {tops[i - 1].top: tops[i].r for i in range(len(tops))}
    if not follows:
        follows = {None: -1}
    nexts = F.broadcast(spark.createDataFrame([(k, v) for k, v in follows.items()], "top long, after int"))
    held = docs.join(nexts, docs["doc_id"].eqNullSafe(nexts["top"]), "left")
    own = F.struct(range_of(F.col("doc_id").cast("long")).alias("_range"), F.lit(False).alias("_next"))
    extra = F.struct(F.col("after").alias("_range"), F.lit(True).alias("_next"))
    both = F.when(F.col("after").isNull(), F.array(own)).otherwise(F.array(own, extra))
    rows = held.select(F.explode(both).alias("p"), "doc_id", F.coalesce("text", F.lit("")).alias("text")).select("p.*", "doc_id", "text")
    return rows.repartition(n, "_range").sortWithinPartitions("_range", "_next", F.desc_nulls_last("doc_id"), "text")


FIELDS = (
    "doc_id {}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double"
)


def fingerprinted(docs: DataFrame) -> DataFrame:
    schema = FIELDS.format(docs.schema["doc_id"].dataType.simpleString())
    names = [part.split()[0] for part in schema.split(", ")]

    def describe(ids: list, texts: list[str], kind: pa.DataType) -> pa.RecordBatch:
        """All but the last text, which is only the next of the one before it."""
        now, edited = texts[:-1], []
        for text, following in zip(now, texts[1:], strict=True):
            cut = len(text) // 3
            edited.append(text[: len(text) - cut] + following[:cut])
        found, changed = parts(texts), parts(edited)
        columns = [
            pa.array(ids[:-1], kind),
            pa.array([len(t) for t in now], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
            pa.array(fingerprints(found[:-1])),
            pa.array(fingerprints(changed)),
            pa.array(likeness(found[:-1], changed)),
            pa.array(likeness(found[:-1], found[1:])),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        ended, kind = False, None
        for batch in batches:
            kind = batch.column("doc_id").type
            rows = [batch.column(c).to_pylist() for c in ("_next", "doc_id", "text")]
            size = sum(map(len, texts))
            for is_next, doc_id, text in zip(*rows, strict=True):
                if ended and is_next:
                    continue  # of several rows with that id the first is the next
                if ended:
                    ids, texts, size, ended = [], [], 0, False
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if is_next or (size > SLICE_BYTES and len(texts) > 1):
                    yield describe(ids, texts, kind)
                    ids, texts, size, ended = ids[-1:], texts[-1:], len(text), is_next

    return in_ranges(docs.select("doc_id", "text")).mapInArrow(work, schema)


def op5_bloom_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(documents(spark, sf_dir))
