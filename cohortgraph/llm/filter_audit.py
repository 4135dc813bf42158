"""Interaction of quality filters: what each removes at each place of every order, and its Shapley value.

A document's failures are one bit a filter, so a part of the corpus is at most ``2^n`` counts.
The states of a chain of filters are the subsets already applied, its edges "apply f in state S",
and an order is a path from the empty to the full set. Forward counting gives the number of orders
that reach a state, backward counting those that lead on from it; their product over an edge is the
number of orders that take it. An edge removes the documents that fail f and nothing of S. The
Shapley value of f (times ``n!``) is the sum of its edges' removals, each weighted by its orders,
and the steps of a single order are read from the same edges.

One pass over the texts measures and hashes them; everything after it moves a few bytes a
document. A text's copies are reduced to their smallest id before the shuffle, and the way back is
a join on (digest, id), so a text that a third of the table shares is no hot key.

Defined results: a null text is an empty one; a null lang is the part of the empty string; a text
without words fails A alone, and E if a smaller id has it; rows without an id never fail E, make
no other row fail it and have no labels; of repeated rows of one id none is smaller than another;
a label counts if any row of ``labels`` for the id has it; an empty table gives no rows. Extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.llm.common import documents, keep
from cohortgraph.llm.hashing import texts_of

NAMES = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
#: The characters that C counts and that D forbids.
CAPITALS, FORBIDDEN = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
#: What is counted of the documents: all, those labelled good, those labelled toxic.
COUNTED = ("n", "good", "toxic")


def text_failures(data: bytes, n_chars: int) -> int:
    """Bits of A, B, C and D; words end at ASCII white space, as ``bytes.split`` has it."""
    words = data.split()
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT * len(words)) << 1
        | (100 * (len(data) - len(data.translate(None, CAPITALS))) > MAX_CAPITALS * n_chars) << 2
        | (len(data) != len(data.translate(None, FORBIDDEN))) << 3
    )


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask) of docs (doc_id, text, lang)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
            masks, digests = [], []
            for data, n in zip(texts_of(batch.column("text")), lengths, strict=True):
                masks.append(text_failures(data, n))
                digests.append(hashlib.blake2b(data, digest_size=16).digest())
            added = [pa.array(digests, pa.binary()), pa.array(masks, pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), *added], names=names)

    names = ["doc_id", "part", "digest", "mask"]
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("part"), "text")
    return docs.mapInArrow(measure, "doc_id long, part string, digest binary, mask int")


def with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """Sets ``bit`` in the mask of rows whose digest a smaller id has too; drops ``digest``."""
    lows = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("_low"))
    lows = lows.select(F.col("digest").alias("_of"), "_low")
    first = (F.col("digest") == F.col("_of")) & (F.col("doc_id") == F.col("_low"))
    copy = F.col("_low").isNull() & F.col("doc_id").isNotNull()
    return (
        rows.join(lows, first, "left")
        .withColumn("mask", F.col("mask") + F.when(copy, 1 << bit).otherwise(0))
        .drop("digest", "_of", "_low")
    )


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``good`` and ``toxic`` (0 or 1); rows without an id go round the join."""
    of_id = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    known = rows.where("doc_id IS NOT NULL").join(of_id, "doc_id", "left").fillna(0, ["good", "toxic"])
    return known.unionByName(rows.where("doc_id IS NULL").withColumns({"good": F.lit(0), "toxic": F.lit(0)}))


def _counted(states: Sequence[int], neighbours: Callable[[int], list[int]]) -> dict[int, int]:
    """Paths to each state from those before it, the first state being one path."""
    paths = {states[0]: 1}
    for state in states[1:]:
        paths[state] = sum(paths[s] for s in neighbours(state))
    return paths


def lattice(n: int) -> list[tuple[int, int, int]]:
    """(state, filter bit, orders through the edge) of every edge of the lattice of ``n`` filters."""
    bits = [1 << i for i in range(n)]
    upwards = sorted(range(1 << n), key=int.bit_count)
    forward = _counted(upwards, lambda s: [s ^ b for b in bits if s & b])
    backward = _counted(upwards[::-1], lambda s: [s | b for b in bits if not s & b])
    return [(s, b, forward[s] * backward[s | b]) for s in upwards for b in bits if not s & b]


def order_steps(names: str) -> list[tuple[str, int, int, int]]:
    """(order, step, state before it, filter bit) of every order of ``names``."""
    steps = []
    for order in permutations(range(len(names))):
        text, state = "".join(names[i] for i in order), 0
        for step, i in enumerate(order, 1):
            steps.append((text, step, state, 1 << i))
            state |= 1 << i
    return steps


def edge_counts(patterns: DataFrame, n: int) -> DataFrame:
    """Counts on every edge of every part, out of ``patterns`` (part, mask, n, good, toxic)."""
    edges = F.array(*(F.struct(F.lit(s).alias("state"), F.lit(b).alias("bit"), F.lit(w).alias("paths")) for s, b, w in lattice(n)))
    at = patterns.select("part", "mask", *COUNTED, F.explode(edges).alias("e")).select("*", "e.*")
    fails, earlier = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("state")) != 0
    total = lambda condition, column: F.sum(F.when(condition, F.col(column)).otherwise(0)).cast("long")
    counts = at.groupBy("part", "state", "bit", "paths").agg(
        total(~fails & ~earlier, "n").alias("kept"),
        total(fails & ~earlier, "n").alias("removed"),
        total(fails & earlier, "n").alias("redundant"),
        total(F.col("mask") == F.col("bit"), "n").alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"),
        total(fails & ~earlier, "toxic").alias("toxic_lost"),
    )
    shapley = counts.groupBy("part", "bit").agg(F.sum(F.col("paths") * F.col("removed")).alias("shapley"))
    return counts.join(shapley, ["part", "bit"])


def audit(rows: DataFrame, names: str) -> DataFrame:
    """One row for each part, order of ``names`` and step, of rows (part, mask, good, toxic).

    Bit i of ``mask`` says that a row fails the filter of ``names[i]``. The steps of all orders
    are a table of ``n * n!`` rows, whatever the corpus, so they are broadcast.
    """
    patterns = rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    edges = edge_counts(keep(patterns, "patterns"), len(names))
    steps = rows.sparkSession.createDataFrame(order_steps(names), "filter_order string, step int, state int, bit int")
    return edges.join(F.broadcast(steps), ["state", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keep(measured(documents(spark, sf_dir)), "measured")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return audit(labelled(with_copies(rows, NAMES.index("E")), labels), NAMES)


OP12_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low FROM documents),
q AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN low < doc_id THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN q USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(letter, bit)),
o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM f AS a, f AS b, f AS c, f AS d, f AS e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
      AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (SELECT filter_order, step, bits[step] AS bit, list_sum(list_concat([0], bits[1 : step - 1])) AS before
      FROM o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
r AS (
  SELECT part, filter_order, step, any_value(bit) AS bit,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, (SELECT filter_order, step, CAST(bit AS INTEGER) AS bit, CAST(before AS INTEGER) AS before FROM s)
  GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r"""
