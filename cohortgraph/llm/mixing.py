"""Mixing sources to target weights: blocks, multinomial shards, index permutations.

The words of a source, its documents one after the other, are cut into blocks of a fixed
length (a thousandth of the source, at most ``BLOCK_WORDS``). A source's quota is the number
of blocks that meets its target. Output shards of ``SHARD_SLOTS`` slots draw their source
for each slot in proportion to the quotas, so a shard's counts are multinomial; running
totals over the shards number the slots of a source, and what exceeds its quota is left out.
A last shard holds what the draws have left over, so that totals are met exactly. Slot
number i takes block p(i mod n) in pass i div n, where p is a permutation of the n block
numbers that differs by source and pass; no block is taken more than twice.

Only DataFrame functions. Nothing is random: draws are hashes, so reruns and retried tasks
agree. Running totals are taken inside 4,096 hash buckets of a source and then over the
bucket sums, so a hot source is never sorted in one task. Only the table of sources (one row
each) is ordered as a whole.

Defined results: null and empty texts have size 0 and nothing is taken of them; a null source
is a source, the last in order; repeated rows count as separate documents; empty tables give
empty tables. Extra columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortgraph.llm.common import GAP_CLASS, WORD, content_key, documents, guarded, keep, let, unsent

WEIGHTS = (3, 1, 2)
#: All targets together in halves of all sizes, and the most of a source in times its size.
SHARE_HALVES = 3
MOST_TIMES = 2
BLOCK_WORDS = 256
BLOCKS_AT_LEAST = 1000
SHARD_SLOTS = 4096
BUCKETS = 4096
CELLS = 1024
#: Primes near 10^8: times a block number below 10^10 they stay below 2^63.
FACTORS = (99999989, 99999971, 99999959, 99999941, 99999931, 99999847, 99999839, 99999827, 99999821, 99999787)


def draw(*parts: Column) -> Column:
    """A pseudorandom number below 2^60 from the text of ``parts``."""
    text = F.concat_ws(":", *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def source_table(sized: DataFrame) -> DataFrame:
    """Per source: its number, size, target, block length, block count, quota and first place among all quotas."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sized.groupBy("source").agg(F.sum("_size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("sid") % len(WEIGHTS) + 1).cast("int")).cast("long")
    ranked = sources.withColumn("sid", F.row_number().over(ordered).cast("long") - 1).withColumn("weight", weight)
    # Water filling: in order of cap / weight, a source is capped while its share of the rest reaches its cap.
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")), "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    capped = (
        ranked.withColumn("cap", MOST_TIMES * F.col("source_size"))
        .withColumn("total2", SHARE_HALVES * F.sum("source_size").over(everything))
        .withColumn("left2", F.col("total2") - 2 * F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("capped", 2 * F.col("cap") * F.col("rest") <= F.col("left2") * F.col("weight"))
        .withColumn("spare2", F.col("total2") - 2 * F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything))
        .withColumn("weights", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything))
    )
    share = F.col("spare2") * F.col("weight") / (2.0 * F.col("weights"))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.col("source_size") / BLOCKS_AT_LEAST)))
    blocks = F.floor((F.col("source_size") + F.col("block") - 1) / F.col("block"))
    quota = F.floor(F.col("target") * F.col("blocks") / F.greatest(F.col("source_size"), F.lit(1)) + 0.5)
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    return (
        capped.withColumn("target", target)
        .withColumn("block", block)
        .withColumn("blocks", blocks)
        .withColumn("quota", F.least(quota, MOST_TIMES * F.col("blocks")))
        .withColumn("place", F.coalesce(F.sum("quota").over(upto), F.lit(0)))
        .select("source", "sid", "source_size", "target", "block", "blocks", "quota", "place")
    )


def placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``sized`` (_row, doc_id, source, _size) with its source's row and ``offset``, its first word in the source."""
    known = sized.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    known = known.select("d.*", *(f"s.{c}" for c in sources.columns if c != "source"))
    known = known.withColumn("bucket", draw(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % BUCKETS)
    before = Window.unboundedPreceding, -1
    sums = known.groupBy("sid", "bucket").agg(F.sum("_size").alias("n"))
    firsts = sums.select(
        "sid", "bucket", F.coalesce(F.sum("n").over(Window.partitionBy("sid").orderBy("bucket").rowsBetween(*before)), F.lit(0)).alias("first")
    )
    inside = Window.partitionBy("sid", "bucket").orderBy("doc_id", "_row").rowsBetween(*before)
    local = known.withColumn("local", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    return local.join(firsts, ["sid", "bucket"]).withColumn("offset", F.col("first") + F.col("local")).drop("first", "local", "bucket")


def permuted(number: Column, blocks: Column, sid: Column, turn: Column) -> Column:
    """Place of ``number`` in the permutation of ``blocks`` numbers for a source and pass: a prime times it, shifted."""
    usable = F.filter(F.array(*map(F.lit, FACTORS)), lambda p: blocks % p != 0)
    factor = let(usable, lambda p: F.element_at(p, (draw(F.lit("factor"), sid, turn) % F.size(p) + 1).cast("int")))
    return (factor * number + draw(F.lit("shift"), sid, turn) % blocks) % blocks


def shard_counts(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """(shard, sid, n): the multinomial draw of each shard."""
    total = sources.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    width = max(1, -(-total // CELLS))
    drawn = spark.range(total).select(
        F.floor(F.col("id") / SHARD_SLOTS).alias("shard"), (draw(F.lit("slot"), F.col("id")) % F.lit(max(total, 1))).alias("v")
    )
    cells = sources.where("quota > 0").select(
        "sid", "place", "quota",
        F.explode(F.sequence(F.floor(F.col("place") / width), F.floor((F.col("place") + F.col("quota") - 1) / width))).alias("cell"),
    )
    hit = (F.col("v") >= F.col("place")) & (F.col("v") < F.col("place") + F.col("quota"))
    found = drawn.withColumn("cell", F.floor(F.col("v") / width)).join(cells, "cell").where(hit)
    return found.groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n"))


def slots(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """(shard, sid, turn, block_no): which block each slot of the mix takes; shard -1 is the last one."""
    counts = shard_counts(spark, sources)
    upto = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.withColumn("first", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    got = counts.groupBy("sid").agg(F.sum("n").alias("got"))
    ends = sources.join(got, "sid", "left").select(
        F.lit(-1).cast("long").alias("shard"), "sid", "blocks", F.coalesce("got", F.lit(0)).alias("first"), F.col("quota").alias("end")
    )
    runs = runs.join(sources.select("sid", "blocks", "quota"), "sid").select(
        "shard", "sid", "blocks", "first", F.least(F.col("first") + F.col("n"), F.col("quota")).alias("end")
    )
    every = runs.unionByName(ends).where("first < end")
    numbered = every.select("shard", "sid", "blocks", F.explode(F.sequence("first", F.col("end") - 1)).alias("i"))
    turn = F.floor(F.col("i") / F.col("blocks"))
    return numbered.select(
        "shard", "sid", turn.alias("turn"), permuted(F.col("i") % F.col("blocks"), F.col("blocks"), F.col("sid"), turn).alias("block_no")
    )


def taken_parts(spark: SparkSession, sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Placed documents, and (_row, turn, shard, start, end): word spans of documents that slots take."""
    sources = keep(source_table(sized), "sources")
    docs = keep(placed(sized, sources), "placed")
    last = F.col("offset") + F.col("_size")
    held = docs.where("_size > 0").select(
        "_row", "sid", "offset", "_size", "block",
        F.explode(F.sequence(F.floor(F.col("offset") / F.col("block")), F.floor((last - 1) / F.col("block")))).alias("block_no"),
    )
    begin = F.col("block_no") * F.col("block")
    parts = held.join(unsent(slots(spark, sources)), ["sid", "block_no"]).select(
        "_row", "turn", "shard",
        (F.greatest(F.col("offset"), begin) - F.col("offset")).alias("start"),
        (F.least(last, begin + F.col("block")) - F.col("offset")).alias("end"),
    )
    return docs, parts


def sizes(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_size", F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long"))


def mixed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: a row for each pass that takes a part of a document, with the text of those parts.

    A document that a pass takes whole keeps its text as it is; of others the spans' words
    stay, with the white space before them. ``n_chars`` counts what is left.
    """
    # Repeated rows are alike, so it does not matter which of them is the first, second, ...
    copies = Window.partitionBy("doc_id", "_key").orderBy(F.lit(0))
    keyed = docs.withColumn("_key", content_key())
    narrow = sizes(keyed).select("doc_id", "source", "_size", "_key")
    row = F.struct(F.col("doc_id").alias("id"), F.col("_key").alias("key"), F.row_number().over(copies).alias("copy"))
    _, parts = taken_parts(spark, keep(narrow.select(row.alias("_row"), "doc_id", "source", "_size"), "sized"))
    numbered = sizes(keyed).withColumn("_row", row)
    spans = parts.groupBy("_row", "turn").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"), F.sum(F.col("end") - F.col("start")).alias("_taken")
    )
    pieces = F.regexp_extract_all("text", F.lit(rf"{GAP_CLASS}*{WORD}"), F.lit(0))
    cut = let(
        pieces,
        lambda p: F.array_join(
            F.transform(F.col("_spans"), lambda s: F.array_join(F.slice(p, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), "")), ""
        ),
    )
    text = F.when(F.col("_taken") == F.col("_size"), F.col("text")).otherwise(cut)
    found = numbered.join(spans, "_row").withColumn("text", text)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@guarded
def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(spark, docs)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    sized = keep(sizes(docs.withColumn("_row", F.monotonically_increasing_id())).drop("text"), "sized")
    placed_docs, parts = taken_parts(spark, sized)
    sums = parts.groupBy("_row").agg(F.sum(F.col("end") - F.col("start")).alias("taken"))
    return placed_docs.join(sums, "_row", "left").select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def _draw_sql(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


OP8_SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM d GROUP BY source),
s1 AS (SELECT *, [{", ".join(map(str, WEIGHTS))}][sid % {len(WEIGHTS)} + 1] AS weight, {MOST_TIMES} * source_size AS cap,
         {SHARE_HALVES} * sum(source_size) OVER () AS total2 FROM s0),
s2 AS (SELECT *, total2 - 2 * coalesce(sum(cap) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left2,
         sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
       FROM s1 WINDOW r AS (ORDER BY cap / weight, sid)),
s3 AS (SELECT *, 2 * cap * rest <= left2 * weight AS capped FROM s2),
s4 AS (SELECT *, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE
         CAST((total2 - 2 * coalesce(sum(cap) FILTER (capped) OVER (), 0)) * weight AS DOUBLE) / (2.0::DOUBLE * coalesce(sum(weight) FILTER (NOT capped) OVER (), 0))
         END AS target, greatest(1, least({BLOCK_WORDS}, source_size // {BLOCKS_AT_LEAST})) AS block FROM s3),
s5 AS (SELECT *, (source_size + block - 1) // block AS blocks FROM s4),
s AS (SELECT *, least(CAST(floor(target * blocks / greatest(source_size, 1) + 0.5) AS BIGINT), {MOST_TIMES} * blocks) AS quota FROM s5),
o AS (SELECT d.*, s.* EXCLUDE (source), CAST(coalesce(sum(size) OVER (PARTITION BY sid
          ORDER BY {_draw_sql("CAST(doc_id AS VARCHAR)")} % {BUCKETS}, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
b AS (SELECT doc_id, sid, off, size, block, unnest(range(off // block, (off + size - 1) // block + 1)) AS no FROM o WHERE size > 0),
i AS (SELECT sid, blocks, unnest(range(0, quota)) AS i FROM s),
f AS (SELECT sid, blocks, i % blocks AS k, i // blocks AS turn, [p FOR p IN {list(FACTORS)} IF blocks % p <> 0] AS ps FROM i),
t AS (SELECT sid, (ps[{_draw_sql("'factor:' || sid || ':' || turn")} % len(ps) + 1] * k
             + {_draw_sql("'shift:' || sid || ':' || turn")} % blocks) % blocks AS no FROM f),
g AS (SELECT doc_id, sum(least(off + size, (no + 1) * block) - greatest(off, no * block)) AS taken FROM b JOIN t USING (sid, no) GROUP BY doc_id)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM o LEFT JOIN g USING (doc_id)"""
