"""Splitting a work list into shards and request-sized chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortgraph.session import materialize

# Hex digits of the md5 that name a bucket: 16**3 buckets per group.
BUCKET_DIGITS = 3
# Rows of a table of buckets that may be broadcast: about 32 MB.
MAX_BUCKETS = 1 << 18


def shuffle_hash(key: str, seed: int) -> Column:
    """Seeded pseudo-random order of ids, the same in every engine."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed))))


def exact_positions(df: DataFrame, key: str, by: Sequence[str], seed: int) -> DataFrame:
    """Add ``position`` (from 0) in the seeded shuffle of each group, and ``group_size``.

    A window over the group would sort it in one task. The md5 spreads any group
    evenly over 4,096 buckets instead: rows are numbered inside their bucket, and
    bucket counts (at most 4,096 small rows per group) give each bucket its offset.
    """
    # A struct is never null and its null fields are equal, so the null group is joined as
    # any other and the rows keep the partitioning of the window. The constant stands for
    # an empty ``by``.
    hashed = df.withColumns(
        {"_hash": shuffle_hash(key, seed), "_group": F.struct(F.lit(0), *by)}
    ).withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))
    counts = hashed.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy("_group")
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_group",
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(group).alias("group_size"),
    )
    row = F.row_number().over(Window.partitionBy("_group", "_bucket").orderBy("_hash", key))
    return (
        hashed.withColumn("_row", row)
        .join(offsets, ["_group", "_bucket"])
        .select(*df.columns, (F.col("_offset") + F.col("_row") - 1).alias("position"), "group_size")
    )


def assign_shards(
    df: DataFrame, n_shards: int, by: Sequence[str] = ("country_short",), key: str = "user_id", seed: int = 0
) -> DataFrame:
    """Seeded shuffle of each group (``by=()``: of all rows), cut into ``n_shards`` runs whose sizes differ by at
    most one, the longer ones first. Adds ``shard`` and ``shard_position`` (from 0)."""
    shard, shard_position = _cut(F.col("position"), F.col("group_size"), n_shards)
    return exact_positions(df, key, by, seed).select(*df.columns, shard.alias("shard"), shard_position.alias("shard_position"))


def _cut(position: Column, size: Column, n_shards: int) -> tuple[Column, Column]:
    """Shard of a position, and the place in it."""
    short = F.floor(size / F.lit(n_shards))
    n_long = size % F.lit(n_shards)
    in_long = n_long * (short + 1)
    is_long = position < in_long
    # With fewer rows than shards every row is in a long run, so ``short`` is never divided by.
    beyond, width = position - in_long, F.greatest(short, F.lit(1))
    shard = F.when(is_long, F.floor(position / (short + 1))).otherwise(n_long + F.floor(beyond / width))
    place = F.when(is_long, position % (short + 1)).otherwise(beyond % width)
    return shard.cast("int"), place.cast("long")


def cut_shards(
    df: DataFrame,
    n_shards: int,
    by: Sequence[str] = ("country_short",),
    key: str = "user_id",
    seed: int = 0,
    max_buckets: int = MAX_BUCKETS,
) -> DataFrame:
    """The ``shard`` of ``assign_shards``, without moving the rows; ids are unique in a group.

    A shard is a range of the seeded order, so it is known from its cuts. Rows are counted by bucket
    of the hash (partial counts, a few thousand for a group); a bucket that lies inside one shard
    needs no more. Only the buckets that a cut goes through, at most one for each cut, have their
    rows ordered, to find the first row after the cut. The rows themselves then meet a broadcast
    table of buckets, whose size is bounded: with many groups the buckets are made wider. Copies
    of an id stay in one shard.
    """
    hashed = df.withColumns({"_hash": shuffle_hash(key, seed), "_group": F.struct(F.lit(0), *by), "_id": F.col(key).cast("string")})
    counted = hashed.groupBy("_group", F.substring("_hash", 1, BUCKET_DIGITS).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    counted = materialize(counted, "buckets")
    digits = BUCKET_DIGITS
    while (small := counted.limit(max_buckets + 1).count() <= max_buckets) is False and digits > 1:
        digits -= 1
        counted = materialize(counted.groupBy("_group", F.substring("_bucket", 1, digits).alias("_bucket")).agg(F.sum("_n").alias("_n")), "buckets")
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, digits))
    group = Window.partitionBy("_group")
    first = F.sum("_n").over(group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    spans = counted.select("*", first.alias("_first"), F.sum("_n").over(group).alias("_size"))
    spans = spans.withColumn("_low", _cut(F.col("_first"), F.col("_size"), n_shards)[0])
    spans = spans.withColumn("_high", _cut(F.col("_first") + F.col("_n") - 1, F.col("_size"), n_shards)[0])
    known = F.broadcast if small else lambda table: table
    mixed = spans.where("_low < _high").select("_group", "_bucket", "_first", "_size")
    inside = hashed.select("_group", "_bucket", "_hash", "_id").join(known(mixed), ["_group", "_bucket"])
    row = F.row_number().over(Window.partitionBy("_group", "_bucket").orderBy("_hash", "_id"))
    shard, place = _cut(F.col("_first") + F.col("_row") - 1, F.col("_size"), n_shards)
    starts = inside.withColumn("_row", row).where((place == 0) & (F.col("_row") > 1))
    cuts = starts.groupBy("_group", "_bucket").agg(F.array_sort(F.collect_list(F.struct("_hash", "_id"))).alias("_cuts"))
    table = materialize(spans.select("_group", "_bucket", "_low").join(cuts, ["_group", "_bucket"], "left"), "cuts")
    passed = F.size(F.filter("_cuts", lambda cut: cut <= F.struct("_hash", "_id")))
    found = F.col("_low") + F.when(F.col("_cuts").isNull(), 0).otherwise(passed)
    return hashed.join(known(table), ["_group", "_bucket"]).select(*df.columns, found.cast("int").alias("shard"))


def hash_shards(df: DataFrame, n_shards: int, key: str = "user_id", seed: int = 0) -> DataFrame:
    """Shards by hash of the id: no shuffle and stable when the list grows, with sizes
    equal only on average."""
    number = F.conv(F.substring(shuffle_hash(key, seed), 1, 15), 16, 10).cast("long")
    return df.withColumn("shard", (number % n_shards).cast("int"))


def chunk_ids(
    sharded: DataFrame,
    size: int = 100,
    by: Sequence[str] = ("country_short", "shard"),
    key: str = "user_id",
    seed: int = 0,
) -> DataFrame:
    """Requests of at most ``size`` ids: (by…, ``chunk``, ``ids``, ``n_ids``), in shard order.

    Positions from ``assign_shards`` are used when there; other shards are numbered first.
    """
    if "shard_position" not in sharded.columns:
        sharded = exact_positions(sharded, key, by, seed).withColumnRenamed("position", "shard_position")
    chunk = F.floor(F.col("shard_position") / F.lit(size)).cast("int").alias("chunk")
    rows = F.sort_array(F.collect_list(F.struct("shard_position", key)))
    return (
        sharded.groupBy(*by, chunk)
        .agg(rows.alias("rows"))
        .select(*by, "chunk", F.col(f"rows.{key}").alias("ids"), F.size("rows").alias("n_ids"))
    )
