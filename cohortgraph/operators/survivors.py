"""One row per key, chosen by a stated order.

Both forms thin the rows map-side: every map task sends at most one row per key, so a
key holding any share of the input (copies, a hot author) costs no more than another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_greatest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Per key, the row with the greatest ``order``, nulls lowest. Columns keep their order.

    Spark plans the first row number as a group limit, before and after the shuffle.
    """
    ranked = Window.partitionBy(*keys).orderBy(*[column.desc_nulls_last() for column in order])
    rank = "_rank"
    while rank in df.columns:
        rank += "_"
    return df.withColumn(rank, F.row_number().over(ranked)).where(F.col(rank) == 1).drop(rank)


def drop_copies(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """De-duplicate on ``keys``: greatest ``order`` first, then a hash of the whole row,
    so the survivor does not depend on task timing."""
    return keep_greatest(df, keys, [*order, F.xxhash64(*df.columns)])


def greatest_and_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], where: Column, totals: Sequence[Column]
) -> DataFrame:
    """As ``keep_greatest`` among the rows passing ``where``, plus aggregates over all rows
    of the key, in one aggregation. A key without a row to choose is left out."""
    values = [name for name in df.columns if name not in keys]
    rank = F.when(where, F.struct(*[column.alias(f"o{i}") for i, column in enumerate(order)]))
    grouped = df.groupBy(*keys).agg(F.max_by(F.struct(*values), rank).alias("_best"), *totals)
    chosen = grouped.where(F.col("_best").isNotNull())
    return chosen.select(*keys, "_best.*", *grouped.columns[len(keys) + 1 :])
