"""Set algebra on ids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_minus(wanted: Sequence[DataFrame], known: Sequence[DataFrame], *key: str) -> DataFrame:
    """Distinct keys (``user_id`` unless named) of any ``wanted`` table that are in no ``known`` table.

    One aggregation over all tables instead of an outer join, an anti join and a
    distinct: a single shuffle of ids that map tasks have already combined. As with
    an anti join, a key with a null never counts as known.
    """
    key = key or ("user_id",)
    tagged = [df.select(*key, F.lit(False).alias("is_known")) for df in wanted]
    tagged += [df.dropna(subset=list(key)).select(*key, F.lit(True).alias("is_known")) for df in known]
    ids = reduce(DataFrame.unionByName, tagged).groupBy(*key).agg(F.bool_or("is_known").alias("is_known"))
    return ids.where(~F.col("is_known")).select(*key)
