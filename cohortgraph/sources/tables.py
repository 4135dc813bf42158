"""Parquet tables, friend-list files and id lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.sources.landing import Paths, _paths


def read_table(spark: SparkSession, path: Paths, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet table, narrowed to ``columns``."""
    df = spark.read.parquet(*_paths(path))
    return df.select(*columns) if columns else df


def read_friend_lists(spark: SparkSession, paths: Paths) -> DataFrame:
    """(user_id, friend_ids) of files that each hold one JSON object, user → friend ids.

    The keys are users, so a file is parsed whole, as a map; files are a thousand users
    each. A user in two files gives two rows. A file that does not parse stops the job:
    taken for an empty one, its users would be listed again.
    """
    return explode_friend_map(read_friend_maps(spark, paths))


def read_friend_maps(spark: SparkSession, paths: Paths) -> DataFrame:
    """One map column ``friends``, a row for each file."""
    friend_map = F.from_json("value", "map<string,array<string>>", {"mode": "FAILFAST"})
    return spark.read.text(_paths(paths), wholetext=True).select(friend_map.alias("friends"))


def explode_friend_map(maps: DataFrame, column: str = "friends") -> DataFrame:
    """(user_id, friend_ids) rows of a map column."""
    return maps.select(F.explode(column).alias("user_id", "friend_ids"))


def friend_map_users(maps: DataFrame, column: str = "friends") -> DataFrame:
    """Users that are keys of a map column, without their lists."""
    return maps.select(F.explode(F.map_keys(column)).alias("user_id"))


def read_ids_csv(spark: SparkSession, path: Paths, name: str = "user_id") -> DataFrame:
    """One id column with a header of any name; ids stay text."""
    return spark.read.schema(f"{name} string").option("header", True).option("enforceSchema", True).csv(_paths(path))
