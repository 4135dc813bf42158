"""What is known of users and candidates, kept between pulls: a pull adds its part, nothing is recomputed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.functions.columns import numeric_id
from cohortgraph.operators.kept import N_BUCKETS, KeptTable


def _newest() -> Column:
    """Order of a user's posts, as in ``profiles.latest_posts``; a post without a time is never the newest."""
    order = F.struct(F.col("tweet_timestamp"), numeric_id("tweet_id").alias("n"), F.col("tweet_id"))
    return F.when(F.col("tweet_timestamp").isNotNull(), order)


def newest_posts(spark: SparkSession, path: str, n_buckets: int = N_BUCKETS) -> KeptTable:
    """Each pull's newest post and number of posts of every user it saw."""
    return KeptTable(spark, path, "user_id string, tweet_id string, tweet_timestamp long, tweet_count long", "user_id", n_buckets)


def add_posts(kept: KeptTable, pull: str, posts: DataFrame) -> None:
    """Adds the posts of a pull; only they are read. Combined map-side, so a prolific author is one row a task."""
    users = posts.where(F.col("user_id").isNotNull()).groupBy("user_id")
    row = F.struct("tweet_id", "tweet_timestamp")
    partial = users.agg(F.max_by(row, _newest()).alias("row"), F.count("tweet_id").alias("tweet_count"))
    kept.add(pull, partial.select("user_id", "row.*", "tweet_count"))


def latest_posts(kept: KeptTable) -> DataFrame:
    """(user_id, tweet_id, tweet_timestamp, tweet_count) over all pulls, without an exchange. Pulls do not share posts."""
    row = F.struct("tweet_id", "tweet_timestamp")
    users = kept.read().groupBy("user_id").agg(F.max_by(row, _newest()).alias("row"), F.sum("tweet_count").alias("tweet_count"))
    return users.where(F.col("row").isNotNull()).select("user_id", "row.*", "tweet_count")


def candidates(spark: SparkSession, path: str, n_buckets: int = N_BUCKETS) -> KeptTable:
    """Each pull's counts of who its posts interact with, by the author's country."""
    return KeptTable(spark, path, "user_id string, country_short string, n_users long", "user_id", n_buckets)


def merged_candidates(kept: KeptTable) -> DataFrame:
    """``snowball`` over all pulls: counts of interactions add up."""
    return kept.read().groupBy("user_id", "country_short").agg(F.sum("n_users").alias("n_users"))


def newer_than_kept(posts: DataFrame, kept: KeptTable) -> DataFrame:
    """Posts newer than their author's newest kept one; authors that no pull saw keep all."""
    marks = latest_posts(kept).select(F.col("user_id").alias("mark_user"), numeric_id("tweet_id").alias("mark"))
    seen = (F.col("user_id") == F.col("mark_user")) & (numeric_id(posts["tweet_id"]) <= F.col("mark"))
    return posts.join(marks, seen, "left_anti")


def remaining(batch: DataFrame, kept: KeptTable) -> DataFrame:
    """Rows of a batch whose user no kept pull saw."""
    return batch.join(kept.read().select("user_id"), "user_id", "left_anti")
