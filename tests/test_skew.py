"""A third of the rows on one key: results stay whole and no task gets the whole group."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from cohortgraph.operators.geocode import attach_country
from cohortgraph.operators.shards import assign_shards
from cohortgraph.operators.survivors import drop_copies
from cohortgraph.plans import levels, worklist

# Tiny thresholds, and no merging of the tiny partitions.
SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "16",
}
N = 60_000


@pytest.fixture
def skewed(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key in SETTINGS:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture
def posts(skewed):
    """Every third post: id 0, author "hot", no location, mentioning "star"."""
    return skewed.range(0, N, numPartitions=8).selectExpr(
        "IF(id % 3 = 0, '0', CAST(id AS string)) AS tweet_id",
        "IF(id % 3 = 0, 'hot', CAST(id % 5000 AS string)) AS user_id",
        "IF(id % 3 = 0, NULL, 'Here') AS user_location",
        "array(IF(id % 3 = 0, CAST(id AS string), 'star')) AS tweet_mentioned_user_id",
        "id AS number",
    )


def final_plan(df):
    df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_a_prolific_author_is_split_against_the_marks(skewed, posts):
    unique = posts.withColumn("tweet_id", F.col("number").cast("string"))
    marks = skewed.range(5000).selectExpr("CAST(id AS string) AS user_id", "'30000' AS tweet_id")
    marks = marks.unionByName(skewed.sql("SELECT 'hot' AS user_id, '30000' AS tweet_id"))
    newer = worklist.newer_than_mark(unique, marks)
    assert "skew=true" in final_plan(newer)
    assert newer.count() == N - 30_001


def test_prolific_authors_and_celebrities_are_split_in_the_edges(skewed, posts, monkeypatch):
    monkeypatch.setattr(levels, "fits", lambda df: False)
    users = skewed.range(N).selectExpr("CAST(id AS string) AS user_id")
    users = users.unionByName(skewed.sql("SELECT 'hot' AS user_id UNION ALL SELECT 'star'")).withColumn("country_short", F.lit("XA"))
    edges = levels.country_edges(posts, users)
    assert final_plan(edges).count("skew=true") >= 2
    assert edges.count() == posts.selectExpr("user_id", "tweet_mentioned_user_id[0]").distinct().count()


def test_copies_reach_the_shuffle_once_per_task(posts):
    kept = drop_copies(posts, ["tweet_id"], [F.col("number")])
    assert kept.count() == posts.select("tweet_id").distinct().count()
    assert kept.where("tweet_id = '0'").first()["number"] == N - 3


def test_a_shared_location_is_spread(skewed, posts):
    places = skewed.sql("SELECT 'Here' AS user_location, 'XA' AS country_short")
    numbered = posts.withColumn("tweet_id", F.col("number").cast("string"))
    located = attach_country(numbered, places, broadcast_limit=0)
    sizes = [row["count"] for row in located.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == N and max(sizes) < N / 3
    assert located.where("country_short IS NULL").count() == N / 3


def test_a_single_country_is_not_numbered_in_one_task(skewed):
    users = skewed.range(N).selectExpr("CAST(id AS string) AS user_id", "'XA' AS country_short")
    shards = assign_shards(users, 7)
    sizes = [row["count"] for row in shards.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == N and max(sizes) < N / 4
    assert sorted(row["count"] for row in shards.groupBy("shard").count().collect()) == [8571] * 4 + [8572] * 3
