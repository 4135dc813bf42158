"""Shapes of physical plans: scans, shuffles, pushed filters, thinning before shuffles."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from cohortgraph import standin as given
from cohortgraph.operators.shards import assign_shards
from cohortgraph.operators.survivors import drop_copies
from cohortgraph.plans import batches, profiles, worklist
from cohortgraph.plans.snowball import snowball

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def shuffles(plan):
    return plan.count("Exchange hashpartitioning")


@pytest.fixture
def posts(spark, tmp_path):
    path = f"{tmp_path}/posts"
    given.profiled_posts(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def locations(spark, tmp_path):
    path = f"{tmp_path}/locations"
    given.locations(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def test_snowball_scans_posts_once(posts, locations):
    plan = plan_of(snowball(posts, locations))
    assert plan.count("FileScan") == 2 and "BroadcastHashJoin" in plan
    # One shuffle of counts, one of the location table; counts are partial before it.
    assert shuffles(plan) == 2 and "partial_count" in plan
    assert "user_description" not in plan and "user_name" not in plan


def test_newest_profile_is_one_aggregation(posts, locations):
    plan = plan_of(profiles.latest_posts(posts.select("user_id", "tweet_id", "tweet_timestamp")))
    assert shuffles(plan) == 1 and "Join" not in plan and "partial_max_by" in plan
    whole = plan_of(profiles.timeline_profiles(posts, locations))
    assert whole.count("FileScan") == 2 and "BroadcastHashJoin" in whole and shuffles(whole) == 2
    assert "tweet_mentioned_user_id" not in whole


def test_copies_are_thinned_before_the_shuffle(posts):
    plan = plan_of(drop_copies(posts, ["tweet_id"]))
    assert shuffles(plan) == 1
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_id_sets_take_one_shuffle(posts):
    ids = posts.select("user_id")
    plan = plan_of(batches.users_batch(ids, ids, ids))
    assert shuffles(plan) == 1 and "Join" not in plan


def test_timeline_batch_takes_one_shuffle(posts):
    table = posts.select("user_id", F.col("user_location").alias("country_short"), "tweet_id", "tweet_timestamp")
    plan = plan_of(batches.timeline_batch(table, table, table))
    assert shuffles(plan) == 1 and "Join" not in plan


def test_work_filters_reach_the_scan(spark, tmp_path, posts):
    table = posts.select(
        "user_id",
        F.col("user_location").alias("country_short"),
        "tweet_id",
        F.timestamp_seconds("tweet_timestamp").alias("tweet_timestamp"),
        F.lit(0).alias("is_seed"),
    )
    table.write.parquet(f"{tmp_path}/batch")
    filters = worklist.work_filters(["XA"], "update", min_timestamp="2024-01-01", drop_seeds=True)
    plan = plan_of(worklist.select_users(spark.read.parquet(f"{tmp_path}/batch"), filters), "formatted")
    pushed = plan[plan.index("PushedFilters") :]
    for part in ("EqualTo(country_short,XA)", "IsNotNull(tweet_id)", "GreaterThan(tweet_timestamp", "EqualTo(is_seed,0)"):
        assert part in pushed


def test_rows_are_not_shuffled_again_after_numbering(posts):
    table = posts.select("user_id", F.col("user_location").alias("country_short"))
    plan = plan_of(assign_shards(table, 3))
    left = plan[plan.index("Join") : plan.index("group_size", plan.index("Join"))]
    # The numbered rows: shuffled once, for the window. The rest belongs to the bucket counts.
    assert shuffles(left[: left.index("FileScan")]) == 1
