"""State kept between pulls: equal to a recomputation, added once, merged and joined where it lies."""

import random

import pytest
from pyspark.sql import functions as F

from cohortgraph.operators.kept import KeptTable
from cohortgraph.plans import profiles, state, worklist

POSTS = "tweet_id string, tweet_timestamp long, user_id string"


@pytest.fixture
def posts(rows):
    draw = random.Random(7)
    values = [(str(i), draw.choice([None, *range(40)]), draw.choice([None, "hot", "hot", *map(str, range(30))])) for i in range(400)]
    return rows(POSTS, *values)


def pulls(posts):
    return [posts.where(F.col("tweet_id").cast("long") % 3 == part) for part in range(3)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pulls_add_up_to_a_recomputation(spark, tmp_path, posts, bag):
    kept = state.newest_posts(spark, f"{tmp_path}/newest", n_buckets=4)
    for number, pull in enumerate(pulls(posts)):
        state.add_posts(kept, f"p{number}", pull)
    whole = profiles.latest_posts(posts).select("user_id", "tweet_id", "tweet_timestamp", "tweet_count")
    assert bag(state.latest_posts(kept)) == bag(whole)
    # A repeated job replaces its pull.
    state.add_posts(kept, "p1", pulls(posts)[1])
    assert bag(state.latest_posts(kept)) == bag(whole)
    assert kept.read().groupBy("pull", "user_id").count().where("count > 1").count() == 0


def test_merging_and_joining_need_no_exchange(spark, tmp_path, posts):
    newest = state.newest_posts(spark, f"{tmp_path}/newest", n_buckets=4)
    batch = KeptTable(spark, f"{tmp_path}/batch", "user_id string, country_short string", n_buckets=4)
    state.add_posts(newest, "p0", posts)
    state.add_posts(newest, "p1", posts)
    batch.add("b", spark.range(50).selectExpr("CAST(id AS string) AS user_id", "'XA' AS country_short"))
    assert "Exchange" not in plan_of(state.latest_posts(newest))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = state.remaining(batch.read(), newest)
        assert "Exchange" not in plan_of(left) and left.count() == 20
        joined = batch.read().join(state.latest_posts(newest), "user_id", "left")
        assert "Exchange" not in plan_of(joined) and joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_adding_reads_the_new_pull_alone(spark, tmp_path, posts, monkeypatch):
    kept = state.newest_posts(spark, f"{tmp_path}/newest", n_buckets=4)
    state.add_posts(kept, "p0", posts)
    before = {f: f.stat().st_mtime_ns for f in tmp_path.glob("newest/pull=p0/*.parquet")}
    monkeypatch.setattr(KeptTable, "read", lambda self: pytest.fail("the stored pulls were read"))
    state.add_posts(kept, "p1", posts)
    assert before == {f: f.stat().st_mtime_ns for f in tmp_path.glob("newest/pull=p0/*.parquet")}
    assert 0 < len(list(tmp_path.glob("newest/pull=p1/*.parquet"))) <= 4


def test_a_new_session_attaches(spark, tmp_path, posts, bag):
    kept = state.newest_posts(spark, f"{tmp_path}/newest", n_buckets=4)
    state.add_posts(kept, "p0", posts)
    expected = bag(state.latest_posts(kept))
    spark.sql(f"DROP TABLE {kept.name}")  # the files of an external table stay
    again = state.newest_posts(spark, f"{tmp_path}/newest", n_buckets=4)
    assert bag(state.latest_posts(again)) == expected
    assert "Exchange" not in plan_of(state.latest_posts(again))


def test_newer_posts_by_kept_marks(spark, tmp_path, posts, bag):
    kept = state.newest_posts(spark, f"{tmp_path}/newest", n_buckets=4)
    stored = posts.where("tweet_timestamp < 20")
    state.add_posts(kept, "p0", stored)
    marks = profiles.latest_posts(stored).select("user_id", "tweet_id")
    assert bag(state.newer_than_kept(posts, kept)) == bag(worklist.newer_than_mark(posts, marks))
