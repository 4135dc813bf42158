"""The pipeline's jobs on small invented tables: ties, nulls, doubles, cycles."""

import pytest
from pyspark.sql import functions as F

from cohortgraph.functions.columns import epoch_seconds, numeric_id
from cohortgraph.operators.geocode import attach_country
from cohortgraph.operators.idsets import union_minus
from cohortgraph.plans import batches, levels, links, metrics, profiles
from cohortgraph.plans.snowball import interaction_edges, snowball
from cohortgraph.schemas import PROFILE_COLUMNS, RAW_USER_STRUCT, USER_COLUMNS, user_column
from cohortgraph.sources.landing import read_users
from tests.conftest import raw_user, write_bz2_array

POSTS = (
    "tweet_id string, user_id string, user_location string, tweet_mentioned_user_id array<string>, "
    "tweet_retweeted_user_id string, tweet_in_reply_to_user_id string"
)
PLACES = "user_location string, country_short string"


@pytest.fixture
def places(rows):
    return rows(PLACES, ("Here", "XA"), ("Here", "XA"), ("There", "XB"), ("Both", "XB"), ("Both", "XA"), (None, "XC"))


@pytest.fixture
def posts(rows):
    return rows(
        POSTS,
        ("1", "a", "Here", ["b", "c"], None, None),
        ("2", "a", "Here", ["b"], "b", None),
        ("3", "d", "Nowhere", [], None, "b"),
        ("4", "e", None, None, "c", "c"),
        ("5", "f", "There", [None, "b"], None, None),
    )


def test_time_text(rows):
    texts = ["Wed Oct 10 20:19:24 +0000 2018", "Wed Oct 10 20:19:24 +0130 2018", "2018-10-10", "", None]
    seconds = rows("t string", *[(text,) for text in texts]).select(epoch_seconds("t").alias("s")).collect()
    assert [row["s"] for row in seconds] == [1539202764, 1539197364, None, None, None]


def test_ids_are_ordered_as_numbers(rows):
    found = rows("id string", ("9",), ("10",), ("12345678901234567890",), ("x",)).select(numeric_id("id").alias("n"))
    assert [row["n"] and int(row["n"]) for row in found.collect()] == [9, 10, 12345678901234567890, None]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_geocoding_broadcast_and_shuffled_agree(rows, places, bag, limit):
    users = rows("user_id string, user_location string", *[(str(i), "Here") for i in range(50)], ("x", None), ("y", "?"))
    left = attach_country(users, places, broadcast_limit=limit)
    counts = {row["country_short"]: row["n"] for row in left.groupBy("country_short").agg(F.count("*").alias("n")).collect()}
    assert counts == {"XA": 50, None: 2}
    inner = attach_country(users, places, how="inner", broadcast_limit=limit)
    assert inner.count() == 50
    assert attach_country(users, places, "inner", ["XB"], limit).count() == 0


def test_snowball_counts_interactions(posts, places, bag):
    found = snowball(posts, places)
    assert found.columns == ["user_id", "country_short", "n_users"]
    assert bag(found) == [("b", None, 1), ("b", "XA", 3), ("b", "XB", 1), ("c", None, 2), ("c", "XA", 1)]
    assert found.agg(F.sum("n_users")).first()[0] == interaction_edges(posts).count() == 8


def test_snowball_of_authors(posts, places, bag):
    found = snowball(posts, places, distinct_authors=True)
    assert bag(found) == [("b", None, 1), ("b", "XA", 1), ("b", "XB", 1), ("c", None, 1), ("c", "XA", 1)]


def _timeline(rows, *posts):
    """Posts (tweet_id, time, user_id, location) with empty profiles."""
    table = rows("tweet_id string, tweet_timestamp long, user_id string, user_location string", *posts)
    types = {user_column(field.name): field.dataType for field in RAW_USER_STRUCT.fields}
    types["user_timestamp"] = "bigint"
    for name in USER_COLUMNS:
        if name not in table.columns:
            table = table.withColumn(name, F.lit(None).cast(types[name]))
    return table


def test_newest_profile(rows, places, bag):
    table = _timeline(
        rows,
        ("9", 5, "tie", "There"),
        ("10", 5, "tie", "Here"),
        ("1", 1, "late", "Here"),
        ("2", 9, "late", "Nowhere"),
        ("3", None, "late", "Here"),
        ("4", None, "untimed", "Here"),
        ("5", 1, None, "Here"),
        ("6", 1, "both", "Both"),
    )
    found = profiles.timeline_profiles(table, places)
    assert found.columns == PROFILE_COLUMNS
    assert bag(found, "user_id", "tweet_id", "tweet_count", "country_short") == [
        ("both", "6", 1, "XA"),
        ("late", "2", 3, None),
        ("tie", "10", 2, "XA"),
    ]


def test_looked_up_profiles(spark, tmp_path, places, bag):
    status = {"id_str": "5", "created_at": "Wed Oct 10 20:19:24 +0000 2018"}
    newer = {"id_str": "6", "created_at": "Wed Oct 10 20:19:25 +0000 2018"}
    users = [
        raw_user("1", "Here"),
        raw_user("1", "There", status=status),
        raw_user("2", "Here", status=status),
        raw_user("2", "Here", status=newer),
        raw_user("3", None),
        raw_user("3", None),
    ]
    write_bz2_array(tmp_path / "u.json.bz2", users)
    found = profiles.users_profiles(read_users(spark, str(tmp_path))[0], places)
    assert len(found.columns) == 20
    assert bag(found, "user_id", "tweet_id", "country_short") == [
        ("1", None, "XA"),
        ("1", "5", "XB"),
        ("2", "6", "XA"),
        ("3", None, None),
    ]


def test_users_batch_is_disjoint_from_known(rows, bag):
    ids = "user_id string"
    seeds = rows(ids, ("1",), ("1",), ("2",), (None,))
    snowballed = rows("user_id string, country_short string", ("2", "XA"), ("3", "XA"), ("3", None), ("4", "XB"))
    known = rows(ids, ("4",), ("2",), ("2",), (None,), ("8",))
    assert bag(batches.users_batch(seeds, snowballed, known)) == [(None,), ("1",), ("3",)]
    assert union_minus([seeds], [seeds]).dropna().count() == 0


LAST_POSTS = "user_id string, country_short string, tweet_id string, tweet_timestamp long"


def test_timeline_batch(rows, bag):
    timelines = rows(LAST_POSTS, ("1", "XA", "11", 0), ("2", None, "12", 1), (None, "XA", "13", 2))
    lookups = rows(
        LAST_POSTS,
        ("1", "XB", "1", 9),
        ("2", "XB", "2", 9),
        ("3", "XA", "9", 4),
        ("3", "XB", "10", 4),
        ("4", None, "3", 9),
        ("5", "XC", None, None),
        (None, "XB", "4", 9),
    )
    seeds = rows("user_id string", ("2",), ("2",), ("4",), ("77",), (None,))
    batch = batches.timeline_batch(timelines, lookups, seeds)
    assert dict(batch.dtypes)["is_seed"] == "int"
    found = bag(batch.withColumn("tweet_timestamp", F.unix_seconds("tweet_timestamp")))
    assert found == [
        (None, "XA", "13", 2, 0),
        (None, "XB", None, None, 0),
        ("1", "XA", "11", 0, 0),
        ("2", "XB", None, None, 1),
        ("3", "XB", None, None, 0),
        ("5", "XC", None, None, 0),
    ]


def test_timeline_batch_v1(rows, bag):
    timelines = rows(LAST_POSTS, ("1", "XA", "11", 0), ("2", None, "12", 1))
    lookups = rows("user_id string, country_short string", ("1", "XA"), ("1", "XB"), ("2", "XB"), ("3", None))
    snowballed = rows(
        "user_id string, country_short string, n_users long", ("1", "XA", 5), ("1", "XC", 6), ("4", "XA", 7), ("4", None, 8)
    )
    batch = batches.timeline_batch_v1(timelines, lookups, snowballed)
    found = bag(batch.select("user_id", "country_short", "n_users", "tweet_id"))
    assert found == [
        ("1", "XA", None, "11"),
        ("1", "XB", None, "11"),
        ("1", "XC", 6, "11"),
        ("2", "XB", None, "12"),
        ("4", "XA", 7, None),
    ]


def test_remaining_batch_keeps_all_countries(rows, bag):
    batch = rows("user_id string, country_short string", ("1", "XA"), ("1", "XB"), ("2", "XA"), (None, "XA"))
    pulled = rows("user_id string", ("2",), ("2",), (None,))
    assert bag(batches.remaining_batch(batch, pulled)) == [(None, "XA"), ("1", "XA"), ("1", "XB")]


def test_network_batch(rows, bag):
    users = rows("user_id string, country_short string", ("1", "XA"), ("2", "XA"), ("3", "XB"))
    stored = rows("user_id string, friend_ids array<string>", ("2", ["9"]), ("2", []))
    assert bag(batches.network_batch(users, stored, "XA")) == [("1",)]


def test_network_batches(rows, bag):
    users = rows("user_id string, country_short string", ("1", "XA"), ("1", "XB"), ("2", "XA"), ("2", "XA"), ("3", "XC"), (None, "XB"), ("4", None))
    lists = rows("country_short string, user_id string", ("XA", "1"), ("XA", "1"), ("XB", None), ("XC", "2"))
    assert bag(batches.network_batches(users, lists, ["XA", "XB"])) == [("XA", "2"), ("XB", None), ("XB", "1")]


def test_follow_edges(rows, bag):
    schema = "country_short string, user_id string, friend_ids array<string>"
    friends = rows(schema, ("XA", "1", ["2", "3", "2"]), ("XB", "1", ["2"]), ("XA", "4", []), ("XA", "5", None))
    followers = rows(schema, ("XA", "2", ["1", "9"]), ("XA", "4", None))
    expected = [("XA", "1", "2"), ("XA", "1", "3"), ("XA", "9", "2"), ("XB", "1", "2")]
    assert bag(links.follow_edges(friends, followers, "country_short")) == expected
    assert bag(links.follow_edges(friends.limit(0), followers)) == [("1", "2"), ("9", "2")]


MENTIONS = "user_id string, tweet_mentioned_user_id array<string>"


@pytest.mark.parametrize("few_users", [True, False])
def test_levels_of_a_cycle(rows, bag, monkeypatch, few_users):
    monkeypatch.setattr(levels, "fits", lambda df: few_users)
    chain = [("a", ["b", "b"]), ("b", ["c"]), ("c", ["d", "a"]), ("d", ["e"]), ("e", ["f"]), ("b", ["z"]), ("z", ["f"])]
    table = rows(MENTIONS, *chain, ("c", None), ("c", []), ("d", ["d"]))
    users = rows("user_id string, country_short string", *[(user, "XA") for user in "abcdef"], ("z", "XB"))
    seeds = rows("user_id string", ("a",), ("a",), ("z",), ("nobody",))
    members = levels.level_members(table, users, seeds, ["XA", "XB"])
    assert bag(members, "user_id", "level") == [("a", 0), ("b", 1), ("c", 2), ("d", 3), ("e", 4), ("z", 0)]
    stats = levels.level_stats(table, users, seeds, ["XA", "XB", "XC"])
    assert bag(stats) == [("XA", 1, 1, 1, 1, 1), ("XB", 1, 0, 0, 0, 0), ("XC", 0, 0, 0, 0, 0)]
    assert bag(levels.level_members(table, users, seeds, ["XA"], depth=5), "user_id", "level")[-1] == ("f", 5)


def test_levels_of_a_lonely_seed(rows):
    users = rows("user_id string, country_short string", ("a", "XA"), ("b", "XA"))
    stats = levels.level_stats(rows(MENTIONS, ("b", ["a"])), users, rows("user_id string", ("a",)), ["XA"])
    assert [tuple(row)[1:] for row in stats.collect()] == [(1, 0, 0, 0, 0)]
    nobody = levels.level_stats(rows(MENTIONS, ("b", ["a"])), users, rows("user_id string", ("x",)), ["XA"])
    assert nobody.first().asDict() == {"country_short": "XA", "n_seeds": 0, **{f"n_snowball_{k}": 0 for k in range(1, 5)}}


def test_post_urls(rows, places, bag):
    table = rows(
        "tweet_id string, user_location string, tweet_urls array<string>",
        ("1", "Here", ["u2", "u1"]),
        ("2", "Here", []),
        ("3", "Here", None),
        ("4", "There", ["u3"]),
        ("5", "Both", ["u4"]),
        ("6", None, ["u5"]),
    )
    assert bag(links.post_urls(table, places, ["XA"])) == [("1", "u2", "XA"), ("5", "u4", "XA")]
    assert bag(links.post_urls(table, places, ["XA", "XB"], all_urls=True), "tweet_id", "url") == [
        ("1", "u1"),
        ("1", "u2"),
        ("4", "u3"),
        ("5", "u4"),
    ]
    doubled = table.unionByName(table)
    assert links.post_urls(doubled, places, ["XA"], unique_posts=False).count() == 2


def test_coverage_by_pull(spark):
    batch = spark.createDataFrame(
        [("a", "XA", "1", True), ("b", "XA", "2", True), ("c", "XA", None, False), ("a", "XB", "1", True), ("a", "XA", "1", True)],
        "user_id string, country_short string, tweet_id string, known boolean",
    ).selectExpr("user_id", "country_short", "tweet_id", "IF(known, timestamp '2022-01-01', NULL) AS tweet_timestamp")
    pulled = spark.createDataFrame(
        [*[(str(i), "a", "XA", "01022022", "update") for i in range(5)], ("9", "b", "XA", "02022022", "update"),
         ("10", "z", "XA", "02022022", "update"), ("11", "c", "XA", "02022022", "full"), ("12", "z", "XC", "02022022", "full")],
        "tweet_id string, user_id string, country_short string, pull_date string, pull_type string",
    )
    assert sorted(map(tuple, metrics.coverage_by_pull(batch, pulled, page=2).collect())) == [
        ("XA", "01022022", "update", 2, 1, 1, 3, 5),
        ("XA", "02022022", "full", 1, 1, 0, 1, 1),
        ("XA", "02022022", "update", 2, 1, 1, 1, 1),
        ("XC", "02022022", "full", 0, 0, 0, 0, 0),
    ]
    assert metrics.coverage_by_pull(batch, pulled.limit(0)).count() == 0
