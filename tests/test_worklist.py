"""Work lists, shards, chunks and counts."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortgraph.operators.survivors import keep_greatest
from cohortgraph.operators.shards import assign_shards, chunk_ids, cut_shards, hash_shards
from cohortgraph.plans import metrics, worklist

BATCH = "user_id string, country_short string, tweet_id string, tweet_timestamp timestamp, is_seed int"


@pytest.fixture
def batch(spark, rows):
    text = BATCH.replace("timestamp timestamp", "timestamp string")
    table = rows(
        text,
        ("1", "XA", None, None, 0),
        ("2", "XA", "20", "2022-04-01 00:00:00", 0),
        ("3", "XA", "30", "2022-05-01 00:00:00", 1),
        ("4", "XB", "40", "2022-06-01 00:00:00", 0),
        ("4", "XA", "40", "2022-06-01 00:00:00", 0),
        ("5", "XC", "50", "2022-06-01 00:00:00", 0),
        ("6", "XB", None, None, 1),
        ("7", "XA", "70", "2022-12-31 00:00:00", 0),
    )
    return table.withColumn("tweet_timestamp", F.col("tweet_timestamp").cast("timestamp"))


def chosen(batch, *args, **options):
    users = worklist.select_users(batch, worklist.work_filters(*args, **options))
    return sorted((row["user_id"], row["country_short"]) for row in users.collect())


def test_pull_types(batch):
    assert chosen(batch, ["XA", "XB"], "full") == [("1", "XA"), ("6", "XB")]
    assert chosen(batch, ["XA", "XB"], "full", drop_seeds=True) == [("1", "XA")]
    assert chosen(batch, ["XA", "XB"], "update") == [("2", "XA"), ("3", "XA"), ("4", "XB"), ("7", "XA")]
    with pytest.raises(ValueError):
        worklist.of_pull_type("half")


def test_time_window_is_open(batch):
    window = {"min_timestamp": "2022-04-01", "max_timestamp": "2022-12-31"}
    assert chosen(batch, ["XA"], "update", **window) == [("3", "XA"), ("4", "XA")]
    assert chosen(batch, ["XA"], "full", **window) == [("1", "XA")]
    days = {"min_timestamp": "04/01/2022", "max_timestamp": "6/1/2022"}
    assert chosen(batch, ["XA"], "update", **days) == [("3", "XA")]


def test_funnel(batch):
    window = {"min_timestamp": "2022-04-01", "max_timestamp": "2022-12-31"}
    filters = worklist.work_filters(["XA", "XB"], "update", drop_seeds=True, **window)
    assert metrics.filter_funnel(batch, filters).first().asDict() == {
        "n_all": 8,
        "n_in_countries": 7,
        "n_update": 5,
        "n_before_max": 4,
        "n_after_min": 3,
        "n_not_seed": 2,
        "n_unique": 1,
    }


def test_newer_than_mark(rows, bag):
    posts = rows("tweet_id string, user_id string", ("9", "a"), ("10", "a"), ("11", "a"), ("1", "b"), ("2", None))
    marks = rows("user_id string, tweet_id string", ("a", "9"), ("a", "10"), ("b", None), (None, "5"))
    assert bag(worklist.newer_than_mark(posts, marks)) == [("1", "b"), ("11", "a"), ("2", None)]


def expected_shards(groups, n_shards):
    """Numpy-like split of each group in the order of the seeded hash."""
    found = {}
    for group, ids in groups.items():
        order = sorted(ids, key=lambda user: hashlib.md5(f"{user}0".encode()).hexdigest())
        long_size = -(-len(order) // n_shards)
        n_long = len(order) - n_shards * (len(order) // n_shards)
        start = 0
        for shard in range(n_shards):
            size = long_size if shard < n_long or len(order) % n_shards == 0 else long_size - 1
            for position, user in enumerate(order[start : start + size]):
                found[group, user] = (shard, position)
            start += size
    return found


@pytest.mark.parametrize("n_shards", [1, 3, 7, 50])
def test_shards_are_exact(rows, n_shards):
    groups = {"XA": [str(i) for i in range(200)], "XB": ["x"], None: ["p", "q", "r"], "XC": [str(i) for i in range(14)]}
    table = rows("user_id string, country_short string", *[(i, group) for group, ids in groups.items() for i in ids])
    shards = assign_shards(table, n_shards)
    found = {
        (row["country_short"], row["user_id"]): (row["shard"], row["shard_position"]) for row in shards.collect()
    }
    assert found == expected_shards(groups, n_shards)
    sizes = Counter((country, shard) for (country, _), (shard, _) in found.items())
    by_country = defaultdict(list)
    for (country, _), size in sizes.items():
        by_country[country].append(size)
    assert all(max(counts) - min(counts) <= 1 for counts in by_country.values())


def test_chunks_hold_every_id_once(spark):
    table = spark.range(1003).select(F.col("id").cast("string").alias("user_id"))
    chunks = chunk_ids(assign_shards(table, 4, by=()), size=100, by=["shard"]).collect()
    assert sorted(int(i) for row in chunks for i in row["ids"]) == list(range(1003))
    assert max(row["n_ids"] for row in chunks) == 100 and all(row["n_ids"] == len(row["ids"]) for row in chunks)
    assert Counter(row["shard"] for row in chunks) == {0: 3, 1: 3, 2: 3, 3: 3}


@pytest.mark.parametrize(("n_shards", "max_buckets"), [(1, 10**6), (3, 10**6), (7, 300), (50, 20), (400, 1)])
def test_cut_shards_are_those_of_the_full_order(rows, n_shards, max_buckets):
    values = [(f"u{i}", "XA" if i % 3 else "XB") for i in range(700)] + [("v1", None), (None, "XA"), ("w", "XC")]
    table = rows("user_id string, country_short string", *values)
    whole = {(r.country_short, r.user_id): r.shard for r in assign_shards(table, n_shards).collect()}
    cut = cut_shards(table, n_shards, max_buckets=max_buckets)
    assert cut.columns == ["user_id", "country_short", "shard"]
    assert {(r.country_short, r.user_id): r.shard for r in cut.collect()} == whole
    assert cut_shards(table.limit(0), n_shards).collect() == []


def test_cut_shards_do_not_move_the_rows(spark):
    users = spark.range(10_000).select(F.col("id").cast("string").alias("user_id"))
    plan = cut_shards(users, 7, by=())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 1 and "Exchange hashpartitioning" not in plan


def test_hash_shards_can_be_chunked(spark):
    table = hash_shards(spark.range(1000).select(F.col("id").cast("string").alias("user_id")), 5)
    chunks = chunk_ids(table, size=30, by=["shard"]).collect()
    assert sorted(int(i) for row in chunks for i in row["ids"]) == list(range(1000))
    for shard in range(5):
        sizes = sorted((row["chunk"], row["n_ids"]) for row in chunks if row["shard"] == shard)
        assert [chunk for chunk, _ in sizes] == list(range(len(sizes))) and all(n == 30 for _, n in sizes[:-1])


def test_select_work(batch):
    work = worklist.select_work(batch, ["XA", "XB"], "update", n_shards=2)
    assert sorted(row["user_id"] for row in work.collect()) == ["2", "3", "4", "7"]
    assert work.columns == [*batch.columns, "shard", "shard_position"]


def test_monthly_counts_fill_gaps(rows, bag):
    days = [("1", "2019-05-31"), ("2", "2019-07-01"), (None, "2019-07-02"), ("3", None), ("4", "2019-10-09")]
    text = rows("user_id string, t string", *days)
    table = text.withColumn("t", F.col("t").cast("timestamp"))
    found = [(str(month), n) for month, n in bag(metrics.monthly_counts(table, "t"))]
    assert found == [
        ("2019-05-31", 1),
        ("2019-06-30", 0),
        ("2019-07-31", 1),
        ("2019-08-31", 0),
        ("2019-09-30", 0),
        ("2019-10-31", 1),
    ]
    assert len(bag(metrics.monthly_counts(table, "t", "2019-07-15"))) == 4
    assert metrics.monthly_counts(table.where("false"), "t").count() == 0


def test_request_estimate(spark, rows, bag):
    posts = spark.range(401).select(F.col("id").cast("string").alias("tweet_id"), F.lit("a").alias("user_id"))
    posts = posts.unionByName(posts.limit(200).withColumn("user_id", F.lit("b")))
    users = rows("user_id string", ("a",), ("b",), ("c",))
    assert bag(metrics.request_estimate(users, posts)) == [("a", 401, 3), ("b", 200, 1), ("c", 0, 1)]


def test_pull_coverage(batch, rows, bag):
    posts = rows("tweet_id string, user_id string", ("1", "2"), ("2", "2"), ("3", "4"), ("4", "stranger"))
    assert bag(metrics.pull_coverage(batch, posts)) == [
        ("XA", "full", 1, 0, 1, 0),
        ("XA", "update", 4, 2, 2, 3),
        ("XB", "full", 1, 0, 1, 0),
        ("XB", "update", 1, 1, 0, 1),
        ("XC", "update", 1, 0, 1, 0),
    ]


def test_half_known_users_are_full_everywhere(rows, bag):
    half = rows(BATCH.replace("timestamp timestamp", "timestamp string"), ("8", "XA", "80", None, 0), ("9", "XA", None, "2022-01-01 00:00:00", 0))
    half = half.withColumn("tweet_timestamp", F.col("tweet_timestamp").cast("timestamp"))
    assert chosen(half, ["XA"], "full") == [("8", "XA"), ("9", "XA")] and chosen(half, ["XA"], "update") == []
    posts = rows("tweet_id string, user_id string", ("1", "8"))
    assert bag(metrics.pull_coverage(half, posts)) == [("XA", "full", 2, 1, 1, 1)]


def test_lookup_coverage(rows):
    asked = rows("user_id string", ("a",), ("a",), ("b",), ("c",), (None,))
    got = rows("user_id string", ("b",), ("b",), ("z",), (None,))
    assert tuple(metrics.lookup_coverage(asked, got).first()) == (3, 1, 2)


def test_head(batch):
    assert [row["user_id"] for row in worklist.head(batch, 2).collect()] == ["1", "2"]


# Invented names of each form.
NAMES = {
    "user_timeline_31_users_62_requests_930_tweets_QA_15071999_update_77_1_first.json.bz2": (
        31, 62, 930, "QA", "15071999", "update",
    ),
    "user_timeline_4_users_8_requests_16_tweets_QA_31121998_full_min_timestamp=011997_max_timestamp=011998_78_2_b.json.bz2": (
        4, 8, 16, "QA", "31121998", "full",
    ),
    "user_timeline_4_users_16_tweets_QB_02031997_no_updates_no_neighbors_full_79_3_c.json.bz2": (
        4, None, 16, "QB", "02031997", "full",
    ),
    "user_timeline_4_users_8_requests_16_tweets_02031996_update_80_4_d.json.bz2": (
        4, 8, 16, None, "02031996", "update",
    ),
    "user_timeline_60_QA_071999_full_81_5_e.json.bz2": (60, None, None, "QA", "071999", "full"),
    "lookup_users_2500_19990715_82_6_f.json": (2500, None, None, None, "19990715", None),
    "friends_ids_QA_20_users_1999_07_15_0_0_g.json": (20, None, None, "QA", "1999_07_15", None),
    "followers_ids_QB_30_users_1999_07_16_0_0_h.json": (30, None, None, "QB", "1999_07_16", None),
    "part-00000.parquet": (None,) * 6,
}


def test_pull_names(rows):
    parsed = metrics.parse_pull_names(rows("file_name string", *[(name,) for name in NAMES])).collect()
    assert {row["file_name"]: tuple(row)[1:] for row in parsed} == NAMES


def test_pull_manifest(rows, bag):
    table = rows("file_name string", *[(name,) for name in NAMES], *[(name,) for name in list(NAMES)[:1]])
    found = bag(metrics.pull_manifest(table))
    assert len(found) == 8 and ("QA", "15071999", "update", 2, 62, 124, 1860) in found


def test_a_column_called_rank_stays(rows, bag):
    table = rows("user_id string, _rank int, at int", ("1", 7, 1), ("1", 8, 2), ("2", 9, 1))
    assert bag(keep_greatest(table, ["user_id"], [F.col("at")])) == [("1", 8, 2), ("2", 9, 1)]
