"""The sampling loop end to end through the command line, on files."""

import bz2
import json
from pathlib import Path

import pytest

from cohortgraph import jobs
from cohortgraph.sources import tables
from tests.conftest import raw_post, raw_user, write_bz2_array


@pytest.fixture
def root(spark, tmp_path, rows):
    """a (XA) mentions b; b (XA) mentions c; d (XB) replies to b. Seed: a."""

    def post(post_id, user, location, day, mentions=(), **fields):
        entities = {"user_mentions": [{"id_str": m} for m in mentions], "urls": [{"expanded_url": f"u{post_id}"}]}
        time = f"Wed Oct {day:02d} 00:00:00 +0000 2018"
        return raw_post(post_id, created_at=time, user=raw_user(user, location), entities=entities, **fields)

    zone = tmp_path / "user_timeline" / "API"
    name = "user_timeline_2_users_2_requests_3_tweets_XA_01102018_full_1_1_x.json.bz2"
    first = [post("1", "a", "Here", 1, ["b"]), post("2", "a", "Here", 2, ["b"]), post("3", "b", "Here", 3, ["c"])]
    write_bz2_array(zone / "XA" / "01102018" / "full" / name, first)
    second = [post("3", "b", "Here", 3, ["c"]), post("4", "d", "There", 4, in_reply_to_user_id_str="b"), post("5", "c", "Here", 5)]
    write_bz2_array(zone / "XB" / "04102018" / "update" / name.replace("XA_01", "XB_04"), second)
    (zone / "XB" / "04102018" / "update" / "broken.json.bz2").write_bytes(bz2.compress(b'[{"id_str": '))
    (zone / "XB" / "04102018" / "update" / "junk.json.bz2").write_bytes(b"not bz2 at all")
    write_bz2_array(tmp_path / "lookup_users" / "API" / "102018" / "u.json.bz2", [raw_user("b", "Here"), raw_user("e", "Here")])
    (tmp_path / "lookup_users" / "API" / "102018" / "v.json").write_text("[{")
    places = rows("user_location string, country_short string", ("Here", "XA"), ("There", "XB"))
    places.write.parquet(f"{tmp_path}/preprocessed/locations/locations_geocoded.parquet")
    rows("user_id string", ("a",), ("x",)).write.parquet(f"{tmp_path}/lookup_users/seeds")
    friends = tmp_path / "friends_ids" / "XA" / "API" / "102018"
    friends.mkdir(parents=True)
    (friends / "f.json").write_text(json.dumps({"a": ["b", "z"], "q": []}))
    followers = tmp_path / "followers_ids" / "XA" / "API" / "102018"
    followers.mkdir(parents=True)
    (followers / "g.json").write_text(json.dumps({"b": ["a", "y"], "q": []}))
    yield str(tmp_path)
    spark.conf.unset("spark.sql.files.ignoreCorruptFiles")


def test_sampling_loop(spark, root, bag):
    def run(job, *options):
        jobs.main([job, "--root", root, "--skip-corrupt-files", *options])

    def table(path, *columns):
        return bag(spark.read.parquet(f"{root}/{path}"), *columns)

    run("extract", "--files", "2")
    assert len(spark.read.parquet(f"{root}/user_timeline/badRecords").collect()) == 1
    assert table("user_timeline/extract", "tweet_id") == [(str(i),) for i in range(1, 6)]
    run("audit")
    assert sorted((n, bad) for _, _, n, bad in table("user_timeline/audit")) == [(0, 0), (0, 1), (3, 0), (3, 0)]
    run("timeline_profiles")
    assert table("user_timeline/profiles", "user_id", "tweet_id", "tweet_count", "country_short") == [
        ("a", "2", 2, "XA"),
        ("b", "3", 1, "XA"),
        ("c", "5", 1, "XA"),
        ("d", "4", 1, "XB"),
    ]
    run("snowball")
    assert table("user_timeline/snowball") == [("b", "XA", 2), ("b", "XB", 1), ("c", "XA", 1)]
    run("users_profiles")
    assert table("lookup_users/profiles", "user_id", "country_short") == [("b", "XA"), ("e", "XA")]
    assert len(spark.read.parquet(f"{root}/lookup_users/badRecords").collect()) == 1
    run("users_batch")
    assert table("lookup_users/batch") == [("a",), ("c",), ("x",)]
    run("lookup_work", "--shards", "2", "--chunk", "1")
    assert sorted(row["ids"][0] for row in spark.read.parquet(f"{root}/lookup_users/work").collect()) == ["a", "c", "x"]
    run("timeline_batch_v1")
    assert ("b", "XB", 1, "3") in table("user_timeline/batch", "user_id", "country_short", "n_users", "tweet_id")
    run("timeline_batch")
    batch = table("user_timeline/batch", "user_id", "country_short", "tweet_id", "is_seed")
    assert batch == [("a", "XA", "2", 1), ("b", "XA", "3", 0), ("c", "XA", "5", 0), ("d", "XB", "4", 0), ("e", "XA", None, 0)]
    run("remaining_batch", "--countries", "XB", "--date", "*2018", "--pull-type", "update")
    assert table("user_timeline/batch_tmp", "user_id") == [("a",), ("e",)]
    run("select_work", "--countries", "XA", "XB", "--pull-type", "update", "--max-timestamp", "2018-10-05", "--shards", "2")
    assert table("user_timeline/work/update", "user_id") == [("a",), ("b",), ("d",)]
    run("level_stats", "--countries", "XA")
    assert table("preprocessing/stats/XA") == [(1, 1, 1, 0, 0)]
    run("post_urls", "--countries", "XA", "XB")
    assert table("preprocessed/urls/country_short=XB") == [("4", "u4")]
    run("network_batch", "--countries", "XA", "XB", "XC")
    assert bag(spark.read.csv(f"{root}/friends_ids/XA/batch.csv", header=True)) == [("b",), ("c",)]
    assert bag(spark.read.csv(f"{root}/friends_ids/XB/batch.csv", header=True)) == [("d",)]
    assert tables.read_ids_csv(spark, f"{root}/friends_ids/XC/batch.csv").collect() == []
    run("network_batch", "--countries", "XA", "--relation", "followers")
    assert bag(spark.read.csv(f"{root}/followers_ids/XA/batch.csv", header=True)) == [("a",), ("c",)]
    run("network_work", "--countries", "XA", "--relation", "followers", "--shards", "2", "--hash-shards")
    assert table("followers_ids/XA/work", "user_id") == [("a",), ("c",)]
    run("follow_edges", "--countries", "XA", "XB")
    assert table("preprocessed/follows") == [("a", "b", "XA"), ("a", "z", "XA"), ("y", "b", "XA")]
    run("friend_edges", "--countries", "XA")
    assert table("friends_ids/XA/edges") == [("a", "b"), ("a", "z")]
    run("pull_manifest")
    manifest = table("metrics/manifest", "country_short", "pull_date", "n_users", "n_tweets")
    assert manifest == [("XA", "01102018", 2, 3), ("XB", "04102018", 2, 3)]
    run("network_work", "--countries", "XA", "--shards", "2", "--hash-shards")
    assert table("friends_ids/XA/work", "user_id") == [("b",), ("c",)]
    run("pull_coverage")
    assert ("XA", "update", 3, 3, 0, 4) in table("metrics/pull_coverage")
    run("coverage_by_pull")
    by_pull = spark.read.parquet(f"{root}/metrics/coverage_by_pull").collect()
    assert all(r.n_users_asked == r.n_users_got + r.n_users_missed and r.n_requests >= r.n_users_got for r in by_pull)
    assert {r.country_short for r in by_pull} <= {"XA", "XB"} and {r.pull_type for r in by_pull} <= {"full", "update"}
    run("lookup_coverage")
    assert table("metrics/lookup_coverage") == [(3, 0, 3)]
    run("request_estimate", "--page", "1")
    assert ("a", 2, 2) in table("metrics/requests")
    run("monthly_counts")
    assert [n for _, n in table("metrics/monthly")] == [5]
    run("newer_posts")
    assert table("user_timeline/newer", "tweet_id") == []


def test_a_repaired_file_leaves_the_quarantine(spark, root, bag):
    run = lambda *job: jobs.main([*job, "--root", root, "--skip-corrupt-files"])
    run("extract")
    assert spark.read.parquet(f"{root}/user_timeline/badRecords").count() == 1
    write_bz2_array(Path(root) / "user_timeline/API/XB/04102018/update/broken.json.bz2", [raw_post("9", user=raw_user("u", followers_count="x"))])
    run("extract")
    assert spark.read.parquet(f"{root}/user_timeline/badRecords").count() == 0
    assert "9" in {r["tweet_id"] for r in spark.read.parquet(f"{root}/user_timeline/extract").collect()}
    run("extract", "--countries", "XA")
    assert bag(spark.read.parquet(f"{root}/user_timeline/extract"), "tweet_id") == [("1",), ("2",), ("3",)]


def test_work_lists_are_replaced_whole(spark, root, rows, bag):
    schema = "user_id string, country_short string, tweet_id string, tweet_timestamp timestamp, is_seed int"
    users = [(str(i), "US" if i % 2 else "MX", None, None, 0) for i in range(40)]
    rows(schema, *users).write.parquet(f"{root}/user_timeline/batch")
    rows(schema, *users[:4]).write.parquet(f"{root}/user_timeline/batch_tmp")
    run = lambda *o: jobs.main(["select_work", "--root", root, *o])
    found = lambda kind: bag(spark.read.parquet(f"{root}/user_timeline/work/{kind}"), "user_id")
    every = lambda keep: sorted((u[0],) for u in users if keep(u))
    for shards in ("8", "2"):
        run("--countries", "US", "MX", "--pull-type", "full", "--shards", shards)
        assert sorted(found("full")) == every(lambda u: True)
    run("--countries", "US", "--pull-type", "full", "--shards", "2")
    assert sorted(found("full")) == every(lambda u: u[1] == "US")
    run("--countries", "US", "--pull-type", "full", "--remaining")
    assert sorted(found("full")) == [("1",), ("3",)]
    with pytest.raises(SystemExit):
        run("--pull-type", "full")


def test_manifest_of_many_groups(spark, root):
    zone = Path(root) / "user_timeline/API/XA/01102018/full"
    for i in range(1100):
        (zone / f"user_timeline_1_users_1_requests_1_tweets_XA_{i:08d}_full_{i}.json.bz2").write_bytes(b"x")
    jobs.main(["pull_manifest", "--root", root])
    assert spark.read.parquet(f"{root}/metrics/manifest").count() == 1102
