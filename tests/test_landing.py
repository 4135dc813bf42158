"""Reading and writing files."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cohortgraph import sinks
from cohortgraph import standin as given
from cohortgraph.catalogue import QUERIES
from cohortgraph.functions.columns import flatten_posts
from cohortgraph.plans import links
from cohortgraph.plans.extract import extract_posts
from cohortgraph.schemas import RAW_POST, USER_COLUMNS
from cohortgraph.sources import drift, landing, tables
from tests.conftest import raw_post, raw_user, write_bz2_array


@pytest.fixture
def zone(tmp_path):
    """Two good files sharing a post, one broken JSON file, in the country/date/type layout."""
    folder = tmp_path / "API" / "XA" / "01012024"
    write_bz2_array(folder / "full" / "a.json.bz2", [raw_post("1"), raw_post("2", user_id="9")])
    write_bz2_array(
        folder / "update" / "b.json.bz2", [raw_post("2", user=raw_user("9", statuses_count=5)), raw_post("3")]
    )
    (folder / "full" / "broken.json").write_text('[{"id_str": "4", ')
    return f"{tmp_path}/API/*/*/*/*"


def test_arrays_are_read_through_globs(spark, zone, bag):
    good, _ = landing.read_posts(spark, zone)
    located = landing.with_path_parts(good, landing.files_under(spark, zone))
    found = bag(located.select("id_str", "country_short", "pull_date", "pull_type"))
    assert found == [
        ("1", "XA", "01012024", "full"),
        ("2", "XA", "01012024", "full"),
        ("2", "XA", "01012024", "update"),
        ("3", "XA", "01012024", "update"),
    ]


def test_bad_records_are_quarantined(spark, zone):
    good, bad = landing.read_posts(spark, zone)
    assert good.count() == 4
    [row] = bad.collect()
    assert row["source_file"].endswith("broken.json") and row["bad_text"] == '[{"id_str": "4", '


def test_records_without_id_are_quarantined(spark, tmp_path):
    write_bz2_array(tmp_path / "a.json.bz2", [raw_post(None, full_text="hello"), raw_post("1")])
    good, bad = landing.read_posts(spark, str(tmp_path))
    assert good.count() == 1
    [row] = bad.collect()
    assert row["source_file"].endswith("a.json.bz2") and json.loads(row["bad_text"])["full_text"] == "hello"


@pytest.mark.parametrize("multi_line", [True, False])
def test_a_mistyped_field_costs_that_field_alone(spark, tmp_path, multi_line):
    posts = [raw_post("1"), raw_post("2", user=raw_user("9", followers_count="many")), raw_post("3")]
    if multi_line:
        write_bz2_array(tmp_path / "a.json.bz2", posts)
    else:
        (tmp_path / "a.json").write_text("\n".join(map(json.dumps, posts)))
    good, bad = landing.read_posts(spark, str(tmp_path), multi_line=multi_line)
    assert sorted((r["id_str"], r["user"]["id_str"]) for r in good.collect()) == [("1", "1"), ("2", "9"), ("3", "1")]
    assert bad.collect() == []


def test_an_odd_element_costs_itself_alone(spark, tmp_path, bag):
    """Whatever stands in a sound array, its own text is kept, with fields that no schema has."""
    odd = '[{"id_str": "1", "lang": "en"}, 5, null, "text", [1], {"lang": "de", "extra": {"b": [1, {"c": 2.50}], "a": null}}, {"id_str": "7", "id_str": "8"}, {"id_str": 9}]'
    (tmp_path / "odd.json").write_text(odd)
    (tmp_path / "one.json").write_text(' {"id_str": "10"}')
    (tmp_path / "none.json").write_text("[]")
    (tmp_path / "nothing.json").write_text("")
    good, bad = landing.read_posts(spark, f"{tmp_path}/*.json")
    assert bag(good.select("id_str")) == [("1",), ("10",), ("8",), ("9",)]
    texts = {r["bad_text"] for r in bad.collect()}
    assert texts == {"5", "null", '"text"', "[1]", '{"extra":{"a":null,"b":[1,{"c":2.5}]},"lang":"de"}'}


def test_bad_lines_keep_their_own_text(spark, tmp_path, bag):
    lines = ['{"id_str": "1"}', "", '{"lang":  "de", "extra": 1}', '{"id_str": "2"', "   ", "7"]
    (tmp_path / "a.json").write_text("\n".join(lines))
    good, bad = landing.read_posts(spark, str(tmp_path), multi_line=False)
    assert bag(good.select("id_str")) == [("1",)] and bag(bad.select("bad_text")) == sorted((x,) for x in (lines[2], lines[3], "7"))
    elements = landing.read_elements(spark, str(tmp_path), multi_line=False)
    assert bag(elements.select("_corrupt_record").where("element IS NULL")) == [(lines[3],)]


def test_reading_starts_no_job(spark, zone):
    """Good and bad records are both lazy, and no file name is collected."""
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    good, bad = landing.read_posts(spark, zone)
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert good.count() == 4 and bad.count() == 1


@pytest.mark.parametrize("multi_line", [True, False])
def test_a_record_is_parsed_once(spark, tmp_path, multi_line):
    """The filter on the id does not parse again."""
    (tmp_path / "a.json").write_text('{"id_str": "1"}\n')
    for records in landing.read_posts(spark, str(tmp_path), multi_line=multi_line):
        parser = "variant_get(" if multi_line else "from_json("
        assert records._jdf.queryExecution().executedPlan().toString().count(parser) == 1


def test_landing_files_are_unpacked_in_even_tasks(spark, tmp_path, monkeypatch, bag):
    """A large and many small files: tasks get bytes, not files, alike; the session keeps its own settings."""
    for i in range(12):
        n = 4000 if i == 0 else 1
        (tmp_path / f"{i}.json").write_text("".join(json.dumps(raw_post(f"{i}-{j}")) + "\n" for j in range(n)))
    own = {key: spark.conf.get(key) for key in landing.SPLITS}
    monkeypatch.setattr(landing, "SPLITS", dict.fromkeys(landing.SPLITS, "100000b"))
    good, _ = landing.read_posts(spark, str(tmp_path), multi_line=False)
    posts = landing.unpacked(good.withColumn("task", F.spark_partition_id()))
    assert posts.count() == 4011 and bag(posts.groupBy("id_str").count().where("count > 1")) == []
    shares = [r["count"] for r in posts.groupBy("task").count().collect()]
    assert len(shares) > 6 and max(shares) < 1000
    staged, _ = landing.staged(landing.read_landing(spark, str(tmp_path), RAW_POST, multi_line=False), f"{tmp_path}-staged")
    assert staged.count() == 4011 and len(staged.inputFiles()) > 6
    assert {key: spark.conf.get(key) for key in landing.SPLITS} == own


@pytest.mark.parametrize("name", ["landing_round_trip", "landing_files"])
def test_landing_queries_read_their_files_at_once(spark, tmp_path, rows, name):
    """What is given back reads the unpacked records, and parses nothing."""
    tables_of = {
        "region": [(0, "AFRICA")],
        "nation": [(5, "ETHIOPIA", 0)],
        "customer": [(1, "Customer#1", 5, 10.0, "BUILDING")],
        "events": [(i, datetime(2024, 1, 1 + i % 2), 1, ("view", "signup")[i % 2], 1.5, '{"k": 7}') for i in range(6)],
    }
    for table, values in tables_of.items():
        rows(given.SCHEMAS[table], *values).write.parquet(f"{tmp_path}/{table}.parquet")
    found = QUERIES[name](spark, str(tmp_path))
    assert "from_json" not in found._jdf.queryExecution().executedPlan().toString()
    if name == "landing_files":
        assert sorted(map(tuple, found.collect())) == [("XA", "012024", "full", 3, 3), ("XA", "022024", "update", 3, 3)]
    else:
        assert sorted(r["tweet_id"] for r in found.collect()) == list("012345")


def test_drift_is_counted_by_path_and_type(spark, tmp_path):
    posts = [raw_post("1"), raw_post("2", lang=3), raw_post("3", extra={"x": 1}, coordinates={"coordinates": [1, 2.5]})]
    posts += [raw_post("4", user=None, entities={"urls": [{"expanded_url": "u"}, {"expanded_url": 5}]}, place={"id": 7}), 5]
    write_bz2_array(tmp_path / "a.json.bz2", posts)
    found = {(r.path, r.type_found): r for r in drift.drift(landing.read_elements(spark, str(tmp_path)), RAW_POST).collect()}
    n = {key: r.n_records for key, r in found.items()}
    assert n["$", "OBJECT"] == 4 and n["$", "BIGINT"] == 1 and found["$", "BIGINT"].is_drift
    assert n["$.lang", "STRING"] == 3 and n["$.lang", "BIGINT"] == 1 and found["$.lang", "BIGINT"].is_drift
    assert n["$.extra.x", "BIGINT"] == 1 and found["$.extra.x", "BIGINT"].type_expected is None
    assert n["$.entities.urls[].expanded_url", "VARIANT"] == 1 and n["$.entities.urls", "ARRAY"] == 4
    assert not found["$.coordinates.coordinates[]", "DECIMAL"].is_drift
    assert not found["$.user", "VOID"].is_drift and n["$.user", "OBJECT"] == 3
    assert n["$.retweeted_status", None] == 0 and not found["$.retweeted_status", None].is_drift
    assert ("$.place.id", "BIGINT") not in found  # kept whole, as text


def test_staging_counts_are_those_of_the_table(spark, zone, tmp_path):
    records, counts = landing.staged(landing.read_landing(spark, zone, RAW_POST), f"{tmp_path}/staging")
    assert counts == {"n_records": 4, "n_bad": 1, "n_bad_bytes": 17}
    assert records.where("is_good").count() == 4 and records.where("NOT is_good").count() == 1


def test_extract_keeps_one_copy_and_is_idempotent(spark, zone, bag):
    good, _ = landing.read_posts(spark, zone)
    once = extract_posts(good)
    assert bag(once, "tweet_id", "user_statuses_count") == [("1", 1), ("2", 5), ("3", 1)]
    assert len(once.columns) == 27
    twice = extract_posts(good.unionByName(good))
    assert bag(once.drop("tweet_place"), *once.drop("tweet_place").columns) == bag(
        twice.drop("tweet_place"), *once.drop("tweet_place").columns
    )


def test_flatten_is_null_safe(spark, tmp_path):
    posts = [
        raw_post("1", created_at="not a time", entities={"user_mentions": None}),
        raw_post(
            "2",
            entities={"user_mentions": [{"id_str": "7"}, {"id_str": "8"}], "urls": [{"expanded_url": "u"}]},
            retweeted_status={"user": {"id_str": "7"}},
            coordinates={"coordinates": [1.5, -2.5]},
            place={"id": "p1", "full_name": "Town", "bounding_box": {"coordinates": [[[1, 2]]]}},
        ),
    ]
    write_bz2_array(tmp_path / "a.json.bz2", posts)
    first, second = flatten_posts(landing.read_posts(spark, str(tmp_path))[0]).orderBy("tweet_id").collect()
    assert first["tweet_timestamp"] is None and first["tweet_mentioned_user_id"] is None
    assert first["tweet_retweeted_user_id"] is None and first["tweet_place"] is None
    assert second["tweet_timestamp"] == 1539202764 and second["user_timestamp"] == 1420416000
    assert second["tweet_mentioned_user_id"] == ["7", "8"] and second["tweet_urls"] == ["u"]
    assert second["tweet_retweeted_user_id"] == "7" and second["tweet_coordinates"] == [1.5, -2.5]
    assert json.loads(second["tweet_place"]) == {"id": "p1", "full_name": "Town", "bounding_box": {"coordinates": [[[1, 2]]]}}


def test_audit_finds_files_that_gave_nothing(spark, tmp_path):
    write_bz2_array(tmp_path / "a.json.bz2", [raw_post("1")])
    (tmp_path / "b.json.bz2").write_bytes(b"not bz2 at all")
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "false")
    landing.skip_corrupt_files(spark)
    try:
        raw = landing.marked(landing.read_landing(spark, str(tmp_path), RAW_POST))
        audit = landing.audit_files(spark, str(tmp_path), raw).select(
            landing.file_name().alias("name"), "n_bytes", "n_records"
        )
        found = {row["name"]: (row["n_bytes"], row["n_records"]) for row in audit.collect()}
    finally:
        spark.conf.unset("spark.sql.files.ignoreCorruptFiles")
    assert found["a.json.bz2"][1] == 1 and found["b.json.bz2"] == (14, 0)


def test_inferred_schema_of_a_sample(spark, tmp_path):
    write_bz2_array(tmp_path / "a.json.bz2", [raw_post("1"), raw_post("2", place={"id": "p"})])
    fields = drift.inferred(landing.read_elements(spark, str(tmp_path)), depth=1)
    found = {r["path"]: r["ddl"] for r in fields.select("path", drift.as_ddl("schema").alias("ddl")).collect()}
    assert found["$.place"] == "struct<id:string>" and found["$.entities"] == "struct<urls:array<void>,user_mentions:array<void>>"
    assert "id_str:string" in found["$.user"] and found["$"].startswith("struct<created_at:string,")


def test_json_is_rolled(spark, tmp_path):
    sinks.write_json(spark.range(10), f"{tmp_path}/out", max_records=4)
    files = sorted(tmp_path.glob("out/*.json.bz2"))
    assert len(files) == 3 and spark.read.json(f"{tmp_path}/out").count() == 10


def test_one_directory_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    """A task compresses a bounded share, whatever the session's advisory size is; that stays as it was."""
    monkeypatch.setattr(sinks, "JSON_TASK_BYTES", 100_000)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    own = spark.conf.get(key)
    posts = spark.range(20_000, numPartitions=8).selectExpr("id", "sha2(CAST(id AS string), 256) AS text", "'XA' AS country")
    sinks.write_json(posts, f"{tmp_path}/out", columns=["country"])
    assert len(list(tmp_path.glob("out/country=XA/*.bz2"))) > 4 and spark.conf.get(key) == own
    assert spark.read.json(f"{tmp_path}/out").distinct().count() == 20_000


def test_file_count(spark, tmp_path):
    sinks.write_table(spark.range(1000), f"{tmp_path}/t", n_files=3)
    assert len(list(tmp_path.glob("t/*.parquet"))) == 3
    sinks.write_table(spark.range(1000).coalesce(1), f"{tmp_path}/u", rows_per_file=400)
    assert len(list(tmp_path.glob("u/*.parquet"))) == 3


def test_files_of_a_size(spark, tmp_path):
    """Narrow and wide rows, however they lie, come in files of the size asked for."""
    wide = spark.range(40_000, numPartitions=3).selectExpr("id", "sha2(CAST(id AS string), 256) AS text")
    for name, df, size in (("narrow", spark.range(300_000, numPartitions=7), 200_000), ("wide", wide, 300_000)):
        n_files = sinks.write_sized(df, f"{tmp_path}/{name}", file_bytes=size)
        sizes = [f.stat().st_size for f in tmp_path.glob(f"{name}/*.parquet")]
        assert len(sizes) == n_files > 3 and all(size / 2 <= s <= 2 * size for s in sizes)
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == df.count()
    assert sinks.write_sized(spark.range(0), f"{tmp_path}/none") == 1


def test_partitioned_write_replaces_only_its_partitions(spark, tmp_path, rows, bag):
    path = f"{tmp_path}/t"
    schema = "id string, country_short string"
    sinks.write_partitioned(rows(schema, ("1", "XA"), ("2", "XB")), path, ["country_short"])
    sinks.write_partitioned(rows(schema, ("3", "XB")), path, ["country_short"])
    assert bag(tables.read_table(spark, path, ["id", "country_short"])) == [("1", "XA"), ("3", "XB")]


def test_friend_lists(spark, tmp_path, bag):
    (tmp_path / "a.json").write_text(json.dumps({"1": ["2", "3"], "4": []}))
    (tmp_path / "b.json").write_text(json.dumps({"1": ["2"]}))
    (tmp_path / "broken").write_text('{"1": ["2"')
    with pytest.raises(Exception, match="MALFORMED"):
        tables.read_friend_lists(spark, f"{tmp_path}/broken").collect()
    lists = tables.read_friend_lists(spark, f"{tmp_path}/*.json")
    assert bag(lists.select("user_id", F.size("friend_ids"))) == [("1", 1), ("1", 2), ("4", 0)]
    assert bag(links.friend_edges(lists)) == [("1", "2"), ("1", "2"), ("1", "3")]
    assert bag(links.friend_edges(lists, distinct=True)) == [("1", "2"), ("1", "3")]


def test_ids_csv_keeps_text(spark, tmp_path, rows, bag):
    sinks.write_ids_csv(rows("user_id string", ("007",), ("12345678901234567890",)), f"{tmp_path}/ids")
    assert bag(tables.read_ids_csv(spark, f"{tmp_path}/ids")) == [("007",), ("12345678901234567890",)]
    (tmp_path / "other.csv").write_text("0\n007\n")
    assert bag(tables.read_ids_csv(spark, f"{tmp_path}/other.csv")) == [("007",)]


def test_user_columns():
    assert len(USER_COLUMNS) == 17 and USER_COLUMNS[0] == "user_timestamp"
