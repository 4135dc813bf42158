"""Rules on planted documents; the whole result is compared with SQL in test_queries."""

import random

from pyspark.sql import functions as F

from cohortgraph.llm.common import documents
from cohortgraph.llm.quality_rules import judged, measured, quality_filter, stage, thresholds

SF_DIR = "/root/testdata/sf0.001"


def test_junk_goes_and_clean_documents_stay(spark):
    draw = random.Random(1)
    text = lambda: " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(120)) + "."
    clean = [(i, text()) for i in range(400)]
    junk = [" ".join(w + "###" for w in text().split()), text().upper(), "same line of words here\n" * 30, "spam ham eggs " * 40, "few words"]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", 0) for i, t in [*clean, *((1000 + i, t) for i, t in enumerate(junk))]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = stage(spark, docs, "")
    assert found.columns == docs.columns and {r.doc_id for r in found.collect()} == {i for i, _ in clean}


def test_stage_on_odd_documents(spark, odd_documents):
    assert stage(spark, odd_documents, "").collect() == []
    assert stage(spark, odd_documents.limit(0), "").collect() == []


def shouting(spark, groups):
    """Documents of 60 words of five letters; for each (lang, source, n, share), n with that share of capital words."""
    words = ["GREEN" if i % 10 < share else "green" for share in range(11) for i in range(60)]
    rows = []
    for lang, source, n, share in groups:
        own = words[60 * share : 60 * share + 60]
        rows += [(len(rows) + i, " ".join(f"{w}{chr(97 + k // 26)}{chr(97 + k % 26)}" for k, w in enumerate(own)), lang, source, 0) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def kept_by_group(spark, groups):
    docs = shouting(spark, groups)
    limits = thresholds(measured(docs))
    found = judged(measured(docs), limits).groupBy("lang", "source").agg(F.avg(F.col("_kept").cast("int")).alias("kept"))
    return {(r.lang, r.source): r.kept for r in found.collect()}, {(r.lang_key, r.source_key): r.limit_capitals for r in limits.collect()}


def test_a_sketch_changes_a_verdict(spark):
    """The same text passes where its language writes so, and fails where it doesn't."""
    plain = [("en", s, 900, 0) for s in "abc"]
    kept, limits = kept_by_group(spark, [*plain, ("en", "d", 20, 1), ("de", "a", 900, 1), ("de", "b", 900, 0)])
    assert kept[("de", "a")] == 1 and kept[("en", "d")] == 0
    assert limits[("de", "a")] > limits[("en", "d")] >= 30


def test_a_source_of_junk_sets_no_standard_of_its_own(spark):
    kept, limits = kept_by_group(spark, [("en", "a", 1500, 0), ("en", "b", 1500, 0), ("en", "junk", 120, 7)])
    assert kept == {("en", "a"): 1, ("en", "b"): 1, ("en", "junk"): 0}
    assert limits[("en", "junk")] <= 2 * limits[("en", "a")]


def test_small_groups_borrow(spark):
    _, limits = kept_by_group(spark, [("en", "a", 600, 0), ("en", "b", 3, 1), ("fr", "a", 2, 1)])
    assert limits[("en", "b")] <= limits[("en", "a")] * 1.02 and limits[("fr", "a")] <= limits[("en", "a")] * 1.02


def test_limits_of_sources_are_not_broadcast(spark):
    """They are four rows a source, of which there may be as many as sites; those of languages are few."""
    limits = thresholds(measured(documents(spark, SF_DIR).select("text", "lang", "source")))
    plan = limits._jdf.queryExecution().executedPlan().toString()
    assert [line for line in plan.splitlines() if "SortMergeJoin" in line and "lang_key" in line and "measure" in line]
    assert plan.count("BroadcastExchange") <= 1 < limits.count()


def test_each_text_is_measured_once_a_pass(spark):
    plan = quality_filter(documents(spark, SF_DIR))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") == 1
