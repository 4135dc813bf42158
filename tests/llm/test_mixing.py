"""Targets, caps and totals of the mix; the whole result is compared with SQL in test_queries."""

import pytest
from pyspark.sql import functions as F

from cohortgraph.llm.mixing import op8_mixing, sizes, stage, taken_parts


def test_targets_and_caps(spark, tables):
    sizes = {"a": 40, "b": 4000, "c": 300, None: 2000}
    rows = [(i, " w" * 20, s, None) for s, n in sizes.items() for i in range(n // 20)]
    docs = spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(rows)], "doc_id long, text string, source string, taken int")
    found = op8_mixing(spark, tables(documents=docs)).collect()
    targets = {r.source_size: r.target for r in found}
    # a, c and the last source are capped at twice their size; b takes the rest of 150 %.
    assert targets == {40: 80.0, 300: 600.0, 2000: 4000.0, 4000: pytest.approx(1.5 * 6340 - 4680)}
    taken = {n: sum(r.taken for r in found if r.source_size == n) for n in targets}
    assert all(abs(taken[n] - targets[n]) <= max(4, 0.002 * n) for n in targets)
    assert all(r.taken <= 2 * r.size for r in found)


def test_stage_repeats_and_cuts(spark):
    docs = spark.createDataFrame(
        [(i, " ".join(f"w{i}x{j}" for j in range(1 + i % 70)), None, f"s{i % 3}", 0) for i in range(300)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    found = stage(spark, docs, "").cache()
    assert found.columns == docs.columns
    whole = {r.doc_id: r.text.split() for r in docs.collect()}
    for r in found.collect():
        words = iter(whole[r.doc_id])
        assert r.n_chars == len(r.text) and all(w in words for w in r.text.split())
    n = lambda df: df.agg(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0]
    assert n(found) == pytest.approx(1.5 * n(docs), rel=0.01)
    assert found.exceptAll(stage(spark, docs, "")).count() == 0


def test_blocks_and_slots_meet_in_a_shuffle(spark, tables):
    """Both are a row for each block of words, exploded from few rows: neither may be sent to the driver."""
    docs = spark.createDataFrame([(i, "w " * 3000, f"s{i % 2}") for i in range(40)], "_row long, text string, source string")
    _, parts = taken_parts(spark, sizes(docs.withColumn("doc_id", F.col("_row"))).drop("text"))
    plan = lambda: parts._jdf.queryExecution().executedPlan().toString()
    assert parts.agg(F.sum(F.col("end") - F.col("start"))).first()[0] > 0
    assert any("SortMergeJoin" in line and "block_no" in line for line in plan().splitlines())


def test_stage_on_odd_documents(spark, odd_documents):
    assert stage(spark, odd_documents, "").columns == odd_documents.columns
    assert stage(spark, odd_documents.limit(0), "").collect() == []
