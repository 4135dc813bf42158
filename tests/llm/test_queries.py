"""Every query on the given tables against its SQL, and on odd and empty tables."""

import os

import pytest

from cohortgraph.llm.queries import ORACLE_SQL, QUERIES
from tests.comparing import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE_SQL[name]) == []


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


PAGE = "page_id long, url string, html string, text int"
OTHER_TABLES = {"op3_line_blocks", "op11_hard_negatives", "op13_chat_format"}
BY_DOCUMENT = sorted(set(QUERIES) - {"op1_packing", "op12_filter_audit", *OTHER_TABLES})


@pytest.mark.parametrize("name", BY_DOCUMENT)
def test_one_row_for_each_odd_document(spark, run, tables, odd_documents, name):
    labels = spark.createDataFrame([(0, None, 0), (3, 1, 0), (3, 0, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
    found = run(name, tables(documents=odd_documents, labels=labels)).collect()
    ids = lambda rows: sorted((r.doc_id is None, r.doc_id or 0) for r in rows)
    assert ids(found) == ids(odd_documents.collect())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OTHER_TABLES))
def test_empty_tables(spark, run, tables, odd_documents, name):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert run(name, tables(documents=odd_documents.limit(0), labels=labels)).collect() == []


def test_empty_and_odd_pages(spark, run, tables):
    rows = [(1, None, None, 1), (2, "u", "", 1), (2, "u", "", 1), (None, "v", "<p>a<script>x", 1)]
    found = run("op3_line_blocks", tables(pages=spark.createDataFrame(rows, PAGE))).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found) == [(0, "a", 1), (1, "", 0), (2, "", 0), (2, "", 0)]


def test_empty_vectors_and_conversations(spark, run, tables):
    folder = tables(
        embeddings=spark.createDataFrame([], "vec_id long, embedding array<float>, label int"),
        conversations=spark.createDataFrame([], "conv_id long, turn long, role string, text string"),
    )
    assert run("op11_hard_negatives", folder).collect() == []
    assert [(r.conv_id, r.n_turns) for r in run("op13_chat_format", folder).collect()] == [(-7, 2)]
