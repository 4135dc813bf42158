import pytest

from cohortgraph.llm import queries

ODD_TEXTS = [None, "", " \n\t ", "a", "one two", "x " * 30_000, "\n\n", "Same text here. " * 5, "Same text here. " * 5, "§ 🙂 ", "1 2 3"]


@pytest.fixture
def odd_documents(spark):
    """Null ids, languages and sources, empty and very long texts, repeated rows, a clashing extra column."""
    rows = [(i if i != 4 else None, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s1", None, 7) for i, t in enumerate(ODD_TEXTS)]
    rows.append(rows[7])
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long"
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def tables(tmp_path):
    """A folder with the given DataFrames as tables."""

    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


@pytest.fixture
def run(spark):
    return lambda name, sf_dir: queries.QUERIES[name](spark, sf_dir)
