"""What the operators of this package share: words, folds, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.session import materialize as keep  # noqa: F401  (tables in the shared folder)

#: White space between words, and a word, as Java and RE2 patterns.
GAP_CLASS = r"[\x20\x09-\x0D]"
GAP = GAP_CLASS + "+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, not once for each use in a lambda."""
    return F.transform(F.array(value), body)[0]


def unsent(df: DataFrame) -> DataFrame:
    """``df`` as one side of a join that broadcasts neither: for tables that grow with the input.

    Spark sizes them too low, after an explode (a row for a row) or by their compressed files, and the
    driver would hold them whole.
    """
    return df.hint("merge")


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda x: x != "")


def content_key() -> Column:
    """Tells texts of one id apart; repeated rows share it."""
    return F.xxhash64("doc_id", "text")


def fold(modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus



#: Columns that a stage knows by name.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def guarded(stage: Stage) -> Stage:
    """A stage that returns the columns of its input: whatever the others are called, it sees them under
    names that none of its own has, and they come back under theirs."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        safe = [c if c in KNOWN else f"extra{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*safe), sf_dir).toDF(*docs.columns)

    return run
