"""Writing tables, JSON records and id lists."""

from __future__ import annotations

from collections.abc import Sequence

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph.session import scratch_path, settings

# About 100 MB of posts.
ROWS_PER_FILE = 1_000_000
FILE_BYTES = 128 << 20
# Shuffled bytes of a task that writes JSON: about 100,000 posts, 70 MB of text and 10 s of bzip2.
JSON_TASK_BYTES = 16 << 20


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    n_files: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Parquet table. Adaptive execution sizes the partitions of the last shuffle, and a
    task starts a new file after ``rows_per_file`` rows, so the file count follows the row
    count. ``n_files`` fixes it instead, at the price of one more, evenly spread, shuffle."""
    if n_files is not None:
        df = df.repartition(n_files)
    df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(path)


def written_bytes(spark, path: str) -> int:
    """Bytes of the Parquet files under ``path``, from the listing; one number to the driver."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    return listed.agg(F.sum("length")).first()[0] or 0


def write_sized(df: DataFrame, path: str, file_bytes: int = FILE_BYTES, mode: str = "overwrite") -> int:
    """Parquet table in files of about ``file_bytes``, whatever the width of its rows; gives their number.

    What a row takes as Parquet is not known before it is written, so the table is written to the
    shared folder first and its bytes are measured there; then the rows are dealt evenly over as many
    files as that takes. Costs a second write and a shuffle: meant for tables that are read often.
    """
    staged = scratch_path(df.sparkSession, "unsized")
    df.write.parquet(staged)
    n_files = max(1, ceil(written_bytes(df.sparkSession, staged) / file_bytes))
    rows = df.sparkSession.read.schema(df.schema).parquet(staged)
    rows.repartition(n_files).write.mode(mode).parquet(path)
    return n_files


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str], whole: bool = False) -> None:
    """One directory per value of ``columns``, in one pass; only the partitions written
    are replaced, or the ``whole`` table. Rebalancing gathers small partitions and splits
    large ones, so a dominant country becomes several files instead of one long task."""
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_json(
    df: DataFrame,
    path: str,
    max_records: int | None = None,
    compression: str = "bzip2",
    columns: Sequence[str] = (),
) -> None:
    """JSON Lines, a new file after ``max_records`` records, one directory per value of
    ``columns``. Rows are rebalanced first: bzip2 is slow, so every task gets at most about
    ``JSON_TASK_BYTES``, whatever the session's advisory size is, and as many tasks write as the data needs."""
    writer = df.hint("rebalance", *columns).write.mode("overwrite").option("compression", compression)
    if max_records is not None:
        writer = writer.option("maxRecordsPerFile", max_records)
    with settings(df.sparkSession, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{JSON_TASK_BYTES}b"}):
        (writer.partitionBy(*columns) if columns else writer).json(path)


def empty_partition(df: DataFrame, path: str, column: str, value: str) -> None:
    """Leave one partition of a table without rows; ``df`` has the table's columns."""
    df.drop(column).limit(0).write.mode("overwrite").parquet(f"{path}/{column}={value}")


def write_ids_csv(df: DataFrame, path: str, key: str = "user_id") -> None:
    """One id column with a header."""
    df.select(key).write.mode("overwrite").option("header", True).csv(path)
