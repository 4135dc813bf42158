"""Spark session settings and the shared folder for cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(app_name: str = "cohortgraph", **conf: str) -> SparkSession:
    """Session with the settings the results depend on.

    Only UTC matters for correctness. Adaptive execution sizes and splits the
    shuffle partitions, so the initial width is left to the cluster
    (``spark.sql.shuffle.partitions``: about shuffle bytes / 128 MB).
    Keyword arguments use ``_`` for ``.``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone; epoch and month arithmetic assume it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the jobs that are run inside; afterwards they are as before."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, ready for ``checkpoint()``.

    Taken from ``spark.checkpoint.dir`` (or an earlier ``setCheckpointDir``).
    A folder of our own is made only in local mode, where there is one machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            configured = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(configured)
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder, if nothing lies there yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Rows written to the shared folder as Parquet, for a result that several branches read:
    lineage ends here, a lost executor costs a re-read, and readers prune columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates that are taken while it is written.

    Observe the very rows that are written, with no shuffle between: Spark adds up the tasks of a
    job's last stage once each, but those of earlier stages again if a lost executor repeats them.
    """
    seen = Observation()
    return df.observe(seen, *(value.alias(name) for name, value in counts.items())), seen


def materialize_counted(df: DataFrame, counts: Mapping[str, Column], name: str = "table") -> tuple[DataFrame, dict]:
    """As ``materialize``, with the ``counts`` of what was written, without a second read."""
    df, seen = observed(df, counts)
    return materialize(df, name), seen.get
