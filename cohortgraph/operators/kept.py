"""Tables that pulls are added to, stored by key, so that merging and joining them moves no rows."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.session import make_folder

#: Buckets of a stored table; tables that are joined with each other have the same number.
N_BUCKETS = 64


@dataclass(frozen=True)
class KeptTable:
    """Partial results of pulls: a folder for each pull, in buckets of ``key``.

    A pull has at most one row for a key, so no key is hot, and adding it again replaces it: a job that
    is repeated counts nothing twice. All files of a bucket are read by one task, so a reduction
    by the key, or a join with another table of the same buckets, needs no exchange. ``columns`` is
    the schema without ``pull``. The table is known by its path; a new session attaches to it.
    """

    spark: SparkSession
    path: str
    columns: str
    key: str = "user_id"
    n_buckets: int = N_BUCKETS

    @property
    def name(self) -> str:
        return f"kept_{hashlib.md5(f'{self.path} {self.n_buckets}'.encode()).hexdigest()}"

    def _attach(self) -> None:
        if self.spark.catalog.tableExists(self.name):
            return
        make_folder(self.spark, self.path)
        place = self.path.replace("'", "\\'")
        self.spark.sql(
            f"""CREATE TABLE {self.name} ({self.columns}, pull string) USING parquet PARTITIONED BY (pull)
                CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.n_buckets} BUCKETS LOCATION '{place}'"""
        )
        self.spark.catalog.recoverPartitions(self.name)

    def add(self, pull: str, partial: DataFrame) -> None:
        """Writes the rows of one pull, in place of what it had; nothing else is read or written.

        Rows are dealt by the key first, so each bucket gets one file.
        """
        self._attach()
        rows = partial.withColumn("pull", F.lit(pull)).select(*self.spark.table(self.name).columns)
        mode, setting = "dynamic", "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, mode)
        try:
            rows.repartition(self.n_buckets, self.key).write.mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set(setting, before)

    def read(self) -> DataFrame:
        """The rows of all pulls, with ``pull``."""
        self._attach()
        return self.spark.table(self.name)
