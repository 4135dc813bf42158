"""Documents to packed training sequences: filter, de-duplicate, mix, pack.

``STAGES`` are applied in order; each function takes (spark, docs, sf_dir) and returns a
DataFrame, written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortgraph.llm import lines, minhash, mixing, packing, quality_rules
from cohortgraph.llm.common import documents, keep

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("near_duplicates", minhash.stage),
    ("substring_dedup", lines.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]

#: The last stage tokenizes, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
