"""Size checks that decide between a broadcast and a shuffled join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast relation is held by the driver and every executor.
BROADCAST_LIMIT_BYTES = 64 << 20
# What a hashed row costs beyond its text.
ROW_OVERHEAD_BYTES = 64


def text_bytes(df: DataFrame) -> int:
    """Measured size of a table of text columns; one scan, one number to the driver."""
    width = sum((F.coalesce(F.octet_length(name), F.lit(0)) for name in df.columns), F.lit(ROW_OVERHEAD_BYTES))
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]


def fits(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether a table of text columns is measured small enough."""
    return text_bytes(df) <= limit
