"""Country of a free-text location, through the location table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph.operators.sizing import BROADCAST_LIMIT_BYTES, text_bytes


def unique_locations(locations: DataFrame) -> DataFrame:
    """One country per location; doubled locations would multiply the joined rows.
    The least country name wins, a null country loses."""
    return (
        locations.where(F.col("user_location").isNotNull())
        .groupBy("user_location")
        .agg(F.min("country_short").alias("country_short"))
    )


def attach_country(
    df: DataFrame,
    locations: DataFrame,
    how: str = "left",
    countries: Sequence[str] | None = None,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Join ``country_short`` on ``user_location``.

    ``how="left"`` keeps unknown and null locations with a null country,
    ``"inner"`` drops them; ``countries`` limits the locations before they are joined.
    The location table is measured first: up to ``broadcast_limit`` bytes it is
    broadcast. Beyond, both sides are shuffled on the location. Rows without one can match
    nothing: they go round the join (left) or are dropped before it (inner). A location that
    many rows share is split by adaptive execution, which repeats only that location's row.
    """
    locations = locations.select("user_location", "country_short")
    resolved = unique_locations(locations)
    if countries is not None:
        resolved = resolved.where(F.col("country_short").isin(list(countries)))
    if text_bytes(locations) <= broadcast_limit:
        return df.join(F.broadcast(resolved), "user_location", how)
    located = df.where(F.col("user_location").isNotNull()).join(resolved, "user_location", how)
    if how == "inner":
        return located
    nowhere = df.where(F.col("user_location").isNull())
    return located.unionByName(nowhere.withColumn("country_short", F.lit(None).cast("string")))
