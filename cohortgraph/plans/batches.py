"""Work lists: who to look up, whose posts to pull, whose friends to list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph.functions.columns import epoch_to_timestamp, numeric_id
from cohortgraph.operators.idsets import union_minus
from cohortgraph.session import materialize


def users_batch(seeds: DataFrame, snowball: DataFrame, known: DataFrame) -> DataFrame:
    """Users to look up: seeds and snowballed users without a looked-up profile."""
    return union_minus([seeds, snowball], [known])


def network_batch(profiles: DataFrame, friend_lists: DataFrame, country: str) -> DataFrame:
    """Users of a country whose friend list is not stored. Profiles carry the country."""
    return union_minus([profiles.where(F.col("country_short") == country)], [friend_lists])


def network_batches(profiles: DataFrame, lists: DataFrame, countries: Sequence[str]) -> DataFrame:
    """(country, user) of several countries at once: users whose list is not stored for that country.

    ``lists`` holds (country_short, user_id). Profiles are read once, whatever the number of countries.
    """
    users = profiles.where(F.col("country_short").isin(list(countries)))
    return union_minus([users], [lists], "country_short", "user_id")


def timeline_batch(profiles: DataFrame, lookups: DataFrame, seeds: DataFrame) -> DataFrame:
    """Users to pull: (user, country, last post, ``is_seed``), one row per user.

    Geocoded timelines come first; a looked-up user enters only without one, with
    the country of the newest lookup and no last post. The three tables are stacked
    and reduced per user in one aggregation, which stands for the anti, outer and
    left joins: each would shuffle the users again.
    """
    geocoded = F.col("country_short").isNotNull()
    timelines = profiles.where(geocoded).select(
        "user_id",
        F.lit(2).alias("source"),
        "country_short",
        "tweet_id",
        epoch_to_timestamp("tweet_timestamp").alias("tweet_timestamp"),
    )
    looked_up = lookups.where(geocoded).select(
        "user_id",
        F.lit(1).alias("source"),
        "country_short",
        F.col("tweet_timestamp").alias("seen_at"),
        numeric_id("tweet_id").alias("seen_id"),
    )
    flags = seeds.where(F.col("user_id").isNotNull()).select("user_id", F.lit(1).cast("int").alias("is_seed"))
    # Null ids match nothing, so the sources must not merge on them.
    null_source = F.when(F.col("user_id").isNull(), F.col("source")).alias("null_source")
    order = F.when(F.col("source").isNotNull(), F.struct("source", "seen_at", "seen_id", "country_short"))
    row = F.struct("country_short", "tweet_id", "tweet_timestamp")
    users = (
        timelines.unionByName(looked_up, allowMissingColumns=True)
        .unionByName(flags, allowMissingColumns=True)
        .groupBy("user_id", null_source)
        .agg(F.max_by(row, order).alias("row"), F.max("is_seed").alias("is_seed"))
    )
    return users.where(F.col("row").isNotNull()).select("user_id", "row.*", "is_seed").fillna(0, ["is_seed"])


def timeline_batch_v1(profiles: DataFrame, lookups: DataFrame, snowball: DataFrame) -> DataFrame:
    """Users to pull, every country they are geocoded in or snowballed from.

    Snowballed pairs carry ``n_users``; a pair that is also geocoded does not. Pairs
    are reduced in one aggregation, then the last post is attached by user. Profiles are
    used on both ways, so they are written out once.
    """
    profiles = materialize(profiles.select("user_id", "country_short", "tweet_id", "tweet_timestamp"), "profiles")
    geocodes = (
        profiles.select("user_id", "country_short")
        .unionByName(lookups.select("user_id", "country_short"))
        .select("user_id", "country_short", F.lit(None).cast("long").alias("n_users"), F.lit(True).alias("geocoded"))
    )
    candidates = snowball.select("user_id", "country_short", "n_users", F.lit(False).alias("geocoded"))
    pairs = (
        geocodes.unionByName(candidates)
        .where(F.col("country_short").isNotNull())
        .groupBy("user_id", "country_short")
        .agg(F.max("n_users").alias("n_users"), F.bool_or("geocoded").alias("geocoded"))
        .select("user_id", "country_short", F.when(~F.col("geocoded"), F.col("n_users")).alias("n_users"))
    )
    last_posts = profiles.select(
        "user_id", "tweet_id", epoch_to_timestamp("tweet_timestamp").alias("tweet_timestamp")
    )
    return pairs.join(last_posts, "user_id", "left")


def remaining_batch(batch: DataFrame, pulled: DataFrame) -> DataFrame:
    """Batch rows whose user has no freshly pulled post.

    Pulled users are made distinct before the join: the copies are combined map-side,
    and a prolific author cannot swell one task.
    """
    return batch.join(pulled.select("user_id").distinct(), "user_id", "left_anti")
