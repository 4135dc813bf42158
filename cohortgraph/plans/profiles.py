"""Newest profile of each user, geocoded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph.functions.columns import flatten_users, numeric_id
from cohortgraph.operators.geocode import attach_country
from cohortgraph.operators.survivors import drop_copies, greatest_and_totals
from cohortgraph.schemas import PROFILE_COLUMNS, USER_COLUMNS


def latest_posts(posts: DataFrame) -> DataFrame:
    """Each user's newest post plus ``tweet_count``; equal times go to the greatest id.

    Users whose post times are all null have no newest post and drop out, while
    posts without a time still count for the others.
    """
    return greatest_and_totals(
        posts.where(F.col("user_id").isNotNull()),
        ["user_id"],
        order=[F.col("tweet_timestamp"), numeric_id("tweet_id"), F.col("tweet_id")],
        where=F.col("tweet_timestamp").isNotNull(),
        totals=[F.count("tweet_id").alias("tweet_count")],
    )


def timeline_profiles(posts: DataFrame, locations: DataFrame) -> DataFrame:
    """Profile as of the newest post. Geocoding comes last: one row per user is left by then."""
    narrow = posts.select("tweet_id", "tweet_timestamp", *USER_COLUMNS)
    return attach_country(latest_posts(narrow), locations).select(*PROFILE_COLUMNS)


def users_profiles(raw_users: DataFrame, locations: DataFrame) -> DataFrame:
    """Looked-up users, one row per (user, location): the newest status, then the greatest id."""
    users = drop_copies(
        flatten_users(raw_users),
        ["user_id", "user_location"],
        [F.col("tweet_timestamp"), numeric_id("tweet_id"), F.col("user_statuses_count")],
    )
    columns = [name for name in PROFILE_COLUMNS if name != "tweet_count"]
    return attach_country(users, locations).select(*columns)
