"""Growing the sample along interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph.operators.geocode import attach_country


def interaction_edges(posts: DataFrame, *keep: str) -> DataFrame:
    """One row per (post, target): everyone mentioned, reposted or replied to.

    A bag: a target named twice in a post counts twice. One scan feeds all three
    kinds of edge.
    """
    no_ids = F.array().cast("array<string>")
    targets = F.concat(
        F.coalesce("tweet_mentioned_user_id", no_ids),
        F.array("tweet_retweeted_user_id", "tweet_in_reply_to_user_id"),
    )
    edges = posts.select(*keep, F.explode(targets).alias("neighbor_id"))
    return edges.where(F.col("neighbor_id").isNotNull())


def snowball(posts: DataFrame, locations: DataFrame, distinct_authors: bool = False) -> DataFrame:
    """Candidates for the sample: (target, country of the author, ``n_users``).

    ``n_users`` counts interactions; ``distinct_authors=True`` counts authors.
    Posts are geocoded before their targets are exploded, so fewer rows meet the
    location table. Unresolved locations form the null-country group. Counts are
    combined map-side, so a celebrity target reaches the reducer as one row per task.
    """
    narrow = posts.select(
        "tweet_id",
        "user_id",
        "user_location",
        "tweet_mentioned_user_id",
        "tweet_retweeted_user_id",
        "tweet_in_reply_to_user_id",
    )
    edges = interaction_edges(attach_country(narrow, locations), "user_id", "country_short")
    count = F.count_distinct("user_id") if distinct_authors else F.count("user_id")
    return (
        edges.groupBy("neighbor_id", "country_short")
        .agg(count.alias("n_users"))
        .withColumnRenamed("neighbor_id", "user_id")
    )
