"""Links in posts and friend lists of users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph.operators.geocode import attach_country


def post_urls(
    posts: DataFrame,
    locations: DataFrame,
    countries: Sequence[str],
    all_urls: bool = False,
    unique_posts: bool = True,
) -> DataFrame:
    """(post, url, country) of posts by users of ``countries``; the first link of each
    post, or every link with ``all_urls``.

    The countries are filtered on the location table, before the join. The post table
    has one row per id, so no shuffle is needed; for other inputs ``unique_posts=False``
    keeps one row per post.
    """
    narrow = posts.select("tweet_id", "user_location", "tweet_urls").where(F.size("tweet_urls") > 0)
    located = attach_country(narrow, locations, how="inner", countries=countries)
    if all_urls:
        return located.select("tweet_id", F.explode("tweet_urls").alias("url"), "country_short")
    first = located.select("tweet_id", F.get("tweet_urls", F.lit(0)).alias("url"), "country_short")
    if unique_posts:
        return first
    least = F.min(F.struct("url", "country_short")).alias("row")
    return first.groupBy("tweet_id").agg(least).select("tweet_id", "row.url", "row.country_short")


def friend_edges(friend_lists: DataFrame, distinct: bool = False) -> DataFrame:
    """(user, friend) rows of stored friend lists; an empty list gives none.

    ``distinct`` merges users listed in several files.
    """
    edges = friend_lists.select("user_id", F.explode("friend_ids").alias("friend_id"))
    return edges.distinct() if distinct else edges


def follow_edges(friend_lists: DataFrame, follower_lists: DataFrame, *by: str) -> DataFrame:
    """Distinct (follower_id, followed_id) of friend and follower lists, inside the columns ``by``.

    A user follows their friends and is followed by their followers. A pair that both lists
    tell of is one edge; the copies are combined map-side, and the pair is the shuffle key, so
    neither a long list nor a celebrity forms a hot partition.
    """
    friends = friend_lists.select(*by, F.col("user_id").alias("follower_id"), F.explode("friend_ids").alias("followed_id"))
    followers = follower_lists.select(*by, F.explode("friend_ids").alias("follower_id"), F.col("user_id").alias("followed_id"))
    return friends.unionByName(followers).distinct()
