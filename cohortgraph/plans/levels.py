"""Breadth-first levels around the seeds, inside each country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph.operators.sizing import fits
from cohortgraph.session import materialize


def country_edges(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct mention edges (country, user, neighbor) with both ends in one country of
    ``users`` (user_id, country_short; one row each).

    Users are measured first. If they fit a broadcast, both ends are tested map-side and
    only edges inside a country are shuffled. Otherwise edges are made distinct first:
    repeated mentions are combined map-side and the pair is the shuffle key, so neither a
    prolific author nor a celebrity forms a hot partition; the membership tests are then
    joins of plain shuffles, the form in which adaptive execution splits a skewed side.
    """
    few_users = fits(users)
    sources, targets = users, users.withColumnRenamed("user_id", "neighbor_id")
    if few_users:
        sources, targets = F.broadcast(sources), F.broadcast(targets)
    mentions = posts.select("user_id", "tweet_mentioned_user_id")
    if few_users:
        edges = mentions.join(sources, "user_id").select(
            "country_short", "user_id", F.explode("tweet_mentioned_user_id").alias("neighbor_id")
        )
        inside = edges.join(targets, ["neighbor_id", "country_short"], "left_semi")
        return inside.select("country_short", "user_id", "neighbor_id").distinct()
    edges = mentions.select("user_id", F.explode("tweet_mentioned_user_id").alias("neighbor_id"))
    edges = edges.where(F.col("user_id").isNotNull() & F.col("neighbor_id").isNotNull()).distinct()
    return (
        edges.join(sources, "user_id")
        .join(targets, ["neighbor_id", "country_short"], "left_semi")
        .select("country_short", "user_id", "neighbor_id")
    )


def level_members(
    posts: DataFrame, profiles: DataFrame, seeds: DataFrame, countries: Sequence[str], depth: int = 4
) -> DataFrame:
    """(country, user, level): seeds at 0, users first reached in k steps inside the country at k.

    All countries are searched together, with one scan of the posts. Runs at most ``depth``
    rounds and stops when a round finds nobody new. Edges and each level are written to the
    shared folder, so every round starts from files: plans do not grow and nothing is
    recomputed. A frontier is broadcast only if it is measured small enough.
    """
    key = ["country_short", "user_id"]
    users = materialize(
        profiles.where(F.col("country_short").isin(list(countries))).select("user_id", "country_short").distinct(), "users"
    )
    edges = materialize(country_edges(posts, users), "edges")
    reached = users.join(seeds.select("user_id"), "user_id", "left_semi").select(*key)
    frontier = members = materialize(reached.withColumn("level", F.lit(0)), "level")
    for level in range(1, depth + 1):
        if frontier.isEmpty():
            break
        sources = frontier.select(*key)
        if fits(sources):
            sources = F.broadcast(sources)
        targets = edges.join(sources, key, "left_semi")
        targets = targets.select("country_short", F.col("neighbor_id").alias("user_id")).distinct()
        fresh = targets.join(members, key, "left_anti")
        frontier = materialize(fresh.withColumn("level", F.lit(level)), "level")
        members = members.unionByName(frontier)
    return members


def level_counts(members: DataFrame, countries: Sequence[str], depth: int = 4) -> DataFrame:
    """A row for each country: ``n_seeds`` and ``n_snowball_1`` … ``n_snowball_<depth>``, 0 where nobody is."""
    names = ["n_seeds", *[f"n_snowball_{level}" for level in range(1, depth + 1)]]
    asked = members.sparkSession.createDataFrame([(c,) for c in dict.fromkeys(countries)], "country_short string")
    counts = [F.count_if(F.col("level") == level).alias(name) for level, name in enumerate(names)]
    found = members.groupBy("country_short").agg(*counts)
    return asked.join(found, "country_short", "left").fillna(0, names)


def level_stats(
    posts: DataFrame, profiles: DataFrame, seeds: DataFrame, countries: Sequence[str], depth: int = 4
) -> DataFrame:
    """Size of every level of every country, counted in one job."""
    return level_counts(level_members(posts, profiles, seeds, countries, depth), countries, depth)
