"""Choosing whom to pull from a batch, and which posts are new."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgraph.functions.columns import numeric_id
from cohortgraph.operators.shards import assign_shards
from cohortgraph.operators.survivors import keep_greatest
from cohortgraph.session import materialize, materialize_counted, observed


def in_countries(countries: Sequence[str]) -> Column:
    return F.col("country_short").isin(list(countries))


def pull_type_of() -> Column:
    """``update`` for users with a last post (time and id both known), ``full`` for all others."""
    known = F.col("tweet_timestamp").isNotNull() & F.col("tweet_id").isNotNull()
    return F.when(known, "update").otherwise("full")


def of_pull_type(pull_type: str) -> Column:
    if pull_type not in ("full", "update"):
        raise ValueError(f"pull type is full or update, not {pull_type!r}")
    return pull_type_of() == pull_type


def _bound(text: str) -> Column:
    day = re.fullmatch(r"(\d{1,2})/(\d{1,2})/(\d{4})", text)
    if day:
        text = f"{day[3]}-{day[1]}-{day[2]}"
    return F.lit(text).cast("timestamp")


def in_window(min_timestamp: str | None = None, max_timestamp: str | None = None) -> Column:
    """Last post strictly after ``min_timestamp`` and strictly before ``max_timestamp``:
    ISO times or month/day/year."""
    condition = F.lit(True)
    if min_timestamp:
        condition &= F.col("tweet_timestamp") > _bound(min_timestamp)
    if max_timestamp:
        condition &= F.col("tweet_timestamp") < _bound(max_timestamp)
    return condition


def not_seed() -> Column:
    return F.col("is_seed") == 0


def work_filters(
    countries: Sequence[str],
    pull_type: str,
    min_timestamp: str | None = None,
    max_timestamp: str | None = None,
    drop_seeds: bool = False,
) -> dict[str, Column]:
    """The filters of a work list, named and in order. Time bounds apply to updates only."""
    filters = {"in_countries": in_countries(countries), pull_type: of_pull_type(pull_type)}
    if pull_type == "update" and max_timestamp:
        filters["before_max"] = in_window(max_timestamp=max_timestamp)
    if pull_type == "update" and min_timestamp:
        filters["after_min"] = in_window(min_timestamp=min_timestamp)
    if drop_seeds:
        filters["not_seed"] = not_seed()
    return filters


def select_and_count(batch: DataFrame, filters: dict[str, Column]) -> tuple[DataFrame, dict]:
    """``select_users``, written out, and the counts of ``metrics.filter_funnel``, from one read of the batch.

    Rows left by each filter are counted while those that pass all are written, users while the
    chosen ones are.
    """
    counts, passed = {"n_all": F.count(F.lit(1))}, F.lit(True)
    for name, condition in filters.items():
        passed = passed & condition
        counts[f"n_{name}"] = F.count_if(passed)
    # The rows are counted before the filter, in the same stage.
    seen, observation = observed(batch, counts)
    left = materialize(seen.where(passed), "left")
    users, n_users = materialize_counted(select_users(left, {}), {"n_unique": F.count("user_id")}, "users")
    return users, observation.get | n_users


def select_users(batch: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """Rows passing all filters, one per user: the newest last post, then the greatest
    country, of users listed in several countries."""
    for condition in filters.values():
        batch = batch.where(condition)
    order = [F.col("tweet_timestamp"), numeric_id("tweet_id"), F.col("country_short")]
    return keep_greatest(batch, ["user_id"], order)


def select_work(
    batch: DataFrame, countries: Sequence[str], pull_type: str, n_shards: int, seed: int = 0, **options
) -> DataFrame:
    """The work list of a pull: filtered, one row per user, shuffled and sharded per
    country. ``options`` are those of ``work_filters``.

    The chosen users are written out once, because counting and numbering the shuffled
    list read them separately.
    """
    users = select_users(batch, work_filters(countries, pull_type, **options))
    return assign_shards(materialize(users, "users"), n_shards, seed=seed)


def head(users: DataFrame, n: int = 5, key: str = "user_id") -> DataFrame:
    """The first ``n`` rows by id, for a look at a work list. Every task keeps only its own
    first ``n``."""
    return users.orderBy(key).limit(n)


def newer_than_mark(posts: DataFrame, marks: DataFrame) -> DataFrame:
    """Posts newer than their author's stored mark (``marks``: user_id, tweet_id); authors
    without a mark keep all posts.

    "No mark at or above this id" is an anti join, so doubled marks cannot multiply
    posts and the marks need no aggregation first; adaptive execution can then split
    the posts of a prolific author.
    """
    stored = marks.select(F.col("user_id").alias("mark_user"), numeric_id("tweet_id").alias("mark"))
    seen = (F.col("user_id") == F.col("mark_user")) & (numeric_id(posts["tweet_id"]) <= F.col("mark"))
    return posts.join(stored, seen, "left_anti")
