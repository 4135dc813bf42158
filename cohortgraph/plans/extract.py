"""Raw posts to the clean post table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph.functions.columns import flatten_posts
from cohortgraph.operators.survivors import drop_copies


def extract_posts(raw: DataFrame) -> DataFrame:
    """Flatten, parse times, drop records without an id, keep one row per post.

    A post pulled several times differs in its author's counters; the copy with
    the most statuses (the latest pull) is kept.
    """
    posts = flatten_posts(raw).where(F.col("tweet_id").isNotNull())
    return drop_copies(posts, ["tweet_id"], [F.col("user_statuses_count")])
