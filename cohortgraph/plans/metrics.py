"""Counts that describe a batch, a pull or the pull files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cohortgraph.functions.columns import ceil_div
from cohortgraph.plans.worklist import pull_type_of

# Parts of a pull file name. Post files are named
# (friend and follower files have the same form under their own names)
#   user_timeline_<u>[_users][_<r>_requests][_<t>_tweets][_<CC>]_<date>_[…_]<full|update>_…
# user files lookup_users_<n>_<date>_…, friend files friends_ids_<CC>_<n>_users_<yyyy>_<mm>_<dd>_…
MANIFEST_PATTERNS = {
    "n_users": r"^user_timeline_(\d+)_|^lookup_users_(\d+)_|^(?:friends|followers)_ids_[A-Z]{2}_(\d+)_users_",
    "n_requests": r"_(\d+)_requests_",
    "n_tweets": r"_(\d+)_tweets_",
    "country_short": r"_([A-Z]{2})_",
    "pull_date": (
        r"^user_timeline_.*?_(?:[A-Z]{2}|tweets)_(\d{6}|\d{8})_"
        r"|^lookup_users_\d+_(\d{8})_"
        r"|_users_(\d{4}_\d{2}_\d{2})_"
    ),
    "pull_type": r"_(full|update)_",
}


def monthly_counts(df: DataFrame, timestamp: str, start: str | None = None, key: str = "user_id") -> DataFrame:
    """(month_end, n_users): rows per month between the first and last month, months
    without rows as 0; only months ending on or after ``start``.

    Rows are reduced to months in one pass. The months, a few hundred at most, become
    one map that the calendar looks itself up in.
    """
    month = F.trunc(timestamp, "month").alias("month")
    counts = df.where(F.col(timestamp).isNotNull()).groupBy(month).agg(F.count(key).alias("n_users"))
    span = counts.agg(
        F.min("month").alias("first"),
        F.max("month").alias("last"),
        F.map_from_entries(F.collect_list(F.struct("month", "n_users"))).alias("by_month"),
    )
    calendar = F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("month")
    months = span.select("by_month", calendar)
    result = months.select(
        F.last_day("month").alias("month_end"),
        F.coalesce(F.try_element_at("by_month", F.col("month")), F.lit(0)).alias("n_users"),
    )
    return result if start is None else result.where(F.col("month_end") >= F.lit(start).cast("date"))


def posts_per_user(posts: DataFrame) -> DataFrame:
    return posts.groupBy("user_id").agg(F.count("tweet_id").alias("n_tweets"))


def request_estimate(users: DataFrame, posts: DataFrame, page: int = 200) -> DataFrame:
    """(user_id, n_tweets, n_requests): pages needed per user, one for a user without posts."""
    n_tweets = F.coalesce("n_tweets", F.lit(0))
    return users.join(posts_per_user(posts), "user_id", "left").select(
        "user_id",
        n_tweets.alias("n_tweets"),
        F.greatest(F.lit(1), ceil_div(n_tweets, page)).cast("long").alias("n_requests"),
    )


def pull_coverage(batch: DataFrame, posts: DataFrame) -> DataFrame:
    """Per country and pull type: users asked for, got, missed, and posts got.

    Posts are counted per author before the join, so one row per user meets the batch.
    """
    pulled = batch.select("user_id", "country_short", pull_type_of().alias("pull_type")).join(posts_per_user(posts), "user_id", "left")
    got = F.col("n_tweets").isNotNull()
    return pulled.groupBy("country_short", "pull_type").agg(
        F.count(F.lit(1)).alias("n_users_asked"),
        F.count_if(got).alias("n_users_got"),
        F.count_if(~got).alias("n_users_missed"),
        F.coalesce(F.sum("n_tweets"), F.lit(0)).alias("n_tweets"),
    )


def coverage_by_pull(batch: DataFrame, pulled: DataFrame, page: int = 200) -> DataFrame:
    """Per country, pull date and pull type: users asked for, got and missed, requests and posts got.

    ``pulled`` are posts (tweet_id, user_id) with the country, date and type of their pull. Asked for
    are the users of the batch of that country and type; posts of others in a pull are not counted, and a
    pull that nobody was asked for in has zeros. Posts are counted per author of a pull before any join.
    """
    work = ("country_short", "pull_type")
    asked = batch.select("user_id", "country_short", pull_type_of().alias("pull_type")).distinct()
    authors = pulled.groupBy(*work, "pull_date", "user_id").agg(F.count("tweet_id").alias("n_tweets"))
    got = authors.join(asked.withColumn("is_asked", F.lit(True)), [*work, "user_id"], "left")
    n_requests = F.greatest(F.lit(1), ceil_div(F.col("n_tweets"), page))
    pulls = got.groupBy(*work, "pull_date").agg(
        F.count_if("is_asked").alias("n_users_got"),
        F.coalesce(F.sum(F.when(F.col("is_asked"), n_requests)), F.lit(0)).cast("long").alias("n_requests"),
        F.coalesce(F.sum(F.when(F.col("is_asked"), F.col("n_tweets"))), F.lit(0)).alias("n_tweets"),
    )
    n_asked = F.coalesce("n_users_asked", F.lit(0))
    return pulls.join(asked.groupBy(*work).agg(F.count(F.lit(1)).alias("n_users_asked")), [*work], "left").select(
        "country_short", "pull_date", "pull_type", n_asked.alias("n_users_asked"), "n_users_got",
        (n_asked - F.col("n_users_got")).alias("n_users_missed"), "n_requests", "n_tweets",
    )


def lookup_coverage(asked: DataFrame, got: DataFrame) -> DataFrame:
    """One row: distinct users asked for, got and missed, of lookups or friend lists.

    Both tables are reduced to one row per user in the same aggregation.
    """
    tagged = asked.select("user_id", F.lit(True).alias("asked"), F.lit(False).alias("got")).unionByName(
        got.select("user_id", F.lit(False).alias("asked"), F.lit(True).alias("got"))
    )
    users = tagged.where(F.col("user_id").isNotNull()).groupBy("user_id")
    return (
        users.agg(F.bool_or("asked").alias("asked"), F.bool_or("got").alias("got"))
        .where("asked")
        .agg(
            F.count(F.lit(1)).alias("n_users_asked"),
            F.count_if("got").alias("n_users_got"),
            F.count_if(~F.col("got")).alias("n_users_missed"),
        )
    )


def filter_funnel(batch: DataFrame, filters: dict[str, Column], key: str = "user_id") -> DataFrame:
    """One row: ``n_all``, ``n_<filter>`` rows left after each filter in turn, and
    ``n_unique`` users left at the end. One pass over the batch."""
    passed, counts = F.lit(True), [F.count(F.lit(1)).alias("n_all")]
    for name, condition in filters.items():
        passed = passed & condition
        counts.append(F.count_if(passed).alias(f"n_{name}"))
    return batch.agg(*counts, F.count_distinct(F.when(passed, F.col(key))).alias("n_unique"))


def as_row(spark: SparkSession, counts: dict) -> DataFrame:
    """Counts taken during a write as a table of one row."""
    return spark.createDataFrame([Row(**counts)], ", ".join(f"{name} long" for name in counts))


def post_file_name(
    n_users: str, n_requests: str, n_tweets: str, country: str, date: str, pull_type: str, tag: str
) -> Column:
    """Name of a post pull file, out of columns with its counters; ``date`` is a timestamp
    column and ``tag`` makes the name unique."""
    # Fixed value: the form of the name.
    return F.format_string(
        "user_timeline_%d_users_%d_requests_%d_tweets_%s_%s_%s_%s.json.bz2",
        n_users, n_requests, n_tweets, country, F.date_format(date, "ddMMyyyy"), pull_type, tag,
    )


def parse_pull_names(names: DataFrame, column: str = "file_name") -> DataFrame:
    """Split pull file names into counters, country, date and pull type; parts a name
    lacks, and all parts of other names, are null."""
    name = F.col(column)

    def part(pattern: str) -> Column:
        n_groups = re.compile(pattern).groups
        found = [F.nullif(F.regexp_extract(name, pattern, group + 1), F.lit("")) for group in range(n_groups)]
        return F.coalesce(*found)

    parts = {field: part(pattern) for field, pattern in MANIFEST_PATTERNS.items()}
    for field in ("n_users", "n_requests", "n_tweets"):
        parts[field] = parts[field].cast("long")
    is_pull = name.rlike(r"^(user_timeline|lookup_users|friends_ids|followers_ids)_")
    return names.select(column, *[F.when(is_pull, value).alias(field) for field, value in parts.items()])


def pull_manifest(names: DataFrame, column: str = "file_name") -> DataFrame:
    """Totals of the counters in pull file names per country, date and pull type; names
    that are no pull file are left out."""
    parsed = parse_pull_names(names, column).where(F.col("n_users").isNotNull())
    return parsed.groupBy("country_short", "pull_date", "pull_type").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_users").alias("n_users"),
        F.sum("n_requests").alias("n_requests"),
        F.sum("n_tweets").alias("n_tweets"),
    )
