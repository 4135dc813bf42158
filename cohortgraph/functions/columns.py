"""Column expressions shared by the plans: time parsing, id order, flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgraph.schemas import POST_COLUMNS, RAW_USER_FIELDS, user_column

# Record time text is "Wed Oct 10 20:19:24 +0000 2018". Weekday names
# are not parseable with the current formatter, so the text is read from the month on.
TIME_TEXT_START = 5
TIME_TEXT_FORMAT = "MMM dd HH:mm:ss Z yyyy"


def epoch_seconds(text: Column | str) -> Column:
    """Record time text to epoch seconds; text that does not parse gives null."""
    from_month = F.substr(F.col(text) if isinstance(text, str) else text, F.lit(TIME_TEXT_START))
    return F.unix_seconds(F.try_to_timestamp(from_month, F.lit(TIME_TEXT_FORMAT)))


def epoch_to_timestamp(seconds: Column | str) -> Column:
    return F.timestamp_seconds(seconds)


def numeric_id(id_text: Column | str) -> Column:
    """Ids are text but ordered as numbers (up to 20 digits)."""
    column = F.col(id_text) if isinstance(id_text, str) else id_text
    return column.try_cast("decimal(20,0)")


def ceil_div(count: Column, size: int) -> Column:
    return F.ceil(count / F.lit(size))


def user_columns(parent: str = "") -> list[Column]:
    """The 17 ``user_*`` columns out of a raw user record, times parsed."""
    columns = []
    for field in RAW_USER_FIELDS:
        raw = F.col(f"{parent}.{field}" if parent else field)
        columns.append((epoch_seconds(raw) if field == "created_at" else raw).alias(user_column(field)))
    return columns


def flatten_posts(raw: DataFrame) -> DataFrame:
    """Raw nested posts to the 27-column table; a missing parent gives null."""
    post_columns = [
        (epoch_seconds(path) if name == "tweet_timestamp" else F.col(path)).alias(name)
        for name, path in POST_COLUMNS.items()
    ]
    return raw.select(*post_columns, *user_columns("user"))


def flatten_users(raw: DataFrame) -> DataFrame:
    """Raw user lookups to 19 columns: latest status id and time, then the user."""
    return raw.select(
        F.col("status.id_str").alias("tweet_id"),
        epoch_seconds("status.created_at").alias("tweet_timestamp"),
        *user_columns(),
    )
