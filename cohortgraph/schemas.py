"""Column names and raw-record schemas. Schemas are constants: inferring them
would read the landing zone once more and drift with the sample."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw user fields kept, in table order, with their types.
RAW_USER_FIELDS = {
    "created_at": T.StringType(),
    "default_profile_image": T.BooleanType(),
    "description": T.StringType(),
    "favourites_count": T.LongType(),
    "followers_count": T.LongType(),
    "friends_count": T.LongType(),
    "geo_enabled": T.BooleanType(),
    "id_str": T.StringType(),
    "location": T.StringType(),
    "name": T.StringType(),
    "notifications": T.BooleanType(),
    "profile_image_url_https": T.StringType(),
    "protected": T.BooleanType(),
    "screen_name": T.StringType(),
    "statuses_count": T.LongType(),
    "url": T.StringType(),
    "verified": T.BooleanType(),
}

# Post columns of the extract table and where they sit in a raw record.
POST_COLUMNS = {
    "tweet_id": "id_str",
    "tweet_timestamp": "created_at",
    "tweet_lang": "lang",
    "tweet_text": "full_text",
    "tweet_retweeted_user_id": "retweeted_status.user.id_str",
    "tweet_in_reply_to_user_id": "in_reply_to_user_id_str",
    "tweet_mentioned_user_id": "entities.user_mentions.id_str",
    "tweet_urls": "entities.urls.expanded_url",
    "tweet_place": "place",
    "tweet_coordinates": "coordinates.coordinates",
}


def user_column(field: str) -> str:
    """Table column of a raw user field: id and creation time have their own names."""
    return {"created_at": "user_timestamp", "id_str": "user_id"}.get(field, f"user_{field}")


USER_COLUMNS = [user_column(field) for field in RAW_USER_FIELDS]
PROFILE_COLUMNS = ["tweet_id", "tweet_timestamp", "tweet_count", *USER_COLUMNS, "country_short"]

CORRUPT_COLUMN = "_corrupt_record"

RAW_USER_STRUCT = T.StructType([T.StructField(n, t) for n, t in RAW_USER_FIELDS.items()])

RAW_USER = T.StructType(
    [
        T.StructField("status", T.StructType().add("id_str", "string").add("created_at", "string")),
        *RAW_USER_STRUCT.fields,
    ]
)


def raw_post_schema(place: T.DataType | None = None) -> T.StructType:
    """Schema of one raw post. ``place`` is passed through whole: as the JSON text of the
    object, so that no field is lost, unless the caller names its fields."""
    id_struct = T.StructType().add("id_str", "string")
    url_struct = T.StructType().add("expanded_url", "string")
    place = place or T.StringType()
    return (
        T.StructType()
        .add("id_str", "string")
        .add("created_at", "string")
        .add("lang", "string")
        .add("full_text", "string")
        .add("in_reply_to_user_id_str", "string")
        .add("retweeted_status", T.StructType().add("user", id_struct))
        .add(
            "entities",
            T.StructType()
            .add("user_mentions", T.ArrayType(id_struct))
            .add("urls", T.ArrayType(url_struct)),
        )
        .add("place", place)
        .add("coordinates", T.StructType().add("coordinates", T.ArrayType(T.DoubleType())))
        .add("user", RAW_USER_STRUCT)
    )


RAW_POST = raw_post_schema()
