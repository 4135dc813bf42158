"""The given tables read as the logical tables of the pipeline.

Events are posts by customers: a view mentions user ``k``, a click reposts ``k``, a
purchase replies to ``k``. A customer's nation is the location text and the region
its country; locations of one region are left out of the location table, so
unresolved ones exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortgraph.schemas import user_column
from cohortgraph.session import use_utc

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_tax double, l_returnflag string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "lang string",
    "pages": "page_id long, url string, html string",
}

TARGET = "get_json_object(props, '$.k')"
# Every third view mentions its target twice, and its author too; every other one reposts as well.
MENTIONED = f"""CASE WHEN event_type = 'view' THEN CASE WHEN event_id % 3 = 0
    THEN array({TARGET}, CAST(user_id AS string), {TARGET}) ELSE array({TARGET}) END END"""
REPOSTED = f"CASE WHEN event_type = 'click' OR event_type = 'view' AND event_id % 2 = 0 THEN {TARGET} END"
COUNTRY_CODE = "chr(65 + CAST(r_regionkey AS int) DIV 26) || chr(65 + CAST(r_regionkey AS int) % 26)"
POST_TIME = "unix_seconds(CAST(ts AS timestamp))"
ACCOUNT_TIME = "1400000000 + c_custkey * 3600"
TIME_TEXT = "date_format(timestamp_seconds({}), 'EEE MMM dd HH:mm:ss Z yyyy')"

POST_COLUMNS = [
    "CAST(event_id AS string) AS tweet_id",
    f"{POST_TIME} AS tweet_timestamp",
    f"{MENTIONED} AS tweet_mentioned_user_id",
    f"{REPOSTED} AS tweet_retweeted_user_id",
    f"CASE WHEN event_type = 'purchase' THEN {TARGET} END AS tweet_in_reply_to_user_id",
]

# Raw user fields of a customer and its nation. All fields depend on the row.
USER_FIELDS = {
    "created_at": TIME_TEXT.format(ACCOUNT_TIME),
    "default_profile_image": "c_acctbal < 0",
    "description": "c_mktsegment",
    "favourites_count": "floor(abs(c_acctbal))",
    "followers_count": "CAST(c_nationkey AS long)",
    "friends_count": "CAST(n_regionkey AS long)",
    "geo_enabled": "c_mktsegment = 'BUILDING'",
    "id_str": "CAST(c_custkey AS string)",
    "location": "n_name",
    "name": "c_name",
    "notifications": "c_mktsegment = 'FURNITURE'",
    "profile_image_url_https": "'https://example.org/image/' || c_custkey",
    "protected": "c_mktsegment = 'AUTOMOBILE'",
    "screen_name": "lower(c_name)",
    "statuses_count": "c_custkey + 1",
    "url": "CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'https://example.org/' || c_custkey END",
    "verified": "c_acctbal > 9500",
}
# A post's record counts its author's statuses up to it.
AUTHOR_FIELDS = USER_FIELDS | {"statuses_count": "event_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"])


def all_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nations(spark, sf_dir).selectExpr("n_name AS user_location", "r_name AS country_short")


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_locations(spark, sf_dir).where("country_short <> 'MIDDLE EAST'")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), nations(spark, sf_dir)
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])


def country_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, country_short) of every customer."""
    return customers(spark, sf_dir).selectExpr("CAST(c_custkey AS string) AS user_id", "r_name AS country_short")


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").where("c_acctbal > 9500")
    return customer.selectExpr("CAST(c_custkey AS string) AS user_id")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts without their author's profile."""
    return table(spark, sf_dir, "events").selectExpr("CAST(user_id AS string) AS user_id", *POST_COLUMNS)


def authored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the customer and nation columns of their author. Customers are joined
    before the small tables, so no wide customer table has to be built first."""
    events, customer = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    authored = events.join(customer, events["user_id"] == customer["c_custkey"], "left")
    nation = nations(spark, sf_dir)
    return authored.join(nation, authored["c_nationkey"] == nation["n_nationkey"], "left")


def profiled_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with their author's profile."""
    fields = AUTHOR_FIELDS | {"created_at": ACCOUNT_TIME}
    profile = [f"{value} AS {user_column(field)}" for field, value in fields.items()]
    return authored_events(spark, sf_dir).selectExpr(*POST_COLUMNS, *profile)


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested posts as pulled: views carry two links, signups a place, purchases coordinates."""
    link = "named_struct('expanded_url', 'https://example.org/post/' || event_id)"
    more = "named_struct('expanded_url', 'https://example.org/user/' || user_id)"
    place = """'{"id":"' || n_nationkey || '","country_code":"' || r_name || '","full_name":"' || n_name
               || '","bounding_box":{"type":"Polygon","coordinates":[[[1,2],[3,4]]]}}'"""
    user = ", ".join(f"'{field}', {value}" for field, value in AUTHOR_FIELDS.items())
    return authored_events(spark, sf_dir).selectExpr(
        "CAST(event_id AS string) AS id_str",
        f"{TIME_TEXT.format(POST_TIME)} AS created_at",
        "event_type AS lang",
        "event_type || ' ' || props AS full_text",
        f"CASE WHEN event_type = 'purchase' THEN {TARGET} END AS in_reply_to_user_id_str",
        f"""CASE WHEN {REPOSTED} IS NOT NULL
                 THEN named_struct('user', named_struct('id_str', {REPOSTED})) END AS retweeted_status""",
        f"""named_struct('user_mentions', transform({MENTIONED}, x -> named_struct('id_str', x)),
                         'urls', CASE WHEN event_type = 'view' THEN array({link}, {more}) END) AS entities""",
        f"CASE WHEN event_type = 'signup' THEN {place} END AS place",
        """CASE WHEN event_type = 'purchase'
                THEN named_struct('coordinates', array(value, -value)) END AS coordinates""",
        f"named_struct({user}) AS user",
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested user lookups: each customer, and a second lookup of the users whose id is
    also a supplier's, then living in the supplier's nation. Overdrawn users have no status."""
    moved = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS c_custkey",
        "s_name AS c_name",
        "s_nationkey AS c_nationkey",
        "s_acctbal AS c_acctbal",
        "'SUPPLIER' AS c_mktsegment",
        "2 AS lookup",
    )
    nation = nations(spark, sf_dir)
    lookups = table(spark, sf_dir, "customer").selectExpr("*", "1 AS lookup").unionByName(moved)
    users = lookups.join(nation, lookups["c_nationkey"] == nation["n_nationkey"])
    status_time = TIME_TEXT.format("1600000000 + floor(c_acctbal)")
    return users.selectExpr(
        f"""CASE WHEN c_acctbal >= 0
                 THEN named_struct('id_str', c_custkey || '' || lookup, 'created_at', {status_time}) END AS status""",
        *[f"{value} AS {field}" for field, value in USER_FIELDS.items()],
    )


def page_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as posts: the language in the address is the location, the links of the
    whole page are the URLs."""
    return table(spark, sf_dir, "pages").selectExpr(
        "CAST(page_id AS string) AS tweet_id",
        "nullif(regexp_extract(url, '//[^/]+/([a-z]+)/', 1), '') AS user_location",
        """regexp_extract_all(html, 'href="([^"]+)"', 1) AS tweet_urls""",
    )


def page_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of the documents as locations, their capitals as countries."""
    languages = table(spark, sf_dir, "documents").distinct()
    return languages.selectExpr("lang AS user_location", "upper(lang) AS country_short")


def place_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(r_name, code): two letters for each region, one-to-one."""
    return table(spark, sf_dir, "region").selectExpr("r_name", f"{COUNTRY_CODE} AS code")


def friend_maps(spark: SparkSession, sf_dir: str, event_type: str = "view") -> DataFrame:
    """One map user → users viewed (or clicked, …) per author. ``k`` has a hundred values, which bounds a list."""
    lists = (
        table(spark, sf_dir, "events")
        .where(f"event_type = '{event_type}'")
        .selectExpr("CAST(user_id AS string) AS user_id", f"{TARGET} AS friend")
        .groupBy("user_id")
        .agg({"friend": "collect_set"})
        .toDF("user_id", "friend_ids")
    )
    return lists.selectExpr("map(user_id, friend_ids) AS friends")
