"""Every operator as a query over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph import sinks
from cohortgraph import standin as given
from cohortgraph.functions.columns import epoch_seconds, epoch_to_timestamp, flatten_posts, flatten_users
from cohortgraph.operators.geocode import attach_country
from cohortgraph.operators.shards import assign_shards, chunk_ids, cut_shards, hash_shards
from cohortgraph.operators.survivors import drop_copies
from cohortgraph.plans import batches, levels, links, metrics, profiles, state, worklist
from cohortgraph.plans.extract import extract_posts
from cohortgraph.plans.snowball import interaction_edges, snowball
from cohortgraph.schemas import RAW_POST, RAW_USER
from cohortgraph.session import scratch_path
from cohortgraph.sources import drift, landing, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LEVEL_COUNTRY = "AFRICA"
WORK_COUNTRIES = ["AFRICA", "AMERICA", "EUROPE"]
WORK_WINDOW = {"min_timestamp": "2024-01-29 06:00:00", "max_timestamp": "2024-01-30 18:00:00"}
FRESH_FROM = 1706572800  # 2024-01-30: posts from here on count as freshly pulled
MARKS_BEFORE = 1705708800  # 2024-01-20: posts before count as stored
N_SHARDS = 7
LAYOUT = ["country", "date", "type"]
RECORDS_PER_FILE = 100_000
USERS_PER_FILE = 1000
IDS_PER_ARRAY = 10_000
PAGE_SIZE = 20


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def joined(name: str) -> Column:
    """An array column as text, for comparing."""
    return F.when(F.col(name).isNotNull(), F.concat_ws("|", name)).alias(name)


def plain_time(df: DataFrame, name: str = "tweet_timestamp") -> DataFrame:
    return df.withColumn(name, F.col(name).cast("timestamp_ntz"))


# Tables several queries start from.


def _timeline_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.timeline_profiles(given.profiled_posts(spark, sf), given.locations(spark, sf))


def _users_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.users_profiles(given.raw_users(spark, sf), given.locations(spark, sf))


def _snowball(spark: SparkSession, sf: str) -> DataFrame:
    return snowball(given.profiled_posts(spark, sf), given.locations(spark, sf))


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    return batches.timeline_batch(_timeline_profiles(spark, sf), _users_profiles(spark, sf), given.seeds(spark, sf))


def _fresh_posts(spark: SparkSession, sf: str) -> DataFrame:
    return given.posts(spark, sf).where(F.col("tweet_timestamp") >= FRESH_FROM)


# Growing the sample.


@query("snowball")
def snowball_users(spark: SparkSession, sf: str) -> DataFrame:
    return _snowball(spark, sf)


@query("snowball_distinct_authors")
def snowball_distinct_authors(spark: SparkSession, sf: str) -> DataFrame:
    return snowball(given.profiled_posts(spark, sf), given.locations(spark, sf), distinct_authors=True)


@query("edge_counts")
def edge_counts(spark: SparkSession, sf: str) -> DataFrame:
    edges = interaction_edges(given.posts(spark, sf), "user_id")
    return edges.groupBy("user_id", "neighbor_id").agg(F.count(F.lit(1)).alias("n_edges"))


# Posts.


def _comparable_posts(posts: DataFrame) -> DataFrame:
    return posts.withColumns(
        {
            "tweet_mentioned_user_id": joined("tweet_mentioned_user_id"),
            "tweet_urls": joined("tweet_urls"),
            "tweet_longitude": F.get("tweet_coordinates", F.lit(0)),
            "tweet_latitude": F.get("tweet_coordinates", F.lit(1)),
        }
    ).drop("tweet_coordinates")


def _laid_out(raw: DataFrame) -> DataFrame:
    """Raw posts with the pull they belong to: by the author's numbers, the day and the language."""
    country = F.when(F.col("user.friends_count") % 2 == 0, "XA").otherwise("XB")
    return raw.withColumns(
        {
            "country": country,
            "date": F.concat(F.substring("created_at", 9, 2), F.lit("2024")),
            "type": F.when(F.col("lang") == "view", "full").otherwise("update"),
        }
    )


def _array_kind(path: str) -> Column:
    return F.regexp_extract(path, "kind=([a-z]+)/", 1).alias("kind")


def _write_arrays(spark: SparkSession, sf: str, path: str) -> None:
    """User lookups as text files, each one JSON array of the users of a nation and a block of ids: sound
    ones, ones with text in a number field, ones without an id, and arrays that are cut short."""
    users = given.raw_users(spark, sf)
    kind = F.element_at(F.array(*map(F.lit, ("sound", "mistyped", "nameless", "broken"))), (F.col("followers_count") % 4 + 1).cast("int"))
    record = F.to_json(F.struct(*users.columns))
    record = (
        F.when(F.col("kind") == "mistyped", F.regexp_replace(record, '"friends_count":([0-9]+)', '"friends_count":"about $1"'))
        .when(F.col("kind") == "nameless", F.to_json(F.struct("name", "followers_count")))
        .otherwise(record)
    )
    block = F.floor(F.col("id_str").cast("long") / IDS_PER_ARRAY).alias("block")
    files = users.withColumn("kind", kind).groupBy("kind", "followers_count", block).agg(F.sort_array(F.collect_list(record)).alias("r"))
    closing = F.when(F.col("kind") == "broken", "").otherwise("]")
    text = F.concat(F.lit("["), F.array_join("r", ","), closing).alias("value")
    files.select("kind", text).write.partitionBy("kind").option("maxRecordsPerFile", 1).text(path)


def _landed_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Every post pulled again by a second pull that saw one more status of its author."""
    first = given.raw_posts(spark, sf)
    later = F.col("user").withField("statuses_count", F.col("user.statuses_count") + 1)
    return first.unionByName(first.withColumn("user", later))


@query("flatten_posts")
def flatten_raw_posts(spark: SparkSession, sf: str) -> DataFrame:
    return _comparable_posts(flatten_posts(given.raw_posts(spark, sf)))


@query("extract_posts")
def extract(spark: SparkSession, sf: str) -> DataFrame:
    return _comparable_posts(extract_posts(_landed_twice(spark, sf)))


@query("dedup_posts")
def dedup_posts(spark: SparkSession, sf: str) -> DataFrame:
    posts = given.posts(spark, sf).drop("tweet_mentioned_user_id")
    return drop_copies(posts.unionByName(posts), ["tweet_id"])


@query("parse_created_at")
def parse_created_at(spark: SparkSession, sf: str) -> DataFrame:
    raw = given.raw_posts(spark, sf)
    seconds = epoch_seconds("created_at")
    return raw.select(
        F.col("id_str").alias("tweet_id"),
        seconds.alias("tweet_timestamp"),
        epoch_to_timestamp(seconds).cast("timestamp_ntz").alias("posted_at"),
    )


# Profiles.


@query("latest_per_user")
def latest_per_user(spark: SparkSession, sf: str) -> DataFrame:
    posts = given.posts(spark, sf).select("user_id", "tweet_id", "tweet_timestamp")
    return profiles.latest_posts(posts)


@query("timeline_profiles")
def timeline_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return _timeline_profiles(spark, sf)


@query("flatten_users")
def flatten_raw_users(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_users(given.raw_users(spark, sf))


@query("users_profiles")
def users_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return _users_profiles(spark, sf)


@query("geocode_left")
def geocode_left(spark: SparkSession, sf: str) -> DataFrame:
    users = flatten_users(given.raw_users(spark, sf)).select("user_id", "user_location")
    located = attach_country(users, given.locations(spark, sf))
    return located.groupBy("country_short").agg(F.count("user_id").alias("n_users"))


@query("geocode_inner_shuffled")
def geocode_inner_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The join used when the location table is too large to broadcast."""
    users = flatten_users(given.raw_users(spark, sf)).select("user_id", "user_location")
    located = attach_country(users, given.locations(spark, sf), how="inner", broadcast_limit=0)
    return located.groupBy("country_short").agg(F.count("user_id").alias("n_users"))


# Batches.


@query("users_batch")
def users_batch(spark: SparkSession, sf: str) -> DataFrame:
    customer = given.table(spark, sf, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    known = customer.selectExpr("CAST(c_custkey AS string) AS user_id")
    return batches.users_batch(given.seeds(spark, sf), _snowball(spark, sf), known)


@query("timeline_batch_v2")
def timeline_batch_v2(spark: SparkSession, sf: str) -> DataFrame:
    return plain_time(_batch(spark, sf))


@query("timeline_batch_v1")
def timeline_batch_v1(spark: SparkSession, sf: str) -> DataFrame:
    batch = batches.timeline_batch_v1(_timeline_profiles(spark, sf), _users_profiles(spark, sf), _snowball(spark, sf))
    return plain_time(batch)


@query("remaining_batch")
def remaining_batch(spark: SparkSession, sf: str) -> DataFrame:
    return plain_time(batches.remaining_batch(_batch(spark, sf), _fresh_posts(spark, sf)))


@query("network_batch")
def network_batch(spark: SparkSession, sf: str) -> DataFrame:
    stored = tables.friend_map_users(given.friend_maps(spark, sf))
    return batches.network_batch(_users_profiles(spark, sf), stored, LEVEL_COUNTRY)


@query("network_batches")
def network_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of some users are stored for the last two countries, none for the first."""
    stored = tables.friend_map_users(given.friend_maps(spark, sf, "click"))
    lists = stored.select("user_id", F.explode(F.array(*map(F.lit, WORK_COUNTRIES[1:]))).alias("country_short"))
    return batches.network_batches(_users_profiles(spark, sf), lists, WORK_COUNTRIES)


# Levels.


@query("level_members")
def level_members(spark: SparkSession, sf: str) -> DataFrame:
    users, seeds = given.country_users(spark, sf), given.seeds(spark, sf)
    return levels.level_members(given.posts(spark, sf), users, seeds, WORK_COUNTRIES)


@query("level_stats")
def level_stats(spark: SparkSession, sf: str) -> DataFrame:
    users, seeds = given.country_users(spark, sf), given.seeds(spark, sf)
    return levels.level_stats(given.posts(spark, sf), users, seeds, [*WORK_COUNTRIES, "NOWHERE"])


# Links and friends.


@query("post_urls")
def post_urls(spark: SparkSession, sf: str) -> DataFrame:
    return links.post_urls(given.page_posts(spark, sf), given.page_locations(spark, sf), ["DE", "EN", "FR"])


@query("post_urls_all")
def post_urls_all(spark: SparkSession, sf: str) -> DataFrame:
    pages, places = given.page_posts(spark, sf), given.page_locations(spark, sf)
    return links.post_urls(pages, places, ["EN", "ES"], all_urls=True)


@query("friend_edges")
def friend_edges(spark: SparkSession, sf: str) -> DataFrame:
    return links.friend_edges(tables.explode_friend_map(given.friend_maps(spark, sf)))


@query("follow_edges")
def follow_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Viewed users as friends, users clicked on as followers."""
    friends, followers = (tables.explode_friend_map(given.friend_maps(spark, sf, kind)) for kind in ("view", "click"))
    return links.follow_edges(friends, followers)


@query("friend_map_users")
def friend_map_users(spark: SparkSession, sf: str) -> DataFrame:
    return tables.friend_map_users(given.friend_maps(spark, sf))


# Work lists.


@query("select_work_full")
def select_work_full(spark: SparkSession, sf: str) -> DataFrame:
    return plain_time(worklist.select_work(_batch(spark, sf), WORK_COUNTRIES, "full", N_SHARDS, drop_seeds=True))


@query("select_work_update")
def select_work_update(spark: SparkSession, sf: str) -> DataFrame:
    return plain_time(worklist.select_work(_batch(spark, sf), WORK_COUNTRIES, "update", N_SHARDS, **WORK_WINDOW))


@query("select_users")
def select_users(spark: SparkSession, sf: str) -> DataFrame:
    """Filter and de-duplicate the largest table, order lines as a batch with several rows per user."""
    batch = given.table(spark, sf, "lineitem").selectExpr(
        "CAST(l_orderkey AS string) AS user_id",
        "l_returnflag AS country_short",
        "concat(l_orderkey, l_partkey, l_linenumber) AS tweet_id",
        "CAST(l_shipdate AS timestamp) AS tweet_timestamp",
        "CAST(l_tax = 0 AS int) AS is_seed",
    )
    window = {"min_timestamp": "1996-01-01", "max_timestamp": "1999-07-01"}
    filters = worklist.work_filters(["A", "R"], "update", drop_seeds=True, **window)
    return plain_time(worklist.select_users(batch, filters))


@query("work_head")
def work_head(spark: SparkSession, sf: str) -> DataFrame:
    """A report of the first users of the batch."""
    return plain_time(worklist.head(_batch(spark, sf), 20))


@query("shard_sizes")
def shard_sizes(spark: SparkSession, sf: str) -> DataFrame:
    shards = assign_shards(given.country_users(spark, sf), N_SHARDS)
    return shards.groupBy("country_short", "shard").agg(F.count(F.lit(1)).alias("n_users"))


@query("cut_shard_users")
def cut_shard_users(spark: SparkSession, sf: str) -> DataFrame:
    return cut_shards(given.country_users(spark, sf), N_SHARDS)


@query("chunk_sizes")
def chunk_sizes(spark: SparkSession, sf: str) -> DataFrame:
    chunks = chunk_ids(assign_shards(given.country_users(spark, sf), N_SHARDS), size=PAGE_SIZE)
    return chunks.select(
        "country_short",
        "shard",
        "chunk",
        F.col("n_ids").cast("long").alias("n_ids"),
        F.concat_ws(",", "ids").alias("ids"),
    )


@query("hash_shard_users")
def hash_shard_users(spark: SparkSession, sf: str) -> DataFrame:
    return hash_shards(given.country_users(spark, sf), N_SHARDS)


@query("newer_than_mark")
def newer_than_mark(spark: SparkSession, sf: str) -> DataFrame:
    posts = given.posts(spark, sf).select("tweet_id", "user_id", "tweet_timestamp")
    stored = posts.where(F.col("tweet_timestamp") < MARKS_BEFORE)
    return worklist.newer_than_mark(posts, profiles.latest_posts(stored).select("user_id", "tweet_id"))


# State kept between pulls: the posts before FRESH_FROM are one pull, those from then on another.


def _two_pulls(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    posts = given.profiled_posts(spark, sf)
    fresh = F.col("tweet_timestamp") >= FRESH_FROM
    return {"stored": posts.where(~fresh), "fresh": posts.where(fresh)}


@query("kept_newest")
def kept_newest(spark: SparkSession, sf: str) -> DataFrame:
    """Newest posts and counts of two pulls that were added one after the other."""
    kept = state.newest_posts(spark, scratch_path(spark, "newest"))
    for pull, posts in _two_pulls(spark, sf).items():
        state.add_posts(kept, pull, posts)
    return state.latest_posts(kept)


@query("kept_candidates")
def kept_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """The snowball of two pulls, out of the counts of each."""
    kept = state.candidates(spark, scratch_path(spark, "candidates"))
    for pull, posts in _two_pulls(spark, sf).items():
        kept.add(pull, snowball(posts, given.locations(spark, sf)))
    return state.merged_candidates(kept)


@query("kept_newer")
def kept_newer(spark: SparkSession, sf: str) -> DataFrame:
    posts = given.posts(spark, sf).select("tweet_id", "user_id", "tweet_timestamp")
    kept = state.newest_posts(spark, scratch_path(spark, "newest"))
    state.add_posts(kept, "stored", posts.where(F.col("tweet_timestamp") < MARKS_BEFORE))
    return state.newer_than_kept(posts, kept)


# Metrics.


@query("monthly_counts")
def monthly_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.monthly_counts(given.table(spark, sf, "orders"), "o_orderdate", "1996-07-01", key="o_custkey")


@query("request_estimate")
def request_estimate(spark: SparkSession, sf: str) -> DataFrame:
    users = given.country_users(spark, sf).select("user_id")
    return metrics.request_estimate(users, given.posts(spark, sf), page=PAGE_SIZE)


@query("pull_coverage")
def pull_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.pull_coverage(_batch(spark, sf), _fresh_posts(spark, sf))


@query("coverage_by_pull")
def coverage_by_pull(spark: SparkSession, sf: str) -> DataFrame:
    """Each day's fresh posts are a pull of the country and type that the batch has for their author."""
    work = _batch(spark, sf).select("user_id", "country_short", worklist.pull_type_of().alias("pull_type"))
    day = F.date_format(F.timestamp_seconds("tweet_timestamp"), "ddMMyyyy").alias("pull_date")
    pulled = _fresh_posts(spark, sf).select("tweet_id", "user_id", day).join(work.distinct(), "user_id")
    return metrics.coverage_by_pull(_batch(spark, sf), pulled, page=2)


@query("lookup_coverage")
def lookup_coverage(spark: SparkSession, sf: str) -> DataFrame:
    targets = _snowball(spark, sf).select("user_id").unionByName(given.seeds(spark, sf))
    got = given.table(spark, sf, "supplier").selectExpr("CAST(s_suppkey AS string) AS user_id")
    return metrics.lookup_coverage(targets, got)


@query("filter_funnel")
def filter_funnel(spark: SparkSession, sf: str) -> DataFrame:
    filters = worklist.work_filters(WORK_COUNTRIES, "update", drop_seeds=True, **WORK_WINDOW)
    return metrics.filter_funnel(_batch(spark, sf), filters)


@query("observed_funnel")
def observed_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts, taken while the chosen users are written."""
    filters = worklist.work_filters(WORK_COUNTRIES, "update", drop_seeds=True, **WORK_WINDOW)
    _, counts = worklist.select_and_count(_batch(spark, sf), filters)
    return metrics.as_row(spark, counts)


@query("pull_manifest")
def pull_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Names of one pull file per customer segment, country and day, read back."""
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day")
    codes = given.place_codes(spark, sf)
    files = (
        given.authored_events(spark, sf)
        .join(codes, "r_name", "left")
        .groupBy(F.col("code").alias("country"), day, F.lower("c_mktsegment").alias("segment"))
        .agg(
            F.count_distinct("user_id").alias("users"),
            F.count(F.lit(1)).alias("posts"),
            F.count_if(F.col("event_type") == "view").alias("views"),
        )
        .withColumn("pull_type", F.when(F.col("segment") == "building", "full").otherwise("update"))
    )
    name = metrics.post_file_name("users", "views", "posts", "country", "day", "pull_type", "segment")
    return metrics.pull_manifest(files.select(name.alias("file_name")))


# Files: written to the shared folder and read back.


@query("landing_round_trip")
def landing_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Raw posts as bz2 JSON files, rolled, under country/date/type; read with the fixed schema."""
    path = scratch_path(spark, "landing")
    sinks.write_json(_laid_out(given.raw_posts(spark, sf)), path, max_records=RECORDS_PER_FILE, columns=LAYOUT)
    good, _ = landing.read_posts(spark, f"{path}/*/*/*/*.bz2", multi_line=False)
    posts = _comparable_posts(flatten_posts(good.drop("source_file")))
    return landing.unpacked(posts, "posts")


@query("landing_files")
def landing_files(spark: SparkSession, sf: str) -> DataFrame:
    """Records per directory of the landing zone, from the lineage column."""
    path = scratch_path(spark, "landing")
    sinks.write_json(_laid_out(given.raw_posts(spark, sf)), path, max_records=RECORDS_PER_FILE, columns=LAYOUT)
    records = landing.marked(landing.read_landing(spark, f"{path}/*/*/*/*.bz2", RAW_POST, multi_line=False))
    # Parts of the path, checked against what the record itself says of its pull.
    located = landing.with_path_parts(landing.good_records(records), landing.files_under(spark, f"{path}/*/*/*/*.bz2"))
    said = _laid_out(located).groupBy("country_short", "pull_date", "pull_type", *LAYOUT).agg(F.count(F.lit(1)).alias("n"))
    said = landing.unpacked(said)
    agree = F.lit(True)
    for ours, theirs in zip(("country_short", "pull_date", "pull_type"), LAYOUT, strict=True):
        agree = agree & F.col(ours).eqNullSafe(F.col(theirs))
    return said.groupBy("country_short", "pull_date", "pull_type").agg(
        F.sum("n").alias("n_records"), F.coalesce(F.sum(F.when(agree, F.col("n"))), F.lit(0)).alias("n_in_place")
    )


@query("landing_arrays")
def landing_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Users as files of one JSON array each, one of which does not parse; read as whole documents."""
    path = scratch_path(spark, "arrays")
    _write_arrays(spark, sf, path)
    good, _ = landing.read_users(spark, path)
    return flatten_users(good.drop("source_file"))


@query("landing_quarantine")
def landing_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """What has no id, with its text, by the kind of the file it came from."""
    path = scratch_path(spark, "arrays")
    _write_arrays(spark, sf, path)
    records, _ = landing.staged(landing.read_landing(spark, path, RAW_USER), scratch_path(spark, "staging"))
    return landing.bad_records(records).select(_array_kind("source_file"), "bad_text")


@query("landing_audit")
def landing_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Files and records by kind of file, from the staged records and the listing."""
    path = scratch_path(spark, "arrays")
    _write_arrays(spark, sf, path)
    records, _ = landing.staged(landing.read_landing(spark, path, RAW_USER), scratch_path(spark, "staging"))
    files = landing.audit_files(spark, path, records)
    return files.groupBy(_array_kind("source_file")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_records").alias("n_records"), F.sum("n_bad").alias("n_bad")
    )


@query("landing_schema")
def landing_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Fields and types that written users have in common."""
    path = scratch_path(spark, "sample")
    sinks.write_json(given.raw_users(spark, sf), path, max_records=RECORDS_PER_FILE)
    fields = drift.inferred(landing.read_elements(spark, path, multi_line=False), depth=1).where("path <> '$'")
    return fields.select(F.substring_index("path", ".", -1).alias("name"), drift.as_ddl("schema").alias("type"))


@query("landing_drift")
def landing_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Paths and types of the written arrays against the schema that is imposed on them."""
    path = scratch_path(spark, "arrays")
    _write_arrays(spark, sf, path)
    return drift.drift(landing.read_elements(spark, path), RAW_USER)


@query("table_round_trip")
def table_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A table in files of a size: all rows are there, and no file is half or twice as large as it should be."""
    path = scratch_path(spark, "table")
    n_files = sinks.write_sized(given.table(spark, sf, "lineitem"), path)
    files = (
        tables.read_table(spark, path)
        .groupBy("_metadata.file_path", "_metadata.file_size")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_orderkey") * F.col("l_linenumber")).alias("keys"))
    )
    short = (F.col("file_size") < sinks.FILE_BYTES / 2) & F.lit(n_files > 1)
    return files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.sum("keys").alias("sum_keys"),
        F.count_if(short).alias("n_short"),
        F.count_if(F.col("file_size") > 2 * sinks.FILE_BYTES).alias("n_long"),
    )


@query("friend_files")
def friend_files(spark: SparkSession, sf: str) -> DataFrame:
    """Friend maps written as text, one JSON object in each file, and read as lists."""
    path = scratch_path(spark, "friends")
    lists = tables.explode_friend_map(given.friend_maps(spark, sf))
    file = F.floor(F.col("user_id").cast("long") / USERS_PER_FILE)
    maps = lists.groupBy(file).agg(F.map_from_entries(F.collect_list(F.struct("user_id", "friend_ids"))).alias("friends"))
    maps.select(F.to_json("friends").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return links.friend_edges(tables.read_friend_lists(spark, path), distinct=True)


@query("partitioned_round_trip")
def partitioned_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "by-country")
    sinks.write_partitioned(given.country_users(spark, sf), path, ["country_short"])
    users = tables.read_table(spark, path, ["user_id", "country_short"])
    return users.groupBy("country_short").agg(F.count("user_id").alias("n_users"))


@query("ids_round_trip")
def ids_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    sinks.write_ids_csv(given.seeds(spark, sf), path)
    return tables.read_ids_csv(spark, path)
