"""Table jobs: read tables under a root folder, run one plan, write one table.

    python -m cohortgraph.jobs <job> --root <folder> [options]
    spark-submit --py-files cohortgraph.zip cohortgraph/jobs.py <job> --root <folder> [options]

The folder layout is the hand-over between jobs; see ``Layout``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortgraph import sinks
from cohortgraph.operators.shards import assign_shards, chunk_ids, cut_shards
from cohortgraph.operators.shards import hash_shards as shard_by_hash
from cohortgraph.plans import batches, levels, links, metrics, profiles, worklist
from cohortgraph.plans.extract import extract_posts
from cohortgraph.plans.snowball import snowball
from cohortgraph.schemas import RAW_POST, RAW_USER, USER_COLUMNS
from cohortgraph.session import build_session, materialize, scratch_path
from cohortgraph.sources import landing, tables


#: Whose ids a list holds: of those a user follows, or of those who follow the user.
RELATIONS = ("friends", "followers")
#: What a pull tells of a post when only its author is wanted.
PULLED = T.StructType([f for f in RAW_POST.fields if f.name == "id_str"]).add("user", T.StructType().add("id_str", "string"))


@dataclass(frozen=True)
class Layout:
    """Where each table lies. The relative paths are fixed values."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def raw_posts(self, country: str = "*", date: str = "*", pull_type: str = "*") -> str:
        return self.path("user_timeline", "API", country, date, pull_type, "*.json.bz2")

    def raw_users(self) -> str:
        return self.path("lookup_users", "API", "*")

    def raw_lists(self, country: str, relation: str = "friends") -> str:
        return self.path(f"{relation}_ids", country, "API", "*", "*.json")

    def staging(self, name: str) -> str:
        return self.path("staging", name)

    @property
    def posts(self) -> str:
        return self.path("user_timeline", "extract")

    @property
    def bad_posts(self) -> str:
        return self.path("user_timeline", "badRecords")

    @property
    def audit(self) -> str:
        return self.path("user_timeline", "audit")

    @property
    def profiles(self) -> str:
        return self.path("user_timeline", "profiles")

    @property
    def snowball(self) -> str:
        return self.path("user_timeline", "snowball")

    @property
    def batch(self) -> str:
        return self.path("user_timeline", "batch")

    @property
    def remaining(self) -> str:
        return self.path("user_timeline", "batch_tmp")

    @property
    def bad_pulled(self) -> str:
        return self.path("user_timeline", "badPulledRecords")

    @property
    def newer(self) -> str:
        return self.path("user_timeline", "newer")

    @property
    def manifest(self) -> str:
        return self.path("metrics", "manifest")

    @property
    def coverage(self) -> str:
        return self.path("metrics", "pull_coverage")

    @property
    def coverage_by_pull(self) -> str:
        return self.path("metrics", "coverage_by_pull")

    @property
    def lookup_coverage(self) -> str:
        return self.path("metrics", "lookup_coverage")

    @property
    def estimate(self) -> str:
        return self.path("metrics", "requests")

    @property
    def monthly(self) -> str:
        return self.path("metrics", "monthly")

    def staged_counts(self, name: str) -> str:
        return self.path("metrics", "staged", name)

    def funnel(self, pull_type: str) -> str:
        return self.path("metrics", "funnel", pull_type)

    def work(self, pull_type: str) -> str:
        return self.path("user_timeline", "work", pull_type)

    @property
    def seeds(self) -> str:
        return self.path("lookup_users", "seeds")

    @property
    def lookups(self) -> str:
        return self.path("lookup_users", "profiles")

    @property
    def bad_users(self) -> str:
        return self.path("lookup_users", "badRecords")

    @property
    def lookup_batch(self) -> str:
        return self.path("lookup_users", "batch")

    @property
    def lookup_work(self) -> str:
        return self.path("lookup_users", "work")

    @property
    def locations(self) -> str:
        return self.path("preprocessed", "locations", "locations_geocoded.parquet")

    @property
    def urls(self) -> str:
        return self.path("preprocessed", "urls")

    def stats(self, country: str) -> str:
        return self.path("preprocessing", "stats", country)

    def lists_batch(self, country: str, relation: str = "friends") -> str:
        return self.path(f"{relation}_ids", country, "batch.csv")

    def lists_work(self, country: str, relation: str = "friends") -> str:
        return self.path(f"{relation}_ids", country, "work")

    def friends(self, country: str) -> str:
        return self.path("friends_ids", country, "edges")

    @property
    def follows(self) -> str:
        return self.path("preprocessed", "follows")


class Jobs:
    """One method per job; ``options`` are the command-line options."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.at = Layout(root)

    def _table(self, path: str, *columns: str) -> DataFrame:
        return tables.read_table(self.spark, path, columns or None)

    def _locations(self) -> DataFrame:
        return self._table(self.at.locations, "user_location", "country_short")

    def _or_empty(self, read: Callable[[], DataFrame], schema: str) -> DataFrame:
        """``read()``, or no rows if nothing lies there."""
        try:
            return read()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _stored_lists(self, countries: list[str], relation: str) -> DataFrame:
        """A row with a map for each stored file of the countries."""

        def of(country: str) -> DataFrame:
            path, schema = self.at.raw_lists(country, relation), "friends map<string,array<string>>"
            maps = self._or_empty(lambda: tables.read_friend_maps(self.spark, path), schema)
            return maps.select(F.lit(country).alias("country_short"), "friends")

        return reduce(DataFrame.unionByName, map(of, dict.fromkeys(countries)))

    def _files(self, path: str) -> DataFrame:
        name = landing.file_name("path").alias("file_name")
        return self._or_empty(lambda: self.spark.read.format("binaryFile").load(path).select(name), "file_name string")

    def _staged(self, paths: str | list[str], schema: T.StructType, name: str, bad_path: str, multi_line: bool) -> DataFrame:
        """The landing zone parsed once into a staging table; what is bad goes to the
        quarantine, which is always written anew, so a repaired file leaves it."""
        raw = landing.read_landing(self.spark, paths, schema, multi_line)
        records, counts = landing.staged(raw, self.at.staging(name))
        sinks.write_table(metrics.as_row(self.spark, counts), self.at.staged_counts(name))
        sinks.write_table(landing.bad_records(records), bad_path)
        return records

    def extract(
        self, countries: list[str], date: str = "*", pull_type: str = "*", files: int | None = None, multi_line: bool = True, **_
    ) -> None:
        """Raw posts to the post table; all pulls, or those of some countries, dates (a glob) or a type."""
        paths = [self.at.raw_posts(country, date, pull_type) for country in countries or ["*"]]
        records = self._staged(paths, RAW_POST, "posts", self.at.bad_posts, multi_line)
        sinks.write_table(extract_posts(landing.good_records(records).drop("source_file")), self.at.posts, n_files=files)

    def audit(self, countries: list[str], date: str = "*", pull_type: str = "*", **_) -> None:
        """Records per landing file, as the last ``extract`` staged them; files it skipped as
        unreadable have none. Only names and sizes are read from the landing zone."""
        paths = [self.at.raw_posts(country, date, pull_type) for country in countries or ["*"]]
        records = self._table(self.at.staging("posts"), "source_file", "is_good")
        sinks.write_table(landing.audit_files(self.spark, paths, records), self.at.audit)

    def timeline_profiles(self, **_) -> None:
        posts = self._table(self.at.posts, "tweet_id", "tweet_timestamp", *USER_COLUMNS)
        sinks.write_table(profiles.timeline_profiles(posts, self._locations()), self.at.profiles)

    def users_profiles(self, multi_line: bool = True, **_) -> None:
        """Raw user lookups to the lookup table."""
        records = self._staged(self.at.raw_users(), RAW_USER, "users", self.at.bad_users, multi_line)
        users = landing.good_records(records).drop("source_file")
        sinks.write_table(profiles.users_profiles(users, self._locations()), self.at.lookups)

    def snowball(self, distinct_authors: bool = False, **_) -> None:
        posts = self._table(self.at.posts)
        sinks.write_table(snowball(posts, self._locations(), distinct_authors), self.at.snowball)

    def users_batch(self, **_) -> None:
        ids = [self._table(path, "user_id") for path in (self.at.seeds, self.at.snowball, self.at.lookups)]
        sinks.write_table(batches.users_batch(*ids), self.at.lookup_batch)

    def timeline_batch(self, **_) -> None:
        batch = batches.timeline_batch(
            self._table(self.at.profiles, "user_id", "country_short", "tweet_id", "tweet_timestamp"),
            self._table(self.at.lookups, "user_id", "country_short", "tweet_id", "tweet_timestamp"),
            self._table(self.at.seeds, "user_id"),
        )
        sinks.write_table(batch, self.at.batch)

    def timeline_batch_v1(self, **_) -> None:
        batch = batches.timeline_batch_v1(
            self._table(self.at.profiles, "user_id", "country_short", "tweet_id", "tweet_timestamp"),
            self._table(self.at.lookups, "user_id", "country_short"),
            self._table(self.at.snowball, "user_id", "country_short", "n_users"),
        )
        sinks.write_table(batch, self.at.batch)

    def remaining_batch(
        self, countries: list[str], date: str = "*", pull_type: str = "*", multi_line: bool = True, **_
    ) -> None:
        """Batch users without a post in the named pulls (``date`` may be a glob)."""
        paths = [self.at.raw_posts(country, date, pull_type) for country in countries]
        records = self._staged(paths, PULLED, "pulled", self.at.bad_pulled, multi_line)
        pulled = landing.good_records(records).select(F.col("user.id_str").alias("user_id"))
        sinks.write_table(batches.remaining_batch(self._table(self.at.batch), pulled), self.at.remaining)

    def network_batch(self, countries: list[str], relation: str = "friends", **_) -> None:
        """Users whose friend (or follower) list is to be pulled, for all ``countries`` in one pass.
        A country without any stored list gets all its users."""
        stored = self._stored_lists(countries, relation)
        known = stored.select("country_short", F.explode(F.map_keys("friends")).alias("user_id"))
        path = scratch_path(self.spark, "network")
        users = self._table(self.at.profiles, "user_id", "country_short")
        sinks.write_partitioned(batches.network_batches(users, known, countries), path, ["country_short"])
        wanted = self.spark.read.schema("user_id string, country_short string").parquet(path)
        for country in countries:
            sinks.write_ids_csv(wanted.where(F.col("country_short") == country), self.at.lists_batch(country, relation))

    def network_work(self, countries: list[str], shards: int, hash_shards: bool = False, relation: str = "friends", **_) -> None:
        """The friend (or follower) batches as shards."""
        for country in countries:
            users = tables.read_ids_csv(self.spark, self.at.lists_batch(country, relation))
            work = self._sharded(users, shards, hash_shards)
            sinks.write_partitioned(work, self.at.lists_work(country, relation), ["shard"], whole=True)

    def follow_edges(self, countries: list[str], **_) -> None:
        """Who follows whom, by all stored friend and follower lists of ``countries``; replaces their partitions."""
        lists = [
            self._stored_lists(countries, relation).select("country_short", F.explode("friends").alias("user_id", "friend_ids"))
            for relation in RELATIONS
        ]
        edges = links.follow_edges(*lists, "country_short")
        sinks.write_partitioned(edges, self.at.follows, ["country_short"])

    def friend_edges(self, countries: list[str], **_) -> None:
        for country in countries:
            stored = tables.read_friend_lists(self.spark, self.at.raw_lists(country))
            sinks.write_table(links.friend_edges(stored, distinct=True), self.at.friends(country))

    def level_stats(self, countries: list[str], depth: int = 4, **_) -> None:
        """One table for each country; all are searched together."""
        stats = materialize(
            levels.level_stats(
                self._table(self.at.posts, "user_id", "tweet_mentioned_user_id"),
                self._table(self.at.profiles, "user_id", "country_short"),
                self._table(self.at.seeds, "user_id"),
                countries,
                depth,
            ),
            "stats",
        )
        for country in countries:
            sinks.write_table(stats.where(F.col("country_short") == country).drop("country_short"), self.at.stats(country))

    def post_urls(self, countries: list[str], all_urls: bool = False, **_) -> None:
        """Replaces the partitions of ``countries``; one without links is left empty."""
        posts = self._table(self.at.posts, "tweet_id", "user_location", "tweet_urls")
        urls = materialize(links.post_urls(posts, self._locations(), countries, all_urls), "urls")
        sinks.write_partitioned(urls, self.at.urls, ["country_short"])
        found = {r.country_short for r in urls.select("country_short").distinct().collect()}
        for country in countries:
            if country not in found:
                sinks.empty_partition(urls, self.at.urls, "country_short", country)

    @staticmethod
    def _sharded(users: DataFrame, shards: int, by_hash: bool, by: tuple[str, ...] = ()) -> DataFrame:
        return shard_by_hash(users, shards) if by_hash else cut_shards(users, shards, by=by)

    def select_work(
        self, countries: list[str], pull_type: str, shards: int, hash_shards: bool = False, remaining: bool = False, **options
    ) -> None:
        """The timeline work list of one pull type, written anew: one directory per country
        and shard. From the batch, or from what a pull has left of it."""
        names = ("min_timestamp", "max_timestamp", "drop_seeds")
        filters = worklist.work_filters(countries, pull_type, **{name: options[name] for name in names if options.get(name)})
        batch = self._table(self.at.remaining if remaining else self.at.batch)
        users, counts = worklist.select_and_count(batch, filters)
        sinks.write_table(metrics.as_row(self.spark, counts), self.at.funnel(pull_type))
        work = self._sharded(users, shards, hash_shards, ("country_short",))
        sinks.write_partitioned(work, self.at.work(pull_type), ["country_short", "shard"], whole=True)

    def lookup_work(self, shards: int, chunk: int = 100, hash_shards: bool = False, **_) -> None:
        """The lookup batch as shards of requests, written anew."""
        users = self._table(self.at.lookup_batch, "user_id")
        # Requests need the order inside a shard, too.
        sharded = shard_by_hash(users, shards) if hash_shards else assign_shards(users, shards, by=())
        requests = chunk_ids(sharded, chunk, by=["shard"])
        sinks.write_partitioned(requests, self.at.lookup_work, ["shard"], whole=True)

    def pull_coverage(self, **_) -> None:
        """Users of the batch asked for and got, by the posts of the last ``extract``."""
        posts = self._table(self.at.posts, "tweet_id", "user_id")
        sinks.write_table(metrics.pull_coverage(self._table(self.at.batch), posts), self.at.coverage)

    def coverage_by_pull(self, page: int = 200, **_) -> None:
        """The same for each pull, by the records that the last ``extract`` staged and the folders of their files."""
        staged = self._table(self.at.staging("posts"), "source_file", "is_good", "id_str", "user").where("is_good")
        posts = staged.select("source_file", F.col("id_str").alias("tweet_id"), F.col("user.id_str").alias("user_id"))
        pulled = landing.with_path_parts(posts, landing.files_under(self.spark, self.at.raw_posts()))
        sinks.write_table(metrics.coverage_by_pull(self._table(self.at.batch), pulled, page), self.at.coverage_by_pull)

    def lookup_coverage(self, **_) -> None:
        asked, got = self._table(self.at.lookup_batch, "user_id"), self._table(self.at.lookups, "user_id")
        sinks.write_table(metrics.lookup_coverage(asked, got), self.at.lookup_coverage)

    def request_estimate(self, page: int = 200, **_) -> None:
        users, posts = self._table(self.at.batch, "user_id").distinct(), self._table(self.at.posts, "tweet_id", "user_id")
        sinks.write_table(metrics.request_estimate(users, posts, page), self.at.estimate)

    def monthly_counts(self, start: str | None = None, **_) -> None:
        """Posts of the post table by month; months that end before ``start`` are left out."""
        posts = self._table(self.at.posts, "user_id", "tweet_timestamp")
        dated = posts.withColumn("tweet_timestamp", F.timestamp_seconds("tweet_timestamp"))
        sinks.write_table(metrics.monthly_counts(dated, "tweet_timestamp", start), self.at.monthly)

    def newer_posts(self, **_) -> None:
        """Posts of the post table that are newer than their author's mark in the batch."""
        marks = self._table(self.at.batch, "user_id", "tweet_id").where("tweet_id IS NOT NULL")
        sinks.write_table(worklist.newer_than_mark(self._table(self.at.posts), marks), self.at.newer)

    def pull_manifest(self, **_) -> None:
        """Totals of the stored pull files, from their names alone."""
        found = [self._files(path) for path in (self.at.raw_posts(), self.at.raw_users(), *(self.at.raw_lists("*", r) for r in RELATIONS))]
        files = reduce(DataFrame.unionByName, found)
        sinks.write_table(metrics.pull_manifest(files), self.at.manifest)


JOBS = [name for name in vars(Jobs) if not name.startswith("_")]
NEED_COUNTRIES = {
    "remaining_batch", "network_batch", "network_work", "friend_edges", "follow_edges", "level_stats", "post_urls", "select_work"
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True)
    parser.add_argument("--countries", nargs="+", default=[])
    parser.add_argument("--pull-type", default="*")
    parser.add_argument("--date", default="*")
    parser.add_argument("--min-timestamp")
    parser.add_argument("--start", help="first month end of the monthly counts")
    parser.add_argument("--max-timestamp")
    parser.add_argument("--drop-seeds", action="store_true")
    parser.add_argument("--distinct-authors", action="store_true")
    parser.add_argument("--all-urls", action="store_true")
    parser.add_argument("--skip-corrupt-files", action="store_true")
    parser.add_argument("--json-lines", dest="multi_line", action="store_false")
    parser.add_argument("--shards", type=int, default=30)
    parser.add_argument("--chunk", type=int, default=100)
    parser.add_argument("--depth", type=int, default=4)
    parser.add_argument("--files", type=int)
    parser.add_argument("--page", type=int, default=200)
    parser.add_argument("--hash-shards", action="store_true", help="shards by hash, equal on average, without a shuffle")
    parser.add_argument("--relation", choices=RELATIONS, default="friends", help="lists that the network jobs are about")
    parser.add_argument("--remaining", action="store_true", help="select from the remaining batch")
    parser.add_argument("--shuffle-width", help="shuffle partitions that adaptive execution starts from")
    options = vars(parser.parse_args(arguments))
    job, root = options.pop("job"), options.pop("root")
    if job in NEED_COUNTRIES and not options["countries"]:
        parser.error(f"{job} needs --countries")
    spark = build_session(f"cohortgraph {job}")
    if width := options.pop("shuffle_width"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", width)
    if options.pop("skip_corrupt_files"):
        landing.skip_corrupt_files(spark)
    getattr(Jobs(spark, root), job)(**options)


if __name__ == "__main__":
    main()
