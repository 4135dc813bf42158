"""The landing zone: files of raw JSON records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortgraph.operators.sizing import fits
from cohortgraph.schemas import CORRUPT_COLUMN, RAW_POST, RAW_USER
from cohortgraph.session import materialize, observed, settings

Paths = str | Sequence[str]
#: A record as it was read.
ELEMENT = "element"
#: A byte of bzip2 holds tens of bytes of JSON, and even a small file takes longer to unpack than to open: with
#: Spark's own figures (128 MB, 4 MB) tasks get as many files each, whatever their size.
SPLITS = {"spark.sql.files.maxPartitionBytes": f"{4 << 20}b", "spark.sql.files.openCostInBytes": f"{64 << 10}b"}


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_elements(spark: SparkSession, paths: Paths, multi_line: bool = True) -> DataFrame:
    """(source_file, ``element``, ``_corrupt_record``): every record under ``paths`` (globs allowed) whole, as VARIANT.

    ``multi_line`` files hold one JSON array (or one object) and are read once, as text, by one
    task each; each of their elements becomes a value of its own, so neither an odd element nor a
    large file costs more than its share, though a file's text must fit a row (2 GB). Other files hold
    one record per line. Compression follows the file suffix. What does not parse has no element
    but its text: the whole file's, or the line's; blank ones are nothing. Of a key that a record repeats the last one counts.
    """
    # Without this a single record with a doubled key would take its whole file with it.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # Columns that a directory's name adds are no part of a record.
    text = spark.read.text(_paths(paths), wholetext=multi_line).select(F.col("_metadata.file_path").alias("source_file"), "value")
    text = text.where(F.trim("value") != "")
    if not multi_line:
        lines = text.select("source_file", F.try_parse_json("value").alias(ELEMENT), "value")
        return lines.select("source_file", ELEMENT, F.when(F.col(ELEMENT).isNull(), F.col("value")).alias(CORRUPT_COLUMN))
    alone = F.when(F.ltrim("value").startswith("{"), F.try_parse_json("value"))
    array = F.coalesce(F.from_json("value", "array<variant>"), F.when(alone.isNotNull(), F.array(alone)))
    files = text.select("source_file", "value", array.alias("elements"))
    unparsed = F.when(F.col("elements").isNull(), F.col("value")).alias(CORRUPT_COLUMN)
    records = files.select("source_file", unparsed, F.explode_outer("elements").alias(ELEMENT))
    return records.where(F.col(ELEMENT).isNotNull() | F.col(CORRUPT_COLUMN).isNotNull()).select("source_file", ELEMENT, CORRUPT_COLUMN)


def _fields(record: Column) -> Column:
    """The fields of a record as columns. Generated, not projected: a filter on a field would be pushed
    below a projection and parse every record once more."""
    return F.inline_outer(F.array(record))


def read_landing(spark: SparkSession, paths: Paths, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """All records under ``paths`` with an imposed schema, ``source_file`` and what their text is made of.

    A field of the wrong type is null and the rest of its record stays. Elements of an array keep
    their VARIANT beside the columns; a line keeps its text, and is parsed straight into the columns.
    """
    if multi_line:
        elements = read_elements(spark, paths)
        record = F.try_variant_get(ELEMENT, F.lit("$"), schema.simpleString())
        return elements.select(_fields(record), ELEMENT, CORRUPT_COLUMN, "source_file")
    lines = spark.read.text(_paths(paths)).select("value", F.col("_metadata.file_path").alias("source_file"))
    none = F.lit(None).cast("variant").alias(ELEMENT)
    text = F.col("value").alias(CORRUPT_COLUMN)
    return lines.where(F.trim("value") != "").select(_fields(F.from_json("value", schema)), none, text, "source_file")


def marked(landing: DataFrame, key: str = "id_str") -> DataFrame:
    """Records with ``is_good`` and, of bad ones, their text in ``bad_text``.

    Good is what has an id; no later step can use a record without one. The text of an array's
    element is its JSON, whatever fields it has; what did not parse is kept as it was.
    """
    fields = [c for c in landing.columns if c not in (ELEMENT, CORRUPT_COLUMN, "source_file")]
    good = F.col(key).isNotNull()
    text = F.when(~good, F.coalesce(F.to_json(ELEMENT), F.col(CORRUPT_COLUMN)))
    return landing.select(*fields, "source_file", good.alias("is_good"), text.alias("bad_text"))


def staged(landing: DataFrame, path: str, key: str = "id_str") -> tuple[DataFrame, dict]:
    """Marked records written to ``path`` as Parquet, and their counts: the landing zone is parsed
    once, and posts, quarantine and audit are taken from this table."""
    counts = {
        "n_records": F.count_if("is_good"),
        "n_bad": F.count_if(~F.col("is_good")),
        "n_bad_bytes": F.coalesce(F.sum(F.octet_length("bad_text")), F.lit(0)),
    }
    records, seen = observed(marked(landing, key), counts)
    with settings(landing.sparkSession, SPLITS):
        records.write.mode("overwrite").parquet(path)
    return landing.sparkSession.read.parquet(path), seen.get


def unpacked(found: DataFrame, name: str = "unpacked") -> DataFrame:
    """What is found in landing files, written to the shared folder: read once, in tasks of even work."""
    with settings(found.sparkSession, SPLITS):
        return materialize(found, name)


def good_records(records: DataFrame) -> DataFrame:
    return records.where("is_good").drop("is_good", "bad_text")


def bad_records(records: DataFrame) -> DataFrame:
    """(source_file, bad_text) of every record without an id and of every file or line that did not parse."""
    return records.where("NOT is_good").select("source_file", "bad_text")


def read_posts(
    spark: SparkSession, paths: Paths, schema: T.StructType = RAW_POST, multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Raw posts as (good, bad)."""
    records = marked(read_landing(spark, paths, schema, multi_line))
    return good_records(records), bad_records(records)


def read_users(
    spark: SparkSession, paths: Paths, schema: T.StructType = RAW_USER, multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Raw user lookups as (good, bad)."""
    records = marked(read_landing(spark, paths, schema, multi_line))
    return good_records(records), bad_records(records)


def skip_corrupt_files(spark: SparkSession) -> None:
    """Opt in to skipping unreadable files; use with ``audit_files``."""
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "true")


def audit_files(spark: SparkSession, paths: Paths, records: DataFrame) -> DataFrame:
    """(source_file, n_bytes, n_records, n_bad) of every file under ``paths``.

    ``records`` are marked. ``n_records`` counts those with an id; a file that was skipped or
    gave nothing has 0.
    """
    listed = files_under(spark, paths)
    read = records.groupBy("source_file").agg(
        F.count_if("is_good").alias("n_records"), F.count_if(~F.col("is_good")).alias("n_bad")
    )
    return listed.join(read, "source_file", "left").fillna(0, ["n_records", "n_bad"])


def path_parts(path: Column | str = "source_file") -> list[Column]:
    """Country, pull date and pull type out of ``…/<country>/<date>/<type>/<file>``; a
    directory may also be named ``<column>=<value>``. Meant for a row a file, see ``with_path_parts``."""
    directories = F.split(path, "/")
    names = ("country_short", "pull_date", "pull_type")
    # A directory is called by its value, the part after the first "=".
    found = (F.element_at(directories, at - len(names) - 1) for at in range(len(names)))
    return [F.regexp_replace(part, "^[^=]+=", "").alias(name) for part, name in zip(found, names, strict=True)]


def files_under(spark: SparkSession, paths: Paths) -> DataFrame:
    """(source_file, n_bytes) of every file; only the listing is read, not the contents."""
    listed = spark.read.format("binaryFile").load(_paths(paths))
    return listed.select(F.col("_metadata.file_path").alias("source_file"), F.col("length").alias("n_bytes"))


def with_path_parts(records: DataFrame, files: DataFrame) -> DataFrame:
    """Records with the parts of their file's path, taken once for each of ``files`` (source_file, more).

    The files are a dimension table: measured, broadcast if small, joined by a shuffle beyond.
    """
    dimension = files.select("source_file", *path_parts())
    if fits(files.select("source_file")):
        dimension = F.broadcast(dimension)
    return records.join(dimension, "source_file", "left")


def file_name(path: Column | str = "source_file") -> Column:
    return F.element_at(F.split(path, "/"), -1)
