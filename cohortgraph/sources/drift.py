"""What raw records look like, as aggregates: the schema they have in common, and where they leave ours."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortgraph.session import materialize
from cohortgraph.sources.landing import ELEMENT

#: Levels of nesting that are looked at.
DEPTH = 8
# Names of the engine's types in a VARIANT's schema.
TYPE_NAMES = {
    T.StringType: "STRING",
    T.LongType: "BIGINT",
    T.IntegerType: "BIGINT",
    T.DoubleType: "DOUBLE",
    T.BooleanType: "BOOLEAN",
    T.StructType: "OBJECT",
    T.ArrayType: "ARRAY",
}
# The same types in a table's schema.
DDL_WORDS = {
    "OBJECT": "struct", "ARRAY": "array", "STRING": "string", "BIGINT": "bigint", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DECIMAL": "decimal", "VOID": "void", "VARIANT": "variant",
}
# Types that a record may have where another is expected.
ALSO_FINE = {"DOUBLE": ("DECIMAL", "BIGINT")}


def _kind(schema: Column | str) -> Column:
    """The outermost type: ``OBJECT<…>`` is OBJECT, ``DECIMAL(3,1)`` is DECIMAL."""
    return F.regexp_extract(schema, "^[A-Z_]+", 0)


def _children(nodes: DataFrame) -> DataFrame:
    parents = nodes.select("whole", "n", F.col("path").alias("parent"), F.col("value").alias("held"))
    step = F.when(F.col("key").isNull(), "[]").otherwise(F.concat(F.lit("."), F.col("key")))
    inner = parents.lateralJoin(nodes.sparkSession.tvf.variant_explode(F.col("held").outer()))
    return inner.select("whole", "n", F.concat("parent", step).alias("path"), "value")


def _nodes(elements: DataFrame, depth: int) -> DataFrame:
    """(whole, n, path, value): the values in one record of each schema, and how many records have that schema.

    A path is ``$``, ``$.user.id_str``, or ``$.urls[].url`` for what is inside an array. Records are
    reduced to one of each schema map-side: there are as many as there are combinations of present
    fields, however many records. Only those are taken apart, one level at a time.
    """
    of_schema = elements.where(F.col(ELEMENT).isNotNull()).groupBy(F.schema_of_variant(ELEMENT).alias("whole"))
    found = of_schema.agg(F.count(F.lit(1)).alias("n"), F.first(ELEMENT).alias("value"))
    levels = [materialize(found.select("whole", "n", F.lit("$").alias("path"), "value"), "level")]
    for _ in range(depth):
        levels.append(materialize(_children(levels[-1]), "level"))
    return reduce(DataFrame.unionByName, levels)


def inferred(elements: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(path, schema): what all records have in common, ``$`` being the whole record."""
    return _nodes(elements, depth).groupBy("path").agg(F.schema_of_variant_agg("value").alias("schema"))


def as_ddl(schema: Column | str) -> Column:
    """The schema of a VARIANT in the words of a table's schema."""
    schema = F.regexp_replace(schema, ": ", ":")
    for word, ours in DDL_WORDS.items():
        schema = F.regexp_replace(schema, f"(^|[<:]){word}(?=[<(,>]|$)", f"$1{ours}")
    return F.regexp_replace(schema, ", ", ",")


def path_types(elements: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(path, type, n_records): records with a value of the outermost ``type`` at ``path``; elements of an
    array are merged."""
    merged = _nodes(elements, depth).groupBy("whole", "n", "path").agg(_kind(F.schema_of_variant_agg("value")).alias("type"))
    return merged.groupBy("path", "type").agg(F.sum("n").alias("n_records"))


def expected_types(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """(path, type_expected) of a constant schema."""
    found = []

    def walk(path: str, kind: T.DataType) -> None:
        found.append((path, TYPE_NAMES[type(kind)]))
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                walk(f"{path}.{field.name}", field.dataType)
        elif isinstance(kind, T.ArrayType):
            walk(f"{path}[]", kind.elementType)

    walk("$", schema)
    return spark.createDataFrame(found, "path string, type_expected string")


def drift(elements: DataFrame, schema: T.StructType, depth: int = DEPTH) -> DataFrame:
    """(path, type_found, type_expected, n_records, is_drift): the records against a constant schema.

    Expected paths that no record has count 0; paths that nothing expects have no expected type. A
    null fits any type, and what lies below a path that is kept whole, as text, is not looked at.
    """
    expected = expected_types(elements.sparkSession, schema)
    found = path_types(elements, depth).withColumnRenamed("type", "type_found")
    texts = expected.where("type_expected = 'STRING'").select(F.col("path").alias("kept"))
    inside = F.col("path").startswith(F.concat("kept", F.lit("."))) | F.col("path").startswith(F.concat("kept", F.lit("[")))
    found = found.join(F.broadcast(texts), inside, "left_anti")
    fine = F.col("type_found") == F.col("type_expected")
    for kind, others in ALSO_FINE.items():
        fine |= (F.col("type_expected") == kind) & F.col("type_found").isin(*others)
    fine |= F.col("type_expected").isNotNull() & (F.col("type_found").isNull() | (F.col("type_found") == "VOID"))
    return (
        found.join(F.broadcast(expected), "path", "full")
        .select("path", "type_found", "type_expected", F.coalesce("n_records", F.lit(0)).alias("n_records"))
        .withColumn("is_drift", ~F.coalesce(fine, F.lit(False)))
    )
