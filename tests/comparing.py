"""Spark result against SQL result: names, types, rows as a bag."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return connection


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs; empty if equal."""
    cursor = connection.execute(sql)
    expected_types = {column[0]: str(column[1]) for column in cursor.description}
    names = [column[0] for column in cursor.description]
    types = {name: TYPES.get(kind, kind) for name, kind in result.dtypes}
    if types != expected_types:
        return [f"columns {sorted(set(types.items()) ^ set(expected_types.items()))}"]
    expected = Counter(tuple(row) for row in cursor.fetchall())
    actual = Counter(tuple(row) for row in result.select(*names).collect())
    found = [f"{len(list(actual.elements()))} rows, expected {len(list(expected.elements()))}"]
    found += [f"unexpected {names} {row}" for row in list((actual - expected).elements())[:3]]
    found += [f"missing {names} {row}" for row in list((expected - actual).elements())[:3]]
    return found if actual != expected else []
