import bz2
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortgraph.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        spark_master="local[4]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a table from tuples and a schema string."""

    def build(schema, *values):
        return spark.createDataFrame(list(values), schema)

    return build


@pytest.fixture
def bag():
    """Rows as a sorted list of tuples, nulls first."""

    def collect(df, *columns):
        found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
        return sorted(found, key=lambda row: [(value is not None, str(value)) for value in row])

    return collect


def write_bz2_array(path, records):
    """One JSON array in a bz2 file, as pulled."""
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(bz2.compress(json.dumps(records).encode()))


def raw_user(user_id, location="Somewhere", **fields):
    user = {"id_str": user_id, "location": location, "created_at": "Mon Jan 05 00:00:00 +0000 2015"}
    return user | {"statuses_count": 1, "verified": False} | fields


def raw_post(post_id, user_id="1", created_at="Wed Oct 10 20:19:24 +0000 2018", **fields):
    post = {"id_str": post_id, "created_at": created_at, "user": raw_user(user_id), "lang": "en"}
    return post | {"entities": {"user_mentions": [], "urls": []}} | fields
