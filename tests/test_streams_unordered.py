"""Every registered stream query over files that are not in order of time.

One file per micro-batch, with null keys, values and texts, against the same SQL.
"""

import random

import duckdb
import pytest
from compare import compare
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.plans import registry
from tidemark.streaming import run

SOURCE = "/root/testdata/sf0.001/events.parquet"
FILES = 5


def unordered(spark, folder, timeless=False):
    table = spark.read.parquet(SOURCE)
    rows = [r.asDict() for r in table.orderBy("ts").limit(400).collect()]
    make = random.Random(4)
    for r in rows:
        r["user_id"] = r["user_id"] % 40
        for name in ("user_id", "value", "props"):
            if make.random() < 0.08:
                r[name] = None
        if timeless:
            r["ts"] = None if make.random() < 0.1 else r["ts"]
    make.shuffle(rows)
    schema = table.schema
    for f in schema.fields:
        f.nullable = True
    for i in range(FILES):
        part = [tuple(r[n] for n in schema.names) for r in rows[i::FILES]]
        df = spark.createDataFrame(part, schema)
        df.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def directory(spark, tmp_path_factory):
    return unordered(spark, tmp_path_factory.mktemp("unordered"))


@pytest.fixture(scope="module")
def con(directory):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{directory}/events.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.STREAMS))
def test_stream_query(spark, con, directory, name, monkeypatch):
    monkeypatch.setattr(run, "FILES_PER_TRIGGER", 1)
    assert spark.read.parquet(f"{directory}/events.parquet").filter(F.isnull("user_id")).count() > 5
    rows, problems = compare(entry.queries()[name](spark, directory), con, entry.oracle_sql()[name])
    assert not problems
    assert rows > 0


def test_rows_without_a_time_reach_the_sinks(spark, tmp_path, monkeypatch):
    """Operators that need no time keep such rows; the end markers stay out."""
    monkeypatch.setattr(run, "FILES_PER_TRIGGER", 1)
    directory = unordered(spark, tmp_path, timeless=True)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{directory}/events.parquet/*.parquet'")
    assert con.execute("SELECT count(*) FROM events WHERE ts IS NULL").fetchone()[0] > 5
    name = "k7_two_sinks_stream"
    rows, problems = compare(entry.queries()[name](spark, directory), con, entry.oracle_sql()[name])
    assert not problems
    assert rows == 400
