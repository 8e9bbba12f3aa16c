"""Readers and writers. Network connectors are checked up to their options."""

import json
import os
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sinks import jdbc, kafka as kafka_sink, keyed, streams
from tidemark.sources import files, kafka
from tidemark.sources.tables import from_rows, stream_table
from tidemark.streaming.run import drain, drain_batches, start

# the writer below runs in the workers, which do not have this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_lines(spark, lines):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


BROKEN = ["1,2,3,pv,4", "1,2,3,pv", "x,2,3,pv,4", "no commas", "1,2,3,pv,later", ""]


def test_behavior_file_batch_and_stream(spark):
    path = write_lines(spark, ["543462,1715,1464116,pv,1511658000", "662867,2244074,1575622,buy,1511658001"])
    want = [(543462, 1715, 1464116, "pv", 1511658000), (662867, 2244074, 1575622, "buy", 1511658001)]

    def shown(df):
        cols = ["user_id", "item_id", "category_id", "behavior", F.unix_seconds("ts")]
        return sorted(tuple(r) for r in df.select(*cols).collect())

    assert shown(files.read_behavior(spark, path)) == want
    assert shown(drain(files.read_behavior(spark, path, streaming=True), "s1")) == want
    parsed = files.parse_behavior(files.read_lines(spark, write_lines(spark, BROKEN)))
    assert files.accepted(parsed, files.BEHAVIOR_REQUIRED).count() == 1
    assert {r["line"] for r in files.rejected(parsed, files.BEHAVIOR_REQUIRED).collect()} == set(BROKEN[1:])


def test_access_log_keeps_rejects(spark):
    good = "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/a.png"
    bad = ["83.149.9.216 - - 17-05-2015 +0000 GET /x", "short line", ""]
    parsed = files.parse_access_log(files.read_lines(spark, write_lines(spark, [good, *bad])))
    row = files.accepted(parsed).first()
    assert (row["ip"], row["user_id"], row["method"], row["url"]) == (
        "83.149.9.216", "-", "GET", "/presentations/a.png"
    )
    assert row["ts"].strftime("%Y-%m-%d %H:%M:%S") == "2015-05-17 10:05:03"
    assert {r["line"] for r in files.rejected(parsed).collect()} == set(bad)


def test_keyed_times_stream(spark):
    path = write_lines(spark, ["a 1", "a 2", "b x"])
    parsed = files.parse_keyed_times(files.read_lines(spark, path, streaming=True))
    got = drain(files.accepted(parsed), "s3").select("key", F.unix_seconds("ts")).collect()
    assert sorted(tuple(r) for r in got) == [("a", 1), ("a", 2)]


def test_kafka_options_and_decoding(spark):
    options = kafka.source_options("h1:9092,h2:9092", "items", group="g", max_offsets=1000)
    assert options["startingOffsets"] == "latest" and options["subscribe"] == "items"
    assert options["kafka.group.id"] == "g" and options["maxOffsetsPerTrigger"] == "1000"
    raw = spark.createDataFrame(
        [(None, "1,2,3,pv,10".encode(), "items", 0, 5, None, 0)], kafka.KAFKA_SCHEMA
    )
    row = files.parse_behavior(kafka.decode(raw)).first()
    assert (row["user_id"], row["behavior"]) == (1, "pv")
    with pytest.raises(ValueError):
        kafka_sink.sink_options("h:9092", "items", source_topic="items")
    assert kafka_sink.encode(spark.range(1), "id").schema.simpleString() == "struct<value:string>"


class FolderWriter:
    """Writes each bulk request as one file."""

    def __init__(self, folder):
        self.folder = folder

    def write(self, rows):
        with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as f:
            json.dump([r.asDict() for r in rows], f)

    def close(self):
        pass


def stored(folder):
    return [json.load(open(os.path.join(folder, f))) for f in os.listdir(folder)]


def test_keyed_store_keeps_last_write(spark, tmp_path):
    df = from_rows(spark, [("a", 1.0), ("b", 5.0), ("a", 3.0), ("a", 2.0)], "id string, v double")
    folder = str(tmp_path)
    run = keyed.upsert_batch(lambda: FolderWriter(folder), ["id"], ["arrival"])
    run(df, 0)
    rows = [r for bulk in stored(folder) for r in bulk]
    assert sorted((r["id"], r["v"]) for r in rows) == [("a", 2.0), ("b", 5.0)]
    fields = keyed.hash_fields(df, "id", "v", ["arrival"])
    assert sorted(tuple(r) for r in fields.collect()) == [("a", "2.0"), ("b", "5.0")]


def test_documents_in_bulk_requests(spark, tmp_path):
    docs = keyed.documents(spark.range(25).withColumn("n", F.lit(1)), ["id"], ["id", "n"])
    folder = str(tmp_path)
    keyed.write_partitions(docs.coalesce(1), lambda: FolderWriter(folder), batch_size=10)
    bulks = stored(folder)
    assert sorted(len(b) for b in bulks) == [5, 10, 10]
    by_id = {r["doc_id"]: json.loads(r["document"]) for b in bulks for r in b}
    assert len(by_id) == 25 and by_id["7"] == {"id": 7, "n": 1}


def test_several_sinks_from_one_stream(spark, tmp_path):
    path = scratch_path(spark, "multi")
    spark.range(10).coalesce(1).write.parquet(path)
    stream = stream_table(spark, path, spark.read.parquet(path).schema)
    seen = {"a": 0, "b": 0, "odd": 0, "even": 0}

    def counter(name):
        def add(batch, _):
            seen[name] += batch.count()
        return add

    routed = streams.fan_out_routed(
        {"odd": F.col("id") % 2 == 1, "even": F.lit(True)},
        {"odd": counter("odd"), "even": counter("even")},
    )
    drain_batches(stream, "multi", streams.fan_out(counter("a"), counter("b"), routed))
    assert seen == {"a": 10, "b": 10, "odd": 5, "even": 5}


def test_console_sink_with_interval_trigger(spark, capfd):
    path = scratch_path(spark, "console")
    spark.range(3).coalesce(1).write.parquet(path)
    stream = stream_table(spark, path, spark.read.parquet(path).schema)
    query = start(
        streams.to_console(stream), scratch_path(spark, "console-cp"), every="1 second"
    )
    try:
        query.processAllAvailable()
        assert query.lastProgress is not None and query.exception() is None
    finally:
        query.stop()
        query.awaitTermination(30)


def test_upsert_statements_and_flow(spark):
    target = jdbc.Target("jdbc:x", "temps", ("sensor",), ("temp",), {"user": "u"})
    update, insert = jdbc.merge_statements(target)
    assert update == (
        "UPDATE temps SET temp = (SELECT s.temp FROM temps_staging s WHERE "
        "s.sensor = temps.sensor) WHERE EXISTS (SELECT 1 FROM temps_staging s WHERE "
        "s.sensor = temps.sensor)"
    )
    assert insert == (
        "INSERT INTO temps (sensor, temp) SELECT s.sensor, s.temp FROM temps_staging s "
        "WHERE NOT EXISTS (SELECT 1 FROM temps WHERE s.sensor = temps.sensor)"
    )
    calls = []
    df = from_rows(spark, [("a", 1.0), ("a", 2.0)], "sensor string, temp double")
    run = jdbc.upsert_batch(
        target, ["arrival"],
        stage=lambda rows: calls.append([tuple(r) for r in rows.collect()]),
        execute=lambda sql: calls.append(sql),
    )
    run(df, 0)
    assert calls == [[("a", 2.0)], [update, insert]]


def test_good_lines_are_parsed_once(spark, tmp_path):
    """No filter parses a line that the projection parses too."""
    (tmp_path / "b.csv").write_text("1,2,3,pv,1700000000\nbad\n1,2,x,pv,5\n\n")
    good = files.read_behavior(spark, f"{tmp_path}/b.csv")
    views = good.filter("behavior = 'pv'").groupBy("item_id").count()
    assert [tuple(r) for r in views.collect()] == [(2, 1)]
    plan = views._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [x for x in plan if "Filter" in x and ("split" in x or "cast" in x)]
