"""Each single operator as a query over the given tables."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import hashing, text, times, udfs
from tidemark.operators import (
    distinct,
    lateness,
    rolling,
    topn,
    transforms,
    windows,
)
from tidemark.operators import alerts
from tidemark.plans.apps import BY_TIME, hot_item_documents, us
from tidemark.session import scratch_path
from tidemark.sinks import folder, keyed
from tidemark.sources import files, kafka, views
from tidemark.sources.tables import as_table, load_table

WINDOW_END = windows.WINDOW_END


def cents(column: str = "value"):
    return F.round(F.col(column) * 100).cast("long")


# -- sources ------------------------------------------------------------------


def behavior_file(spark: SparkSession, d: str) -> DataFrame:
    """Behaviour CSV written from the events and read back."""
    path = scratch_path(spark, "behavior-csv")
    views.behavior(spark, d).select(
        "user_id", "item_id", F.lit(1).alias("category_id"), "behavior",
        F.unix_seconds("ts").alias("epoch_seconds"),
    ).write.csv(path)
    return files.read_behavior(spark, path).select(
        "user_id", "item_id", "category_id", "behavior", us().alias("ts_us")
    )


def behavior_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a behaviour file in which every error event has no time."""
    path = scratch_path(spark, "behavior-lines")
    seconds = F.unix_seconds("ts").cast("string")
    views.behavior(spark, d).select(
        F.concat_ws(
            ",",
            F.col("user_id").cast("string"),
            F.col("item_id").cast("string"),
            F.lit("1"),
            "behavior",
            F.when(F.col("behavior") == "error", "unknown").otherwise(seconds),
        )
    ).write.text(path)
    parsed = files.parse_behavior(files.read_lines(spark, path))
    return files.rejected(parsed, files.BEHAVIOR_REQUIRED)


def access_log(spark: SparkSession, d: str) -> DataFrame:
    log = files.accepted(files.parse_access_log(views.access_lines(spark, d)))
    return log.select("ip", "user_id", us().alias("ts_us"), "method", "url")


def access_log_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a log in which every error event has a damaged time field."""
    damaged = views.events(spark, d).select(
        F.format_string(
            "10.0.0.%s - %s %s +0000 GET /item/%s",
            views.item_id(),
            F.col("user_id"),
            F.when(F.col("event_type") == "error", F.lit("99/99/2024"))
            .otherwise(F.date_format("ts", "dd/MM/yyyy:HH:mm:ss")),
            views.item_id(),
        ).alias("value")
    )
    return files.rejected(files.parse_access_log(damaged))


def keyed_times(spark: SparkSession, d: str) -> DataFrame:
    lines = views.events(spark, d).select(
        F.concat_ws(
            " ", F.col("event_type"), F.unix_seconds("ts").cast("string")
        ).alias("value")
    )
    rows = files.accepted(files.parse_keyed_times(lines))
    return windows.count(rows, "ts", "1 day", ["key"])


def kafka_decode(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.plans.apps import behavior_messages

    parsed = files.parse_behavior(kafka.decode(behavior_messages(spark, d)))
    rows = files.accepted(parsed, files.BEHAVIOR_REQUIRED)
    return rows.select("user_id", "item_id", "behavior", us().alias("ts_us"))


def table_subset(spark: SparkSession, d: str) -> DataFrame:
    table = as_table(
        views.sensor(spark, d),
        {"sensor": "id", "reading": "temperature", "rowtime": "ts"},
        event_time="rowtime",
    )
    return table.select("sensor", "reading", us("rowtime").alias("rowtime_us"))


def sql_view(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(
        "SELECT id, max(temperature) AS top FROM {sensor} GROUP BY id", sensor=views.sensor(spark, d)
    )


# -- row-wise -----------------------------------------------------------------


def map_rows(spark: SparkSession, d: str) -> DataFrame:
    return views.sensor(spark, d).select(
        "event_id", "id", (F.col("temperature") * 2).alias("doubled")
    )


def filter_rows(spark: SparkSession, d: str) -> DataFrame:
    return views.sensor(spark, d).filter(F.col("id") == "sensor_1").select(
        "event_id", "temperature"
    )


def filter_greater(spark: SparkSession, d: str) -> DataFrame:
    return views.events(spark, d).filter(F.col("value") > 10).select("event_id", "value")


def filter_not_equal(spark: SparkSession, d: str) -> DataFrame:
    return (
        views.marketing(spark, d)
        .filter(transforms.not_equal("behavior", views.UNINSTALL))
        .groupBy("channel", "behavior")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def flat_map(spark: SparkSession, d: str) -> DataFrame:
    """Views once, purchases twice, everything else not at all."""
    kind = F.col("event_type")
    copies = F.when(kind == "view", 1).when(kind == "purchase", 2).otherwise(0)
    return transforms.repeat_rows(
        views.events(spark, d).select("event_id", "event_type"), copies
    )


def tokenise(spark: SparkSession, d: str) -> DataFrame:
    return text.words(load_table(spark, d, "documents").select("doc_id", "text"), "text")


def table_select(spark: SparkSession, d: str) -> DataFrame:
    return views.sensor(spark, d).select("id", "temperature").filter("id = 'sensor_1'")


def rich_map(spark: SparkSession, d: str) -> DataFrame:
    def add_one(_: object, batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(plus_one=batch["event_id"] + 1)

    return transforms.map_with_lifecycle(
        views.events(spark, d).select("event_id"),
        "event_id long, plus_one long",
        start=lambda: None,
        each=add_one,
        stop=lambda _: None,
    )


def split_branches(spark: SparkSession, d: str) -> DataFrame:
    branches = transforms.route(
        views.events(spark, d).select("event_id", "value"),
        {"large": F.col("value") > 50, "small": F.lit(True)},
    )
    return transforms.union_all(
        *[b.withColumn("branch", F.lit(n)) for n, b in branches.items()]
    )


def connect(spark: SparkSession, d: str) -> DataFrame:
    """Logins and orders as two inputs; each drops its own sentinel type."""
    return transforms.connect(
        views.logins(spark, d),
        views.orders(spark, d),
        lambda x: x.filter("event_type <> 'view'").select(
            F.concat(F.lit("first: "), "event_type").alias("label"), "event_id"
        ),
        lambda x: x.filter("event_type <> 'create'").select(
            F.concat(F.lit("second: "), "event_type").alias("label"), "event_id"
        ),
    )


def repartition(spark: SparkSession, d: str) -> DataFrame:
    rows = views.events(spark, d).select("event_id", "user_id")
    return transforms.shrink(transforms.rebalance(rows, 16), 4)


def union(spark: SparkSession, d: str) -> DataFrame:
    rows = views.events(spark, d).select("event_id", "event_type")
    return transforms.union_all(
        rows.filter("event_type = 'view'"),
        rows.filter("event_type = 'click'"),
        rows.filter("event_type in ('view', 'purchase')"),
    )


# -- aggregates ---------------------------------------------------------------


def _money(spark: SparkSession, d: str) -> DataFrame:
    return views.events(spark, d).select(
        "user_id", "ts", "event_id", cents().alias("cents"), "event_type"
    )


def rolling_value(spark: SparkSession, d: str, kind: str) -> DataFrame:
    out = rolling.rolling(_money(spark, d), ["user_id"], BY_TIME, "cents", kind)
    return out.select("user_id", "event_id", "cents", "event_type")


def rolling_reduce(spark: SparkSession, d: str) -> DataFrame:
    """Part lists concatenated along the lines of each order."""
    lines = load_table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.array(F.col("l_partkey").cast("string")).alias("parts"),
    )
    out = rolling.rolling_concat(
        lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "parts"
    )
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.array_join("parts", ",").alias("parts"),
    )


def windowed_sum(spark: SparkSession, d: str) -> DataFrame:
    return windows.aggregate(
        _money(spark, d), "ts", "1 day", ["user_id"], {"total": F.sum("cents")}
    )


def sliding_min(spark: SparkSession, d: str) -> DataFrame:
    return windows.sliding(
        views.sensor(spark, d),
        "ts",
        "2 days",
        "1 day",
        ["id"],
        {"lowest": ("min", "temperature")},
    )


def min_max_row(spark: SparkSession, d: str) -> DataFrame:
    out = windows.min_max_row(_money(spark, d), "user_id", "cents")
    return out.select("user_id", "range.lo", "range.hi")


def top_two(spark: SparkSession, d: str) -> DataFrame:
    rows = views.events(spark, d).select("user_id", "event_id", cents().alias("cents"))
    return topn.top_values(rows, "user_id", "cents", 2, ["event_id"])


def top_two_changes(spark: SparkSession, d: str) -> DataFrame:
    rows = views.events(spark, d).select("user_id", "event_id", "ts", cents().alias("cents"))
    out = rolling.top_changelog(rows, ["user_id"], BY_TIME, "cents", 2)
    return out.select("user_id", "event_id", "is_add", F.col("value").alias("cents"), "rank")


def visitors_sketched(spark: SparkSession, d: str) -> DataFrame:
    """Sliding unique visitors from united sketches: an estimate, so without SQL."""
    return distinct.sketched(
        views.page_views(spark, d), "ts", "1 hour", "user_id", slide="5 minutes"
    )


def channel_counts(spark: SparkSession, d: str) -> DataFrame:
    """Per channel and behaviour, sliding windows as a stream would count them."""
    return windows.sliding_count(
        views.marketing(spark, d), "ts", "6 hours", "1 hour", ["channel", "behavior"]
    )


# -- functions ----------------------------------------------------------------


def string_hashes(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("c_name")
    return load_table(spark, d, "customer").select(
        "c_custkey",
        hashing.string_hash(name).alias("h"),
        hashing.string_hash(name, 13).alias("h13"),
        hashing.bit_offset(name).alias("bit"),
    )


def time_functions(spark: SparkSession, d: str) -> DataFrame:
    ts = F.col("ts")
    stamped = times.to_text(ts, "dd/MM/yyyy:HH:mm:ss")
    return views.events(spark, d).select(
        "event_id",
        times.to_millis(times.seconds(F.unix_seconds(ts).cast("string"))).alias("ms"),
        times.to_text(times.from_millis(times.to_millis(ts))).alias("text"),
        us_of(F.try_to_timestamp(stamped, F.lit(files.ACCESS_LOG_TIME))).alias("back_us"),
    )


def us_of(column):
    return F.unix_micros(column)


def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return views.events(spark, d).select(
        "event_id",
        F.abs(v - 50).alias("distance"),
        F.least(v, F.lit(10.0)).alias("low"),
        F.greatest(v, F.lit(10.0)).alias("high"),
        F.length("event_type").alias("len"),
        F.element_at(F.split("props", " "), 1).alias("head"),
        F.format_string("%s at %d", F.col("event_type"), F.col("user_id")).alias("label"),
    )


def hash_in_sql(spark: SparkSession, d: str) -> DataFrame:
    name = f"tidemark_hash_{uuid.uuid4().hex}"
    udfs.register_string_hash(spark, name, 13)
    return spark.sql(
        f"SELECT c_custkey, {name}(c_name) AS h FROM {{customers}}",
        customers=load_table(spark, d, "customer"),
    )


def split_in_sql(spark: SparkSession, d: str) -> DataFrame:
    name = f"tidemark_split_{uuid.uuid4().hex}"
    udfs.register_splitter(spark, name, " ")
    return spark.sql(
        f"SELECT p_partkey, p_name, word, length FROM {{parts}}, LATERAL {name}(p_name)",
        parts=load_table(spark, d, "part"),
    )


def split_native(spark: SparkSession, d: str) -> DataFrame:
    parts = load_table(spark, d, "part").select("p_partkey", "p_name")
    return text.words_with_length(parts, "p_name", " ")


# -- time ---------------------------------------------------------------------


def timer_callbacks(spark: SparkSession, d: str) -> DataFrame:
    out = alerts.timers(views.sensor(spark, d), "id", "ts", "5 seconds")
    return out.select("id", us("fires_at").alias("fires_us"))


def tumbling_close(spark: SparkSession, d: str) -> DataFrame:
    return windows.count(views.behavior(spark, d), "ts", "6 hours", ["behavior"])


def early_fire(spark: SparkSession, d: str) -> DataFrame:
    return windows.early_counts(
        views.sensor(spark, d), "ts", "1 day", "1 hour", ["id"]
    )


def change_log(spark: SparkSession, d: str) -> DataFrame:
    out = rolling.changelog(
        _money(spark, d),
        ["user_id"],
        BY_TIME,
        [("lo", "min", F.col("cents")), ("hi", "max", F.col("cents"))],
    )
    return out.select("user_id", "event_id", "is_add", "lo", "hi")


ARRIVAL = ["arrival", "event_id"]


def late_rows(spark: SparkSession, d: str) -> DataFrame:
    out = lateness.classify_lateness(
        views.arrivals(spark, d), ARRIVAL, "ts", "1 hour", delay="1 hour", allowed="1 hour"
    )
    return out.select("event_id", WINDOW_END, "lateness")


def behind_watermark(spark: SparkSession, d: str) -> DataFrame:
    out = lateness.behind_watermark(views.arrivals(spark, d), ARRIVAL, "ts")
    return out.filter("is_late").select("event_id")


def allowed_lateness(spark: SparkSession, d: str) -> DataFrame:
    return lateness.allowed_lateness_results(
        views.arrivals(spark, d),
        "user_id",
        ARRIVAL,
        "ts",
        "1 day",
        delay="1 hour",
        allowed="1 hour",
    )


# -- sinks --------------------------------------------------------------------


def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    """What a keyed store holds after all readings were written in order."""
    return keyed.latest(
        views.sensor(spark, d).select("id", "temperature", "ts", "event_id"),
        ["id"],
        BY_TIME,
    ).select("id", "temperature")


def keyed_store(spark: SparkSession, d: str) -> DataFrame:
    """Last readings written to a store from the tasks, and read back."""
    path = scratch_path(spark, "keyed-store")
    readings = views.sensor(spark, d).select(
        "id", "temperature", F.unix_micros("ts").alias("us"), "event_id"
    )
    newest = keyed.latest(readings, ["id"], ["us", "event_id"])
    keyed.write_partitions(newest, folder.writer(path))
    schema = "id string, temperature double, us long, event_id long"
    held = folder.stored(spark, path, schema, ["id"], ["us", "event_id"])
    return held.select("id", "temperature")


def document_index(spark: SparkSession, d: str) -> DataFrame:
    """The hot-item documents written in bulk requests, twice, and read back."""
    path = scratch_path(spark, "documents")
    found = hot_item_documents(spark, d)
    for _ in range(2):
        keyed.write_partitions(found, folder.writer(path), batch_size=500)
    return folder.stored(spark, path, "doc_id string, document string", ["doc_id"], ["document"])


def visitor_store_written(spark: SparkSession, d: str) -> DataFrame:
    """The visitor counts as fields of a hash, written and read back."""
    path = scratch_path(spark, "visitors")
    uv = distinct.bitmap(views.page_views(spark, d), "ts", "1 hour", "user_id")
    keyed.write_partitions(keyed.hash_fields(uv, WINDOW_END, "uv"), folder.writer(path))
    held = folder.stored(spark, path, "field string, value string", ["field"], ["value"])
    return held.select("field", F.col("value").alias("stored"))


def visitor_store(spark: SparkSession, d: str) -> DataFrame:
    """Hash fields and values of the visitor counts by window end."""
    uv = distinct.bitmap(views.page_views(spark, d), "ts", "1 hour", "user_id")
    return uv.select(
        F.col(WINDOW_END).cast("string").alias("field"),
        F.col("uv").cast("string").alias("stored"),
    )


def rank_over_windows(spark: SparkSession, d: str) -> DataFrame:
    """Busiest users per day, ties by id."""
    counts = windows.count(views.behavior(spark, d), "ts", "1 day", ["user_id"])
    return topn.top_n(counts, [WINDOW_END], "n", 5, ["user_id"])
