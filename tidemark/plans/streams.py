"""Stream forms of the queries: the events table replayed to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import distinct, topn, transforms, windows
from tidemark.session import scratch_path
from tidemark.sources import views
from tidemark.sources.tables import load_table
from tidemark.sinks import committed, keyed
from tidemark.sinks.streams import fan_out_routed
from tidemark.streaming import stateful
from tidemark.streaming.late import batch_folders, split_late
from tidemark.streaming.totals import running_totals
from tidemark.streaming.run import (
    Replay,
    drain,
    drain_anew,
    drain_batches,
    drain_writer,
    replay_arrivals,
    replay_events,
    replay_in_order,
)

WINDOW_END = windows.WINDOW_END


def kind(event_type: str):
    return F.col("event_type") == event_type


def _events(spark: SparkSession, d: str, *types: str):
    replay = replay_events(spark, d)
    wanted = F.col("event_type").isin(*types) if types else None
    return replay.rows.filter(replay.present(wanted)), replay


def _sides(spark: SparkSession, d: str, *conditions):
    """The stream once for each condition, all with the same watermark."""
    replay = replay_events(spark, d)
    return [replay.rows.filter(replay.present(c)) for c in conditions], replay


def _sensor(spark: SparkSession, d: str):
    rows, replay = _events(spark, d)
    return rows.select(
        "event_id",
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        F.col("value").alias("temperature"),
        "ts",
    ), replay


def _all(out: DataFrame, label: str, replay: Replay) -> DataFrame:
    """All that a stream of held rows gives, late rows too."""
    return drain(out, label, finish=replay.finish, partitions=replay.partitions)


def _done(out: DataFrame, label: str, replay: Replay) -> DataFrame:
    return stateful.results(_all(out, label, replay))


def jumps(spark: SparkSession, d: str) -> DataFrame:
    rows, replay = _sensor(spark, d)
    out = stateful.jumps(
        rows, "id", "ts", "event_id", "temperature", 50.0, first_is_zero=False
    )
    return _done(out, "jumps", replay).select(
        "id", "ts_us", "previous", F.col("value").alias("temperature")
    )


def rising_runs(spark: SparkSession, d: str) -> DataFrame:
    rows, replay = _sensor(spark, d)
    out = stateful.rising_runs(rows, "id", "ts", "event_id", "temperature", "6 hours")
    return _done(out, "rising", replay).select("id", "opened_us", "n")


def timers(spark: SparkSession, d: str) -> DataFrame:
    rows, replay = _sensor(spark, d)
    out = stateful.timers(rows, "id", "ts", "event_id", "5 seconds")
    return _done(out, "timers", replay)


def tumbling(spark: SparkSession, d: str) -> DataFrame:
    rows, replay = _events(spark, d)
    out = windows.count(
        rows.withColumn("behavior", F.col("event_type")), "ts", "6 hours", ["behavior"]
    )
    return drain(out, "tumbling", finish=replay.finish)


def visitors(spark: SparkSession, d: str) -> DataFrame:
    rows, replay = _events(spark, d, views.PAGE_VIEW)
    out = distinct.two_stage(rows, "ts", "1 hour", "user_id")
    return drain(out, "visitors", finish=replay.finish)


def order_timeouts(spark: SparkSession, d: str) -> DataFrame:
    rows, replay = _events(spark, d, views.ORDER_CREATE, views.ORDER_PAY)
    rows = rows.withColumnRenamed("user_id", "order_id")
    out = stateful.order_timeouts(
        rows, "order_id", "ts", "event_id", kind(views.ORDER_CREATE), "1 day"
    )
    return _done(out, "order-timeouts", replay).select(
        "order_id", "create_us", "fires_us"
    )


def reconciled(spark: SparkSession, d: str) -> DataFrame:
    sides, replay = _sides(spark, d, kind(views.ORDER_CREATE), kind(views.ORDER_PAY))
    out = stateful.reconcile(
        *(s.withColumnRenamed("user_id", "order_id") for s in sides),
        "order_id", "ts", "event_id", "1 day",
    )
    return (
        _done(out, "reconcile", replay)
        .filter("side = 'matched'")
        .select(
            "order_id",
            F.col("first_tie").alias("first_event"),
            F.col("second_tie").alias("second_event"),
        )
    )


def gate(spark: SparkSession, d: str) -> DataFrame:
    is_switch = kind("signup")
    (readings, switches), replay = _sides(spark, d, ~is_switch, is_switch)
    out = stateful.gate(
        readings,
        switches.withColumn("duration_us", F.lit(6 * 3_600_000_000)),
        "user_id", "ts", "event_id", "duration_us",
    )
    return _done(out, "gate", replay).select(
        F.col("tie").alias("event_id"), "user_id"
    )


def login_failures(spark: SparkSession, d: str) -> DataFrame:
    rows, replay = _events(spark, d, views.LOGIN_FAIL, views.LOGIN_SUCCESS)
    out = stateful.repeated_failures(
        rows, "user_id", "ts", "event_id",
        kind(views.LOGIN_FAIL), kind(views.LOGIN_SUCCESS), "2 days",
    )
    return _done(out, "login-failures", replay).select(
        "user_id", "opened_us", "n"
    )


def order_attempts(spark: SparkSession, d: str) -> DataFrame:
    rows, replay = _events(spark, d, views.ORDER_CREATE, views.ORDER_PAY)
    rows = rows.withColumnRenamed("user_id", "order_id")
    out = stateful.match_sequence(
        rows, "order_id", "ts", "event_id",
        [kind(views.ORDER_CREATE), kind(views.ORDER_PAY)],
        within="1 day", on_timeout=True,
    )
    return _done(out, "order-attempts", replay).select(
        "order_id", "outcome", F.get("times_us", F.lit(0)).alias("create_us"),
        F.get("times_us", F.lit(1)).alias("pay_us"),
    )


def change_log(spark: SparkSession, d: str) -> DataFrame:
    rows, replay = _events(spark, d)
    cents = F.round(F.col("value") * 100).cast("long")
    out = stateful.min_max_changelog(
        rows.withColumn("cents", cents), "user_id", "ts", "event_id", "cents"
    )
    return _done(out, "changelog", replay).select(
        "user_id", F.col("tie").alias("event_id"), "is_add", "lo", "hi"
    )


def top_two_changes(spark: SparkSession, d: str) -> DataFrame:
    rows, replay = _events(spark, d)
    cents = F.round(F.col("value") * 100).cast("long")
    out = stateful.top_changelog(
        rows.withColumn("cents", cents), "user_id", "ts", "event_id", "cents", 2
    )
    return _done(out, "top-two", replay).select(
        "user_id", F.col("tie").alias("event_id"), "is_add", F.col("value").alias("cents"), "rank"
    )


def early_fire(spark: SparkSession, d: str) -> DataFrame:
    rows, replay = _sensor(spark, d)
    out = stateful.early_fire(rows, "id", "ts", "event_id", "1 day", "1 hour")
    return _done(out, "early-fire", replay)


def visitors_bitmap(spark: SparkSession, d: str) -> DataFrame:
    """Unique visitors after each page view, from a bitmap in state and stored totals."""
    rows, replay = _events(spark, d, views.PAGE_VIEW)
    marks = stateful.bitmap_marks(rows, "ts", "event_id", "user_id", "1 hour")
    path = scratch_path(spark, "visitors-bitmap")
    count = running_totals(
        path, ["ts_us", "tie"], F.col("fresh").cast("long"), "uv", at_us="ts_us"
    )
    drain_batches(stateful.results(marks), "visitors-bitmap", count, finish=replay.finish)
    rows = spark.read.parquet(f"{path}/rows")
    return rows.select(F.col("tie").alias("event_id"), WINDOW_END, "uv")


#: The second of two streams lags more than the first: the slower one sets the pace.
SLOWER = "800 days"


def _two(spark: SparkSession, d: str, first, second):
    """Two streams of the table with watermarks of their own, ended together."""
    one, other = replay_events(spark, d), replay_events(spark, d, SLOWER)

    def both(a, b):
        return lambda: (a(), b())

    finish = [both(a, b) for a, b in zip(one.finish, other.finish, strict=True)]
    return one.rows.filter(one.present(first)), other.rows.filter(other.present(second)), finish


def gate_by_join(spark: SparkSession, d: str) -> DataFrame:
    is_switch = kind("signup")
    readings, switches, finish = _two(spark, d, ~is_switch, is_switch)
    out = stateful.gate_by_join(readings, switches, "user_id", "ts", "6 hours")
    return drain(out.select("event_id", "user_id", "value"), "gate-join", finish=finish)


def unpaid_by_join(spark: SparkSession, d: str) -> DataFrame:
    creates, pays, finish = _two(spark, d, kind(views.ORDER_CREATE), kind(views.ORDER_PAY))
    out = stateful.without_partner_by_join(creates, pays, "user_id", "ts", "1 day")
    rows = out.select(F.col("user_id").alias("order_id"), F.unix_micros("ts").alias("create_us"))
    return drain(rows, "unpaid-join", finish=finish)


def union(spark: SparkSession, d: str) -> DataFrame:
    """Daily counts over a union of streams: windows wait for the slower one's watermark."""
    fast, slow, finish = _two(
        spark, d, kind(views.PAGE_VIEW), F.col("event_type").isin("click", "purchase")
    )
    both = transforms.union_all(*(s.select("event_type", "ts") for s in (fast, slow)))
    return drain(windows.count(both, "ts", "1 day", ["event_type"]), "union", finish=finish)


def _arrivals(spark: SparkSession, d: str, watermark):
    rows = load_table(spark, d, "events").select(
        "event_id", "user_id", "event_type", "value", "ts", views.arrival_time().alias("arrival")
    )
    return replay_arrivals(spark, rows, "arrival", watermark)


def _judged(spark: SparkSession, d: str, watermark, column: str) -> DataFrame:
    """Every event, and whether it came behind the watermark of its micro-batch."""
    replay = _arrivals(spark, d, watermark)
    # A filter that names the watermark's column comes after it.
    rows = replay.rows.filter(replay.present(F.col(column).isNotNull()))
    out = stateful.in_order(rows, "user_id", "ts", "event_id")
    drained = _all(out, f"judged-by-{column}", replay)
    on_time = stateful.results(drained).select(F.col("tie").alias("event_id"), F.lit(False).alias("late"))
    late = stateful.late_rows(drained, "user_id")
    return on_time.unionByName(late.select(F.col("late_tie").alias("event_id"), F.lit(True).alias("late")))


def bounded(spark: SparkSession, d: str) -> DataFrame:
    """A delay of an hour where rows are up to six hours out of order."""
    return _judged(spark, d, lambda rows: rows.withWatermark("ts", "1 hour"), "ts")


def custom(spark: SparkSession, d: str) -> DataFrame:
    """A watermark that only certain rows move, here sign-ups."""

    def marked(rows: DataFrame) -> DataFrame:
        ends = F.col("event_id").isNull()
        mark = F.when(kind("signup") | ends, F.col("ts")).otherwise(F.timestamp_seconds(F.lit(0)))
        return rows.withColumn("mark", mark).withWatermark("mark", "0 seconds")

    return _judged(spark, d, marked, "mark")


def resumed(spark: SparkSession, d: str) -> DataFrame:
    """Jumps over a stream that stops after every batch and goes on as a new query."""
    replay = _arrivals(spark, d, lambda rows: rows.withWatermark("ts", "7 hours"))

    def make() -> DataFrame:
        rows = replay.rows.filter(replay.present()).withColumn(
            "id", F.concat(F.lit("sensor_"), F.col("user_id").cast("string"))
        )
        return stateful.jumps(rows, "id", "ts", "event_id", "value", 50.0, first_is_zero=False)

    out = stateful.results(drain_anew(make, "resumed", replay.finish, replay.partitions))
    return out.select("id", "ts_us", "previous", F.col("value").alias("temperature"))


def hot_items(spark: SparkSession, d: str) -> DataFrame:
    """Streaming top three: windows rank in the micro-batch that closes them.

    In append mode a window's counts all leave in one batch, so ranking within
    the batch is complete.
    """
    rows, replay = _events(spark, d, views.PAGE_VIEW)
    counts = windows.sliding_count(
        rows.select(views.item_id().alias("item_id"), "ts"),
        "ts", "1 hour", "5 minutes", ["item_id"],
    )
    path = scratch_path(spark, "hot-items")
    write = batch_folders(path)

    def rank(batch: DataFrame, batch_id: int) -> None:
        write(topn.top_n(batch, [WINDOW_END], "n", 3, ["item_id"]), batch_id)

    drain_batches(counts, "hot-items", rank, finish=replay.finish)
    return spark.read.parquet(path).drop("batch")


def two_sinks(spark: SparkSession, d: str) -> DataFrame:
    """One stream, two sinks: page views to one folder, all other events to another."""
    rows, replay = _events(spark, d)
    path = scratch_path(spark, "sinks")
    is_view = F.coalesce(kind(views.PAGE_VIEW), F.lit(False))
    sinks = {side: batch_folders(f"{path}/{side}") for side in ("views", "rest")}
    route = fan_out_routed({"views": is_view, "rest": ~is_view}, sinks)
    drain_batches(rows.select("event_id", "event_type"), "two-sinks", route, finish=replay.finish)
    parts = [
        spark.read.parquet(f"{path}/{side}").select("event_id", F.lit(side).alias("sink"))
        for side in sinks
    ]
    return parts[0].unionByName(parts[1])


def committed_documents(spark: SparkSession, d: str) -> DataFrame:
    """Page views as documents through a sink that commits each batch once."""
    rows, replay = _events(spark, d, views.PAGE_VIEW)
    docs = keyed.documents(rows, ["event_id"], ["user_id", "event_type"])
    path = scratch_path(spark, "committed")
    spark.dataSource.register(committed.CommittedSink)
    writer = docs.writeStream.format("tidemark_committed").option("path", path)
    drain_writer(writer, "committed-documents", spark, replay.finish)
    return committed.committed(spark, path, "doc_id string, document string").drop("batch")


def late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose hourly window had closed, to a side output of the stream."""
    arrived = load_table(spark, d, "events").select(
        "event_id",
        "user_id",
        "ts",
        views.arrival_time().alias("arrival"),
    )
    rows, steps = replay_in_order(spark, arrived, "arrival")
    path = scratch_path(spark, "late-rows")
    route = split_late(
        ["arrival", "event_id"],
        "ts",
        f"{path}/state",
        batch_folders(f"{path}/on_time"),
        batch_folders(f"{path}/late"),
        delay="1 hour",
        size="1 hour",
        allowed="1 hour",
    )
    drain_batches(rows, "late-rows", route, finish=steps)
    parts = [
        spark.read.parquet(f"{path}/{side}").select("event_id", F.lit(side).alias("side"))
        for side in ("on_time", "late")
    ]
    return parts[0].unionByName(parts[1])
