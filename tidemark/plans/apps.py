"""The analytics applications, end to end over the given tables.

Each takes a session and a table folder. Times leave as epoch milliseconds
(or microseconds, ``*_us``), so results do not depend on a session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import words
from tidemark.operators import (
    alerts,
    distinct,
    joins,
    patterns,
    ranklog,
    rolling,
    topn,
    transforms,
    windows,
)
from tidemark.sinks import keyed
from tidemark.sources import files, kafka, views
from tidemark.sources.tables import as_table, load_table

WINDOW_END = windows.WINDOW_END
BY_TIME = ["ts", "event_id"]


def us(column: str = "ts"):
    return F.unix_micros(column)


# -- popularity ---------------------------------------------------------------


def hot_items(spark: SparkSession, d: str, n: int = 3) -> DataFrame:
    """Most viewed items of the last hour, every five minutes."""
    counts = windows.sliding_count(
        views.page_views(spark, d), "ts", "1 hour", "5 minutes", ["item_id"]
    )
    return topn.top_n(counts, [WINDOW_END], "n", n, ["item_id"])


def hot_items_report(spark: SparkSession, d: str) -> DataFrame:
    line = topn.count_line("rank", "item", "item_id", "n")
    return topn.report(hot_items(spark, d), line)


def hot_items_sql(spark: SparkSession, d: str) -> DataFrame:
    """The same ranking, all in SQL over a registered view."""
    table = as_table(
        views.behavior(spark, d),
        {"item_id": "item_id", "behavior": "behavior", "ts": "ts"},
        event_time="ts",
    )
    # Rows are counted per slide first; only those counts are copied into windows.
    return spark.sql(
        """
        SELECT window_end, item_id, n, rank FROM (
          SELECT *, row_number() OVER
                      (PARTITION BY window_end ORDER BY n DESC, item_id NULLS LAST) AS rank
          FROM (
            SELECT window_end, item_id, sum(pane_n) AS n
            FROM (SELECT item_id, pane_n, explode(sequence(pane_end, pane_end + 3300000, 300000))
                           AS window_end
                  FROM (SELECT unix_millis(w.end) AS pane_end, item_id, count(*) AS pane_n
                        FROM (SELECT item_id, window(ts, '5 minutes') AS w
                              FROM {behavior} WHERE behavior = 'view')
                        GROUP BY w, item_id))
            GROUP BY window_end, item_id))
        WHERE rank <= 3
        """,
        behavior=table,
    )


def hot_items_changes(spark: SparkSession, d: str) -> DataFrame:
    """The same ranking as rows that add and take back its places, view by view."""
    out = ranklog.ranked_changelog(
        views.page_views(spark, d), "ts", BY_TIME, "item_id", "1 hour", 3, slide="5 minutes"
    )
    return out.select("window_end", "event_id", "is_add", "item_id", "n", "rank")


def hot_items_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Hourly counts through the DataFrame API, ranked in SQL."""
    counts = windows.count(
        views.page_views(spark, d), "ts", "1 hour", ["item_id"], name="icount"
    )
    return spark.sql(
        """
        SELECT window_end, item_id, icount, rank FROM (
          SELECT *, row_number() OVER
                      (PARTITION BY window_end ORDER BY icount DESC, item_id NULLS LAST) AS rank
          FROM {counts})
        WHERE rank <= 3
        """,
        counts=counts,
    )


def behavior_messages(spark: SparkSession, d: str) -> DataFrame:
    """The behaviour records as Kafka source rows with CSV text values."""
    b = views.behavior(spark, d)
    text = F.concat_ws(
        ",",
        F.col("user_id").cast("string"),
        F.col("item_id").cast("string"),
        F.lit("0"),
        F.when(F.col("behavior") == views.PAGE_VIEW, "pv").otherwise(F.col("behavior")),
        F.unix_seconds("ts").cast("string"),
    )
    return b.select(
        F.lit(None).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit("behavior").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def hot_item_documents(spark: SparkSession, d: str) -> DataFrame:
    """Messages in, one search document per window out: the top item."""
    messages = files.parse_behavior(kafka.decode(behavior_messages(spark, d)))
    parsed = files.accepted(messages, files.BEHAVIOR_REQUIRED)
    counts = windows.sliding_count(
        parsed.filter(F.col("behavior") == "pv"),
        "ts",
        "1 hour",
        "5 minutes",
        ["item_id"],
    )
    top = topn.top_n(counts, [WINDOW_END], "n", 1, ["item_id"])
    return keyed.documents(top, [WINDOW_END], [WINDOW_END, "item_id", "n"])


def hot_urls(spark: SparkSession, d: str) -> DataFrame:
    """Most requested URL, from access-log lines."""
    log = files.accepted(files.parse_access_log(views.access_lines(spark, d)))
    counts = windows.sliding_count(log, "ts", "1 hour", "5 minutes", ["url"])
    return topn.top_n(counts, [WINDOW_END], "n", 1, ["url"])


# -- traffic ------------------------------------------------------------------


def page_views_hourly(spark: SparkSession, d: str) -> DataFrame:
    return windows.count(views.page_views(spark, d), "ts", "1 hour", name="pv")


def visitors_exact(spark: SparkSession, d: str) -> DataFrame:
    return distinct.exact(views.page_views(spark, d), "ts", "1 hour", "user_id")


def visitors_two_stage(spark: SparkSession, d: str) -> DataFrame:
    return distinct.two_stage(views.page_views(spark, d), "ts", "1 hour", "user_id")


def visitors_bitmap(spark: SparkSession, d: str) -> DataFrame:
    return distinct.bitmap(views.page_views(spark, d), "ts", "1 hour", "user_id")


def visitors_bitmap_sliding(spark: SparkSession, d: str) -> DataFrame:
    return distinct.bitmap(
        views.page_views(spark, d), "ts", "1 hour", "user_id", slide="5 minutes"
    )


def visitors_running(spark: SparkSession, d: str) -> DataFrame:
    """The bitmap count after every page view of a window."""
    return distinct.running_bitmap(
        views.page_views(spark, d),
        "ts",
        BY_TIME,
        "1 hour",
        "user_id",
        keep=["event_id"],
    )


def marketing_by_channel(spark: SparkSession, d: str) -> DataFrame:
    kept = views.marketing(spark, d).filter(
        transforms.not_equal("behavior", views.UNINSTALL)
    )
    return windows.sliding_count(kept, "ts", "6 hours", "1 hour", ["channel", "behavior"])


def marketing_total(spark: SparkSession, d: str) -> DataFrame:
    kept = views.marketing(spark, d).filter(
        transforms.not_equal("behavior", views.UNINSTALL)
    )
    return windows.sliding_count(kept, "ts", "6 hours", "1 hour")


# -- logins and orders --------------------------------------------------------


def login_failures_pattern(spark: SparkSession, d: str) -> DataFrame:
    """Three failures in direct succession within two days."""
    fail = F.col("event_type") == "fail"
    found = patterns.match_sequence(
        views.logins(spark, d),
        "user_id",
        BY_TIME,
        [("first", fail), ("second", fail), ("third", fail)],
        within="2 days",
    )
    return found.select(
        "user_id",
        *[F.col(f"{s}.ip").alias(f"{s}_ip") for s in ("first", "second", "third")],
        *[us(f"{s}.ts").alias(f"{s}_us") for s in ("first", "second", "third")],
    )


def login_failures_state(spark: SparkSession, d: str) -> DataFrame:
    """More than two failures within two days of the first, no success between."""
    found = alerts.repeated_failures(
        views.logins(spark, d),
        "user_id",
        BY_TIME,
        F.col("event_type") == "fail",
        F.col("event_type") == "success",
        "2 days",
    )
    return found.select("user_id", us("opened_at").alias("opened_us"), "n")


def _order_attempts(spark: SparkSession, d: str) -> DataFrame:
    return patterns.match_sequence(
        views.orders(spark, d),
        "order_id",
        BY_TIME,
        [
            ("create", F.col("event_type") == "create"),
            ("pay", F.col("event_type") == "pay"),
        ],
        within="1 day",
        on_timeout=True,
    )


def orders_paid(spark: SparkSession, d: str) -> DataFrame:
    return (
        _order_attempts(spark, d)
        .filter("outcome = 'matched'")
        .select("order_id", us("create.ts").alias("create_us"), us("pay.ts").alias("pay_us"))
    )


def orders_timed_out(spark: SparkSession, d: str) -> DataFrame:
    return (
        _order_attempts(spark, d)
        .filter("outcome = 'timeout'")
        .select("order_id", us("create.ts").alias("create_us"))
    )


def orders_timed_out_state(spark: SparkSession, d: str) -> DataFrame:
    found = alerts.order_timeouts(
        views.orders(spark, d),
        "order_id",
        BY_TIME,
        F.col("event_type") == "create",
        "1 day",
    )
    return found.select(
        "order_id", us("ts").alias("create_us"), us("fires_at").alias("fires_us")
    )


def orders_without_payment(spark: SparkSession, d: str) -> DataFrame:
    rows = views.orders(spark, d)
    found = joins.without_partner(
        rows.filter("event_type = 'create'"),
        rows.filter("event_type = 'pay'"),
        "order_id",
        "ts",
        "1 day",
    )
    return found.select("order_id", us().alias("create_us"))


def reconciliation(spark: SparkSession, d: str) -> DataFrame:
    rows = views.orders(spark, d)
    return joins.reconcile(
        rows.filter("event_type = 'create'"),
        rows.filter("event_type = 'pay'"),
        "order_id",
        BY_TIME,
        wait="1 day",
    )


def reconciled(spark: SparkSession, d: str) -> DataFrame:
    return (
        reconciliation(spark, d)
        .filter("side = 'matched'")
        .select(
            "order_id",
            F.col("first.event_id").alias("first_event"),
            F.col("second.event_id").alias("second_event"),
        )
    )


def unreconciled(spark: SparkSession, d: str) -> DataFrame:
    return (
        reconciliation(spark, d)
        .filter("side <> 'matched'")
        .select("order_id", "side", "superseded", F.col("first.event_id").alias("event_id"))
    )


# -- sensors ------------------------------------------------------------------


def sensor_min(spark: SparkSession, d: str) -> DataFrame:
    return windows.aggregate(
        views.sensor(spark, d), "ts", "1 day", ["id"], {"lowest": F.min("temperature")}
    )


def sensor_min_max(spark: SparkSession, d: str) -> DataFrame:
    return windows.min_max(views.sensor(spark, d), "ts", "1 day", "id", "temperature")


def sensor_average(spark: SparkSession, d: str) -> DataFrame:
    return windows.aggregate(
        views.sensor(spark, d),
        "ts",
        "1 day",
        ["id"],
        {"average": F.round(F.avg("temperature"), 6)},
    )


def sensor_count(spark: SparkSession, d: str) -> DataFrame:
    return windows.count(views.sensor(spark, d), "ts", "1 day", ["id"])


def sensor_count_sql(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(
        """
        SELECT id, unix_millis(w.end) AS window_end, count(*) AS n
        FROM (SELECT id, window(ts, '1 day') AS w FROM {sensor})
        GROUP BY id, w
        """,
        sensor=views.sensor(spark, d),
    )


def temperature_jumps(spark: SparkSession, d: str, first_is_zero: bool) -> DataFrame:
    found = rolling.jumps(
        views.sensor(spark, d),
        ["id"],
        BY_TIME,
        "temperature",
        50.0,
        first_is_zero=first_is_zero,
    )
    return found.select("id", us().alias("ts_us"), "previous", "temperature")


def rising_temperatures(spark: SparkSession, d: str) -> DataFrame:
    found = alerts.rising_runs(
        views.sensor(spark, d), "id", BY_TIME, "temperature", "6 hours"
    )
    return found.select("id", us("opened_at").alias("opened_us"), "n")


def freezing(spark: SparkSession, d: str) -> DataFrame:
    """Alarm messages for readings below 32.0; the main output is unchanged."""
    _, alarms = transforms.with_side_output(
        views.sensor(spark, d),
        F.col("temperature") < 32.0,
        {
            "event_id": F.col("event_id"),
            "message": F.concat(F.lit("freezing alarm: "), F.col("id")),
        },
    )
    return alarms


def gated_readings(spark: SparkSession, d: str) -> DataFrame:
    """Readings in the six hours after a switch event of their sensor."""
    rows = views.events(spark, d)
    readings = rows.filter("event_type <> 'signup'").select(
        "event_id", "user_id", "value", "ts"
    )
    switches = rows.filter("event_type = 'signup'").select(
        "user_id", "ts", F.lit(6 * 3_600_000_000).alias("duration_us")
    )
    return joins.gate(readings, switches, "user_id", "ts", "duration_us").select(
        "event_id", "user_id", "value"
    )


# -- words --------------------------------------------------------------------


def word_count(spark: SparkSession, d: str) -> DataFrame:
    text = load_table(spark, d, "documents").select("text")
    return words(text, "text").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_windowed(spark: SparkSession, d: str) -> DataFrame:
    text = views.events(spark, d).select("ts", "props")
    return windows.count(words(text, "props"), "ts", "1 day", ["word"])
