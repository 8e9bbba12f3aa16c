"""The analytics inputs as views over the events table.

Every view is a projection (plus at most a filter), so scans read only the
columns a query uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import load_table

# How event types stand for the roles in the analytics.
PAGE_VIEW = "view"
LOGIN_FAIL = "error"
LOGIN_SUCCESS = "signup"
ORDER_CREATE = "signup"
ORDER_PAY = "purchase"
UNINSTALL = "error"
CHANNELS = ("channel_even", "channel_odd")
ARRIVAL_PRIME, ARRIVAL_SPREAD, ARRIVAL_STEP_MINUTES = 7919, 97, 4


def events(spark: SparkSession, directory: str) -> DataFrame:
    return load_table(spark, directory, "events")


def item_id():
    """The first number in ``props``; null where there is none or it is too long."""
    return F.regexp_extract("props", r"(\d+)", 1).try_cast("long")


def behavior(spark: SparkSession, directory: str) -> DataFrame:
    """event_id, user_id, item_id, behavior, ts."""
    return events(spark, directory).select(
        "event_id",
        "user_id",
        item_id().alias("item_id"),
        F.col("event_type").alias("behavior"),
        "ts",
    )


def page_views(spark: SparkSession, directory: str) -> DataFrame:
    return behavior(spark, directory).filter(F.col("behavior") == PAGE_VIEW)


def sensor(spark: SparkSession, directory: str) -> DataFrame:
    """event_id, id, temperature, ts."""
    return events(spark, directory).select(
        "event_id",
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        F.col("value").alias("temperature"),
        "ts",
    )


def marketing(spark: SparkSession, directory: str) -> DataFrame:
    """user_id, channel, behavior, ts."""
    even, odd = CHANNELS
    return events(spark, directory).select(
        "user_id",
        F.when(item_id() % 2 == 0, even).otherwise(odd).alias("channel"),
        F.col("event_type").alias("behavior"),
        "ts",
    )


def logins(spark: SparkSession, directory: str) -> DataFrame:
    """event_id, user_id, ip, event_type, ts; other event types break contiguity."""
    kind = (
        F.when(F.col("event_type") == LOGIN_FAIL, "fail")
        .when(F.col("event_type") == LOGIN_SUCCESS, "success")
        .otherwise(F.col("event_type"))
    )
    return events(spark, directory).select(
        "event_id",
        "user_id",
        F.concat(F.lit("10.0.0."), item_id().cast("string")).alias("ip"),
        kind.alias("event_type"),
        "ts",
    )


def orders(spark: SparkSession, directory: str) -> DataFrame:
    """event_id, order_id, event_type (create or pay), ts."""
    kind = F.when(F.col("event_type") == ORDER_CREATE, "create").otherwise("pay")
    return (
        events(spark, directory)
        .filter(F.col("event_type").isin(ORDER_CREATE, ORDER_PAY))
        .select(
            "event_id",
            F.col("user_id").alias("order_id"),
            kind.alias("event_type"),
            "ts",
        )
    )


def access_lines(spark: SparkSession, directory: str) -> DataFrame:
    """The events as access-log text lines in a column ``value``."""
    return events(spark, directory).select(
        F.format_string(
            "10.0.0.%s - %s %s +0000 GET /item/%s",
            item_id(),
            F.col("user_id"),
            F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
            item_id(),
        ).alias("value")
    )


def arrival_time():
    """Event time plus a jitter that depends on the event only."""
    jitter = (F.col("event_id") * ARRIVAL_PRIME % ARRIVAL_SPREAD) * (
        ARRIVAL_STEP_MINUTES * 60_000_000
    )
    return F.timestamp_micros(F.unix_micros("ts") + jitter)


def arrivals(spark: SparkSession, directory: str) -> DataFrame:
    """event_id, user_id, ts, arrival: rows that come late and out of order."""
    return events(spark, directory).select(
        "event_id", "user_id", "ts", arrival_time().alias("arrival")
    )
