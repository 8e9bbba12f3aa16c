"""Late rows: exact, repeatable classification of a recorded arrival order.

A row sees the watermark left by the rows that arrived before it: the greatest
event time so far minus the delay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import micros
from tidemark.operators.ordered import Neighbour, Running, neighbours, running, settle
from tidemark.operators.skew import DEFAULT_POLICY, SkewPolicy, find_hot
from tidemark.operators.windows import WINDOW_END, window_end_ms

ON_TIME, UPDATE, DROPPED = "on_time", "update", "dropped"


def with_watermark_before(
    df: DataFrame,
    arrival: Sequence[str],
    ts: str,
    delay: str,
    *,
    seen_us: int | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add ``watermark_us``, the watermark at a row's arrival; null for the first.

    The running maximum spans the whole table. Large tables are cut into
    slices of arrival time, each starting from the maximum before it.
    ``seen_us`` is the greatest event time of earlier inputs, if there were any.
    """
    out = running(
        df,
        [],
        arrival,
        [Running("_max", "max", F.unix_micros(ts), previous="_max_before")],
        policy=policy,
    )
    seen = F.greatest(F.col("_max_before"), F.lit(seen_us).cast("long"))
    return out.withColumn("watermark_us", seen - micros(delay)).drop(
        "_max", "_max_before"
    )


def classify_lateness(
    df: DataFrame,
    arrival: Sequence[str],
    ts: str,
    size: str,
    *,
    delay: str = "0 seconds",
    allowed: str = "0 seconds",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add ``window_end`` and ``lateness``: on_time, update or dropped.

    A row is late once its window has closed; it still updates the window for
    ``allowed`` longer.
    """
    out = with_watermark_before(df, arrival, ts, delay, policy=policy).withColumn(
        WINDOW_END, window_end_ms(ts, size)
    )
    end = F.col(WINDOW_END) * 1000
    wm = F.col("watermark_us")
    lateness = (
        F.when(wm.isNull() | (end > wm), ON_TIME)
        .when(wm < end + micros(allowed), UPDATE)
        .otherwise(DROPPED)
    )
    return out.withColumn("lateness", lateness).drop("watermark_us")


def behind_watermark(
    df: DataFrame,
    arrival: Sequence[str],
    ts: str,
    *,
    delay: str = "0 seconds",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add ``is_late``: the row itself is older than the watermark it met."""
    out = with_watermark_before(df, arrival, ts, delay, policy=policy)
    late = F.coalesce(F.unix_micros(ts) < F.col("watermark_us"), F.lit(False))
    return out.withColumn("is_late", late).drop("watermark_us")


def allowed_lateness_results(
    df: DataFrame,
    key: str,
    arrival: Sequence[str],
    ts: str,
    size: str,
    *,
    delay: str,
    allowed: str,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """All results of windowed counts that accept late rows for a while.

    A ``first`` result when the window closes, then one ``update`` with the new
    count for each late row. A window whose first row is itself late has that
    row's result as its first. Output: key, window_end, kind, n.
    """
    group = [key, WINDOW_END]
    placed = df.withColumn(WINDOW_END, window_end_ms(ts, size))
    hot = find_hot(placed, group, arrival[0], policy)
    rows = classify_lateness(
        df, arrival, ts, size, delay=delay, allowed=allowed, policy=policy
    ).filter(F.col("lateness") != DROPPED)
    rows = rows.select(*group, *arrival, "lateness")
    counted = running(
        settle(rows, hot), group, arrival, [Running("n", "count", F.lit(1))], hot=hot, policy=policy
    )
    # on-time rows all come before late ones: the last of them has the count
    # that the window closed with
    counted = neighbours(
        settle(counted, hot), group, arrival, [Neighbour("_next", "lateness", 1)], hot=hot, policy=policy
    )
    is_update = F.col("lateness") == UPDATE
    closes = ~is_update & F.coalesce(F.col("_next") == UPDATE, F.lit(True))
    kind = F.when(is_update & (F.col("n") > 1), "update").otherwise("first")
    return counted.filter(is_update | closes).select(*group, kind.alias("kind"), "n")
