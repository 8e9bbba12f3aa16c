"""Tumbling and sliding event-time aggregates, for batch and stream.

Windows are aligned to the epoch, include their start, exclude their end, and
are named by their end in epoch milliseconds. Everything here is a native
grouped aggregate: partial aggregation runs before the shuffle, so neither a
hot key nor one constant key sends raw rows to a single task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import floor_to, micros, us_to_ms

WINDOW_END = "window_end"


def window_end_ms(ts: str | Column, size: str) -> Column:
    """End of the tumbling window a timestamp falls in, without grouping on it."""
    width = micros(size)
    col = F.col(ts) if isinstance(ts, str) else ts
    return us_to_ms(floor_to(F.unix_micros(col), width) + width)


def aggregate(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    aggs: Mapping[str, Column],
    *,
    slide: str | None = None,
) -> DataFrame:
    """Aggregates per window and key: keys, window_end, then the aggregates."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = df.groupBy(window.alias("_w"), *keys).agg(
        *[c.alias(n) for n, c in aggs.items()]
    )
    return grouped.select(
        *keys, F.unix_millis("_w.end").alias(WINDOW_END), *aggs
    )


def count(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str] = (),
    *,
    slide: str | None = None,
    name: str = "n",
) -> DataFrame:
    return aggregate(df, ts, size, keys, {name: F.count(F.lit(1))}, slide=slide)


# Aggregates whose partial results merge: how panes combine into windows.
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_PANE = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}


def sliding(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str],
    aggs: Mapping[str, tuple[str, str | Column]],
) -> DataFrame:
    """Sliding aggregates by way of panes; ``aggs`` maps a name to (kind, value).

    Rows are aggregated once per slide-long pane, and only the pane results are
    copied into the ``size / slide`` windows that contain them. Neither the
    row-level work nor the first shuffle grows with that ratio. On a stream the
    panes are a first windowed aggregation and the windows a second one over
    it, so a row touches one state entry instead of one per window.
    """
    length, step = micros(size), micros(slide)
    if length % step:
        raise ValueError("window size must be a multiple of the slide")
    first = [_PANE[kind](value).alias(n) for n, (kind, value) in aggs.items()]
    second = [_MERGE[kind](n).alias(n) for n, (kind, _) in aggs.items()]
    if df.isStreaming:
        panes = df.groupBy(F.window(ts, slide).alias("_p"), *keys).agg(*first)
        window = F.window(F.window_time("_p"), size, slide).alias("_w")
        merged = panes.groupBy(window, *keys).agg(*second)
        return merged.select(*keys, F.unix_millis("_w.end").alias(WINDOW_END), *aggs)
    start = floor_to(F.unix_micros(ts), step)
    panes = df.groupBy(*keys, start.alias("_pane")).agg(*first)
    ends = F.sequence(F.col("_pane") + step, F.col("_pane") + length, F.lit(step))
    return (
        panes.select(*keys, F.explode(ends).alias("_end"), *aggs)
        .groupBy(*keys, "_end")
        .agg(*second)
        .select(*keys, us_to_ms(F.col("_end")).alias(WINDOW_END), *aggs)
    )


def sliding_count(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str] = (),
    *,
    name: str = "n",
) -> DataFrame:
    return sliding(df, ts, size, slide, keys, {name: ("count", F.lit(1))})


def min_max(
    df: DataFrame, ts: str, size: str, key: str, value: str
) -> DataFrame:
    """Per key and window the least and greatest value, with the window end."""
    return aggregate(
        df,
        ts,
        size,
        [key],
        {"min_value": F.min(value), "max_value": F.max(value)},
    )


def ingest_time(df: DataFrame, name: str = "ingest_ts") -> DataFrame:
    """Stamp rows with the time they are read, for processing-time windows."""
    return df.withColumn(name, F.current_timestamp())


def min_max_row(df: DataFrame, key: str, value: str, name: str = "range") -> DataFrame:
    """Unwindowed (min, max) per key as one struct."""
    return df.groupBy(key).agg(
        F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias(name)
    )


def early_counts(
    df: DataFrame,
    ts: str,
    size: str,
    every: str,
    keys: Sequence[str],
) -> DataFrame:
    """The count so far at each ``every`` boundary of a window, up to its end.

    Firing starts at the first boundary after the window's first row. Rows are
    reduced to one count per ``every``-long pane first, so the ordered part
    sees at most ``size / every`` rows per key and window.
    """
    length, step = micros(size), micros(every)
    if length % step:
        raise ValueError("window size must be a multiple of the firing interval")
    pane = floor_to(F.unix_micros(ts), step)
    panes = df.groupBy(*keys, pane.alias("_pane")).agg(F.count(F.lit(1)).alias("_n"))
    panes = panes.withColumn("_end", floor_to(F.col("_pane"), length) + length)
    along = Window.partitionBy(*keys, "_end").orderBy("_pane")
    so_far = F.sum("_n").over(
        along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    until = F.coalesce(F.lead("_pane").over(along), F.col("_end"))
    fires = panes.select(
        *keys, "_end", (F.col("_pane") + step).alias("_first"), until.alias("_last"),
        so_far.alias("n"),
    )
    return fires.select(
        *keys,
        us_to_ms(F.col("_end")).alias(WINDOW_END),
        F.explode(F.sequence("_first", "_last", F.lit(step))).alias("_at"),
        "n",
    ).select(*keys, WINDOW_END, us_to_ms(F.col("_at")).alias("fire_at"), "n")
