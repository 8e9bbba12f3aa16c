"""Unique visitors per window: exact, two-stage, bitmap, approximate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import bit_offset
from tidemark.functions.times import floor_to, micros, us_to_ms
from tidemark.operators.ordered import Running, running, settle
from tidemark.operators.skew import DEFAULT_POLICY, SkewPolicy, find_hot
from tidemark.operators.windows import WINDOW_END, aggregate, window_end_ms


def exact(df: DataFrame, ts: str, size: str, visitor: str, name: str = "uv") -> DataFrame:
    """Distinct visitors per window (batch).

    Spark deduplicates (window, visitor) on a shuffle by both, so a window that
    holds most of the table is spread over all tasks.
    """
    return aggregate(df, ts, size, [], {name: F.count_distinct(visitor)})


def two_stage(
    df: DataFrame, ts: str, size: str, visitor: str, name: str = "uv"
) -> DataFrame:
    """One row per (window, visitor), then a count per window; batch or stream.

    A null is no visitor, but its window is listed.
    """
    seen = df.groupBy(F.window(ts, size).alias("_w"), visitor).agg(
        F.count(F.lit(1)).alias("_n")
    )
    if df.isStreaming:
        seen = seen.groupBy(F.window("_w", size).alias("_w2"))
    else:
        seen = seen.groupBy(F.col("_w").alias("_w2"))
    return seen.agg(F.count(visitor).alias(name)).select(
        F.unix_millis("_w2.end").alias(WINDOW_END), name
    )


def bitmap(
    df: DataFrame,
    ts: str,
    size: str,
    visitor: str,
    *,
    slide: str | None = None,
    name: str = "uv",
) -> DataFrame:
    """Distinct bits of a 2^29-bit map per window: collisions count once.

    Visitors are deduplicated per slide-long pane before they are hashed. A window counts
    a bit in the last of its panes that has it: a pane opens the windows that end before
    the bit's next occurrence could be in them. So the copies need no distinct, and their
    count is summed before the shuffle.
    """
    length = micros(size)
    step = micros(slide) if slide else length
    if length % step:
        raise ValueError("window size must be a multiple of the slide")
    pane = floor_to(F.unix_micros(ts), step)
    panes = df.groupBy(pane.alias("_pane"), visitor).agg(F.count(F.lit(1)).alias("_n"))
    bits = panes.select("_pane", bit_offset(F.col(visitor).cast("string")).alias("_bit"))
    following = F.lead("_pane").over(Window.partitionBy("_bit").orderBy("_pane"))
    last = F.least(F.col("_pane") + length, following)
    own = bits.select("_pane", "_bit", last.alias("_last")).filter("_last > _pane")
    ends = F.sequence(F.col("_pane") + step, F.col("_last"), F.lit(step))
    return own.select(F.explode(ends).alias("_end"), "_bit").groupBy("_end").agg(
        F.count("_bit").alias(name)
    ).select(us_to_ms(F.col("_end")).alias(WINDOW_END), name)


def sketched(
    df: DataFrame,
    ts: str,
    size: str,
    visitor: str,
    *,
    slide: str,
    bits: int = 12,
    name: str = "uv",
) -> DataFrame:
    """Distinct visitors of sliding windows by sketches of 2^``bits`` registers.

    A row goes into the sketch of its slide-long pane, and a window unites its panes'
    sketches: what is copied is a sketch per pane, whatever a pane holds. Counts are off
    by ``1.04 / sqrt(2 ** bits)`` in standard deviation. A null is no visitor.
    """
    length, step = micros(size), micros(slide)
    if length % step:
        raise ValueError("window size must be a multiple of the slide")
    pane = floor_to(F.unix_micros(ts), step)
    known = F.col(visitor).cast("string")
    panes = df.groupBy(pane.alias("_pane")).agg(F.hll_sketch_agg(known, F.lit(bits)).alias("_sketch"))
    ends = F.sequence(F.col("_pane") + step, F.col("_pane") + length, F.lit(step))
    windows = panes.select(F.explode(ends).alias("_end"), "_sketch")
    united = windows.groupBy("_end").agg(F.hll_union_agg("_sketch").alias("_all"))
    return united.select(
        us_to_ms(F.col("_end")).alias(WINDOW_END), F.hll_sketch_estimate("_all").alias(name)
    )


def approximate(
    df: DataFrame,
    ts: str,
    size: str,
    visitor: str,
    *,
    slide: str | None = None,
    error: float = 0.01,
    name: str = "uv",
) -> DataFrame:
    """Bounded-memory distinct count by sketch; batch or stream."""
    return aggregate(
        df,
        ts,
        size,
        [],
        {name: F.approx_count_distinct(visitor, error)},
        slide=slide,
    )


def running_bitmap(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    size: str,
    visitor: str,
    *,
    keep: Sequence[str] = (),
    name: str = "uv",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """The bitmap count of a window after each of its rows."""
    rows = df.select(
        *dict.fromkeys([*keep, *order]),
        window_end_ms(ts, size).alias(WINDOW_END),
        bit_offset(F.col(visitor).cast("string")).alias("_bit"),
    )
    hot = find_hot(rows, [WINDOW_END], order[0], policy)
    seen = running(
        rows,
        [WINDOW_END, "_bit"],
        order,
        [Running("_times", "count", F.lit(1))],
        policy=policy,
    )
    fresh: Column = F.when(F.col("_times") == 1, 1).otherwise(0).cast("long")
    counted = running(
        settle(seen, hot), [WINDOW_END], order, [Running(name, "sum", fresh)], hot=hot
    )
    return counted.select(*keep, WINDOW_END, name)
