"""Batch forms of the timer-driven keyed operators.

A timer fires after rows with its own timestamp have been seen, and timers
still pending at the end of the data fire.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import micros
from tidemark.operators.ordered import Neighbour, Running, hot_keys, neighbours, running, settle
from tidemark.operators.skew import DEFAULT_POLICY, HotKeys, SkewPolicy

_T, _CHAIN, _ANCHOR = "_t", "_chain", "_anchor"


def timers(df: DataFrame, key: str, ts: str, after: str) -> DataFrame:
    """One callback per distinct (key, time), ``after`` later."""
    fires = F.timestamp_micros(F.unix_micros(ts) + micros(after))
    return df.groupBy(key, fires.alias("fires_at")).agg(F.count(F.lit(1)).alias("n"))


def _group_starts(columns: list[pa.Array]) -> list[int]:
    """Rows whose values differ from those of the row before; nulls are equal."""
    fresh = np.zeros(len(columns[0]), dtype=bool)
    fresh[0] = True
    for c in columns:
        now, before = c.slice(1), c.slice(0, len(c) - 1)
        differs = pc.fill_null(pc.not_equal(now, before), False)
        differs = pc.or_(differs, pc.xor(now.is_null(), before.is_null()))
        fresh[1:] |= differs.to_numpy(zero_copy_only=False)
    return np.flatnonzero(fresh).tolist()


def _anchor_rows(df: DataFrame, group: list[str], length: int) -> DataFrame:
    """Assign rows to windows of ``length`` opened by the first row not covered.

    Where a window opens depends on the one before it, which no window
    expression can say. Rows arrive sorted and are folded batch by batch, so a
    group is never held in memory.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(_ANCHOR, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_group, anchor = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            t = batch.column(_T).to_numpy()
            columns = [batch.column(g) for g in group]
            starts = _group_starts(columns)
            anchors = np.empty(len(t), dtype="int64")
            for start, end in zip(starts, starts[1:] + [len(t)]):
                at = start
                if start == 0 and [c[0].as_py() for c in columns] == last_group:
                    at += int(np.searchsorted(t[start:end], anchor + length, "right"))
                    anchors[start:at] = anchor
                while at < end:
                    anchor = int(t[at])
                    upto = at + int(np.searchsorted(t[at:end], anchor + length, "right"))
                    anchors[at:upto] = anchor
                    at = upto
            last_group = [c[len(t) - 1].as_py() for c in columns]
            yield batch.append_column(_ANCHOR, pa.array(anchors))

    return (
        df.repartition(*group)
        .sortWithinPartitions(*group, _T)
        .mapInArrow(run, schema)
    )


def armed_alerts(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    arms: Column,
    resets: Column,
    hold: str,
    *,
    at_least: int = 1,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Alert ``hold`` after an arming row, unless a reset comes by then.

    While armed, further arming rows only count; an alert needs ``at_least``
    of them. After firing or a reset the next arming row arms again.
    Output: key, opened_at, fires_at, n.
    """
    length = micros(hold)
    ts = order[0]
    place = F.struct(*order)
    hot = hot_keys(df, [key], order, hot, policy)
    rows = df.select(
        key,
        *order,
        F.unix_micros(ts).alias(_T),
        F.coalesce(arms, F.lit(False)).alias("_arms"),
        F.coalesce(resets, F.lit(False)).alias("_resets"),
    )
    back = running(
        rows,
        [key],
        order,
        [
            Running("_reset_before", "max", F.when(F.col("_resets"), place)),
            Running("_arm", "max", F.when(F.col("_arms"), place), previous="_arm_before"),
        ],
        hot=hot,
        policy=policy,
    )
    both = running(
        settle(back, hot),
        [key],
        order,
        [Running("_reset_after", "min", F.when(F.col("_resets"), F.col(_T)))],
        descending=True,
        hot=hot,
        policy=policy,
    )
    gap = F.col(_T) - F.unix_micros(F.col(f"_arm_before.{ts}"))
    fresh = (
        F.col("_arm_before").isNull()
        | (gap > length)
        | F.coalesce(F.col("_reset_before") > F.col("_arm_before"), F.lit(False))
    )
    # between rows further apart than ``hold`` no window can reach across, so
    # the fold below runs over short chains instead of whole keys
    chains = running(
        settle(both.filter("_arms"), hot),
        [key],
        order,
        [Running(_CHAIN, "count", F.when(fresh, 1))],
        hot=hot,
        policy=policy,
    ).select(key, _CHAIN, _T, "_reset_after")
    windows = (
        _anchor_rows(chains, [key, _CHAIN], length)
        .groupBy(key, _CHAIN, _ANCHOR)
        .agg(F.count(F.lit(1)).alias("n"), F.min("_reset_after").alias("_reset_after"))
    )
    fires = F.col(_ANCHOR) + length
    undisturbed = F.col("_reset_after").isNull() | (F.col("_reset_after") > fires)
    return windows.filter((F.col("n") >= at_least) & undisturbed).select(
        key,
        F.timestamp_micros(_ANCHOR).alias("opened_at"),
        F.timestamp_micros(fires).alias("fires_at"),
        "n",
    )


def rising_runs(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    hold: str,
    *,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Alert when a value rose and then did not drop for ``hold``.

    An equal value changes nothing. A previous value of 0.0 counts as none.
    """
    hot = hot_keys(df, [key], order, hot, policy)
    rows = neighbours(
        df.select(key, *order, value),
        [key],
        order,
        [Neighbour("_prev", value, -1)],
        hot=hot,
        policy=policy,
    )
    rows = settle(rows, hot)
    fresh = F.coalesce(F.col("_prev") == 0.0, F.lit(True))
    drops = fresh | (F.col(value) < F.col("_prev"))
    rises = ~fresh & (F.col(value) > F.col("_prev"))
    return armed_alerts(rows, key, order, rises, drops, hold, hot=hot, policy=policy)


def repeated_failures(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    failed: Column,
    succeeded: Column,
    hold: str,
    *,
    at_least: int = 3,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Alert ``hold`` after a first failure if enough failures came by then.

    A success clears the count. A quiet timer resets the counter too, so the
    next failure starts a new one.
    """
    return armed_alerts(
        df, key, order, failed, succeeded, hold, at_least=at_least, hot=hot, policy=policy
    )


def order_timeouts(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    created: Column,
    wait: str,
    *,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Creates that nothing of their order followed in time, slot semantics.

    Every event sets a timer at its time + ``wait``. One slot per order keeps
    the first create until any other event overwrites it; a timer reports a
    create still in the slot and empties it. The timers are known up front, so
    the slot's content at a timer depends only on the events since the timer
    before it: group events by their next timer.
    """
    length = micros(wait)
    ts = order[0]
    at = F.unix_micros(ts)
    record = F.struct(*order, *[c for c in df.columns if c not in (key, *order)])
    ties = list(order[1:])
    probes = df.select(
        key,
        *ties,
        (at - length).alias("_at"),
        F.lit(0).alias("_is_timer"),
        F.coalesce(created, F.lit(False)).alias("_create"),
        record.alias("_event"),
    )
    marks = df.select(key, *ties, at.alias("_at"), F.lit(1).alias("_is_timer"))
    # the earliest event at or after (event time - wait) owns the next timer
    placed = running(
        probes.unionByName(marks, allowMissingColumns=True),
        [key],
        ["_at", "_is_timer", *ties],
        [Running("_owner", "min", F.when(F.col("_is_timer") == 1, F.col("_at")))],
        descending=True,
        hot=hot,
        policy=policy,
    )
    slots = (
        placed.filter("_is_timer = 0")
        .groupBy(key, (F.col("_owner") + length).alias("_timer"))
        .agg(
            F.bool_and("_create").alias("_only_creates"),
            F.min("_event").alias("_event"),
        )
    )
    return slots.filter("_only_creates").select(
        key, F.timestamp_micros("_timer").alias("fires_at"), "_event.*"
    )
