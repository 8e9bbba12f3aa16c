"""Two-input operators on a shared key, without pairwise joins.

Each is one tagged union of both inputs and a running value along the key, so
the work is linear in the rows: a key with many rows on both sides never
produces the pairs between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import micros
from tidemark.operators.ordered import Neighbour, Running, hot_keys, neighbours, running, settle
from tidemark.operators.skew import DEFAULT_POLICY, HotKeys, SkewPolicy

_SIDE = "_side"


def gate(
    readings: DataFrame,
    switches: DataFrame,
    key: str,
    ts: str,
    duration_us: str,
    *,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Readings inside ``[switch, switch + duration)`` of any switch of their key."""
    closes = F.unix_micros(ts) + F.col(duration_us)
    both = readings.withColumns(
        {_SIDE: F.lit(1), "_closes": F.lit(None).cast("long")}
    ).unionByName(
        switches.select(key, ts, F.lit(0).alias(_SIDE), closes.alias("_closes")),
        allowMissingColumns=True,
    )
    # a switch opens the gate for readings at its own instant: it sorts first
    out = running(
        both,
        [key],
        [ts, _SIDE],
        [Running("_open_until", "max", F.col("_closes"))],
        hot=hot,
        policy=policy,
    )
    inside = (F.col(_SIDE) == 1) & (F.unix_micros(ts) < F.col("_open_until"))
    return out.filter(inside).select(*readings.columns)


def without_partner(
    rows: DataFrame,
    others: DataFrame,
    key: str,
    ts: str,
    bound: str,
    *,
    keep_matched: bool = False,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Rows with no row of ``others`` of the same key within ``bound`` either way.

    ``keep_matched`` returns the rows that have one instead. Only the nearest
    other row on each side decides, found by one pass in each direction.
    """
    both = rows.withColumns(
        {_SIDE: F.lit(1), "_other": F.lit(None).cast("long")}
    ).unionByName(
        others.select(
            key, ts, F.lit(0).alias(_SIDE), F.unix_micros(ts).alias("_other")
        ),
        allowMissingColumns=True,
    )
    hot = hot_keys(both, [key], [ts], hot, policy)
    back = running(
        both, [key], [ts, _SIDE], [Running("_before", "max", F.col("_other"))],
        hot=hot, policy=policy,
    )
    ahead = running(
        settle(back, hot), [key], [ts, _SIDE], [Running("_after", "min", F.col("_other"))],
        descending=True, hot=hot, policy=policy,
    )
    limit = micros(bound)
    now = F.unix_micros(ts)
    near = F.coalesce(now - F.col("_before") <= limit, F.lit(False)) | F.coalesce(
        F.col("_after") - now <= limit, F.lit(False)
    )
    wanted = near if keep_matched else ~near
    return ahead.filter((F.col(_SIDE) == 1) & wanted).select(*rows.columns)


def reconcile(
    orders: DataFrame,
    pays: DataFrame,
    key: str,
    order_by: list[str],
    *,
    ts: str = "ts",
    wait: str | None = None,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Match the events of two inputs one to one, in order, per key.

    Either side may come first. One event per key waits at a time: an event of
    the other side takes it, a newer event of its own side supersedes it, and
    with ``wait`` it expires that long after its own time. Both inputs have the
    same columns.

    Output: ``side`` (matched, order, pay), ``superseded``, ``first`` (the
    waiting event) and ``second`` (its match, or null). Every input row is in
    exactly one output row.

    The waiting event can be read off the order alone: within a stretch where
    the sides alternate, events pair up from its start, so an event waits iff
    it is of the side the stretch began with.
    """
    columns = orders.columns
    both = orders.withColumn(_SIDE, F.lit("order")).unionByName(
        pays.select(*columns).withColumn(_SIDE, F.lit("pay"))
    )
    sort = [*order_by, _SIDE]
    hot = hot_keys(both, [key], sort, hot, policy)
    near = neighbours(
        both,
        [key],
        sort,
        [
            Neighbour("_prev_side", _SIDE, -1),
            Neighbour("_prev_ts", ts, -1),
            Neighbour("_next_side", _SIDE, 1),
            # column by column: those a query does not use are pruned
            *[Neighbour(f"_next_{c}", c, 1) for c in columns],
        ],
        hot=hot,
        policy=policy,
    )

    def in_time(earlier: Column, later: Column) -> Column:
        if wait is None:
            return F.lit(True)
        return F.unix_micros(later) - F.unix_micros(earlier) <= micros(wait)

    linked = F.coalesce(
        (F.col("_prev_side") != F.col(_SIDE)) & in_time(F.col("_prev_ts"), F.col(ts)),
        F.lit(False),
    )
    runs = running(
        settle(near, hot),
        [key],
        sort,
        [Running("_start_side", "last", F.when(~linked, F.col(_SIDE)))],
        hot=hot,
        policy=policy,
    )
    next_in_time = in_time(F.col(ts), F.col(f"_next_{ts}"))
    taken = F.coalesce(
        (F.col("_next_side") != F.col(_SIDE)) & next_in_time, F.lit(False)
    )
    superseded = F.coalesce(
        (F.col("_next_side") == F.col(_SIDE)) & next_in_time, F.lit(False)
    )
    second = F.struct(*[F.col(f"_next_{c}").alias(c) for c in columns])
    return runs.filter(F.col(_SIDE) == F.col("_start_side")).select(
        F.col(key),
        F.when(taken, "matched").otherwise(F.col(_SIDE)).alias("side"),
        superseded.alias("superseded"),
        F.struct(*columns).alias("first"),
        F.when(taken, second).alias("second"),
    )
