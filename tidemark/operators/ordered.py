"""Skew-safe ordered operators: running aggregates and neighbouring rows.

Without a hot key this is the plain window plan: one shuffle on the key, shared
by consecutive operators. With hot keys each operator shuffles on (key, slice).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import (
    DEFAULT_POLICY,
    HOT,
    SLICE,
    HotKeys,
    SkewPolicy,
    find_hot,
    with_slice,
)
from tidemark.session import scratch_path

_SEED = "_seed"


@dataclass(frozen=True)
class Running:
    """One running aggregate.

    kind: ``sum``, ``count``, ``min``, ``max``, ``first`` or ``last``; like the
    SQL aggregates all of them skip nulls in ``value``.
    previous: also return the value as it was before the row, under this name.
    """

    name: str
    kind: str
    value: Column
    previous: str | None = None

    def contribution(self) -> Column:
        if self.kind == "count":
            return F.when(self.value.isNotNull(), 1).otherwise(0).cast("long")
        return self.value

    def fold(self, col: Column) -> Column:
        """The aggregate over contributions, usable in a window or a groupBy."""
        if self.kind in ("sum", "count"):
            return F.sum(col)
        if self.kind == "min":
            return F.min(col)
        if self.kind == "max":
            return F.max(col)
        if self.kind == "first":
            return F.first(col, ignorenulls=True)
        if self.kind == "last":
            return F.last(col, ignorenulls=True)
        raise ValueError(f"unknown running aggregate {self.kind!r}")

    def join(self, before: Column, here: Column) -> Column:
        """The aggregate of two consecutive stretches, either of which may be null."""
        if self.kind in ("sum", "count"):
            return F.coalesce(before + here, here, before)
        if self.kind == "min":
            return F.least(before, here)
        if self.kind == "max":
            return F.greatest(before, here)
        return F.coalesce(before, here) if self.kind == "first" else F.coalesce(here, before)

    def per_slice(self, col: Column, position: Column) -> Column:
        """The aggregate of one slice in a groupBy, where row order is not given."""
        if self.kind in ("first", "last"):
            pick = F.min if self.kind == "first" else F.max
            chosen = pick(F.when(col.isNotNull(), F.struct(position, col.alias("v"))))
            return chosen["v"]
        return self.fold(col)


def hot_keys(
    df: DataFrame,
    keys: list[str],
    order: Sequence[str],
    hot: HotKeys | None,
    policy: SkewPolicy,
) -> HotKeys:
    """``hot`` if given, else measured: operators made of several steps ask once."""
    if hot is None:
        return find_hot(df, keys, order[0], policy)
    if tuple(hot.keys) != tuple(keys):
        raise ValueError(f"hot keys were measured on {hot.keys}, not on {keys}")
    return hot


def _sorted(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def running(
    df: DataFrame,
    keys: list[str],
    order: Sequence[str],
    aggs: Sequence[Running],
    *,
    descending: bool = False,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add running aggregates over each key in ``order``.

    ``order`` must be total (end it with a tie-break); its first column is a
    timestamp or integer and is the axis hot keys are sliced on. An empty
    ``keys`` list runs over the whole table, see ``running_whole``. A hot key's
    slices start from a seed row that carries the aggregate of everything before.
    """
    order = list(order)
    if not keys:
        return running_whole(df, order, aggs, descending=descending)
    hot = hot_keys(df, keys, order, hot, policy)
    names = [f"_in_{i}" for i in range(len(aggs))]
    rows = with_slice(df, order[0], hot).withColumns(
        {n: a.contribution() for n, a in zip(names, aggs)}
    )
    group = [*keys, SLICE] if hot else keys
    sort = _sorted(order, descending)
    if hot:
        position = F.struct(*order).alias("p")
        if descending:
            by_slice = Window.partitionBy(*keys).orderBy(F.desc(SLICE))
        else:
            by_slice = Window.partitionBy(*keys).orderBy(SLICE)
        before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
        flip = {"first": "last", "last": "first"} if descending else {}
        per = [
            Running(a.name, flip.get(a.kind, a.kind), a.value).per_slice(
                F.col(n), position
            )
            for a, n in zip(aggs, names)
        ]
        totals = (
            rows.filter(F.col(HOT))
            .groupBy(*group)
            .agg(*[p.alias(n) for p, n in zip(per, names)])
        )
        seeds = totals.select(
            *group,
            *[a.fold(F.col(n)).over(before).alias(n) for a, n in zip(aggs, names)],
            F.lit(0).alias(_SEED),
        )
        rows = rows.withColumn(_SEED, F.lit(1)).unionByName(
            seeds, allowMissingColumns=True
        )
        sort = [F.col(_SEED).asc(), *sort]
    along = Window.partitionBy(*group).orderBy(*sort)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns(
        {a.name: a.fold(F.col(n)).over(upto) for a, n in zip(aggs, names)}
    )
    back = {a.previous: F.lag(a.name).over(along) for a in aggs if a.previous}
    if back:
        rows = rows.withColumns(back)
    if hot:
        rows = rows.filter(F.col(_SEED) == 1)
    added = [a.name for a in aggs] + list(back)
    return rows.select(*[c for c in df.columns if c not in added], *added)


def running_whole(
    df: DataFrame, order: Sequence[str], aggs: Sequence[Running], *, descending: bool = False
) -> DataFrame:
    """Running aggregates over the whole table, by range partitions of ``order``.

    The same plan at every size: rows are dealt by ranges of all order columns and
    written once, so that the ranges stay as they are. One row per range carries
    what the ranges before it add up to.
    """
    spark = df.sparkSession
    names = [f"_in_{i}" for i in range(len(aggs))]
    sort = _sorted(order, descending)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranges")
    df.withColumns({n: a.contribution() for n, a in zip(names, aggs)}).repartitionByRange(
        tasks, *sort
    ).withColumn(SLICE, F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    flip = {"first": "last", "last": "first"} if descending else {}
    position = F.struct(*order).alias("p")
    totals = rows.groupBy(SLICE).agg(
        *[
            Running(a.name, flip.get(a.kind, a.kind), a.value).per_slice(F.col(n), position).alias(n)
            for a, n in zip(aggs, names)
        ]
    )
    # One row per range here, so this one window stays small, and so does its broadcast.
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    seeds = totals.select(
        SLICE, *[a.fold(F.col(n)).over(before).alias(f"_seed{n}") for a, n in zip(aggs, names)]
    )
    along = Window.partitionBy(SLICE).orderBy(*sort)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.join(F.broadcast(seeds), SLICE)
    seed = {a.name: F.col(f"_seed{n}") for a, n in zip(aggs, names)}
    out = out.withColumns(
        {a.name: a.join(seed[a.name], a.fold(F.col(n)).over(upto)) for a, n in zip(aggs, names)}
    )
    first = F.row_number().over(along) == 1
    back = {
        a.previous: F.when(first, seed[a.name]).otherwise(F.lag(a.name).over(along))
        for a in aggs
        if a.previous
    }
    if back:
        out = out.withColumns(back)
    added = [a.name for a in aggs] + list(back)
    return out.select(*[c for c in df.columns if c not in added], *added)


def settle(df: DataFrame, hot: HotKeys) -> DataFrame:
    """The input of a further ordered step, written once if keys are split.

    A step over split keys reads its input two or three times; without this a
    chain of steps would recompute the first ones again and again. The table is
    in the shared folder, so a lost executor costs nothing. Without hot keys
    steps stay in one plan and share their shuffle.
    """
    if not hot:
        return df
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@dataclass(frozen=True)
class Neighbour:
    """A value of the row ``offset`` places after (before, if negative) a row."""

    name: str
    column: str | Column
    offset: int


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: Sequence[str],
    wanted: Sequence[Neighbour],
    *,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add columns of preceding and following rows of the same key.

    A slice of a hot key is given the few rows on either side of it that its
    own rows can reach, so each lookup stays inside the slice's task.
    """
    order = list(order)
    hot = hot_keys(df, keys, order, hot, policy)
    rows = with_slice(df, order[0], hot)
    group = [*keys, SLICE] if hot else keys
    if hot:
        rows = rows.withColumn(_SEED, F.lit(False))
        ahead = max([w.offset for w in wanted if w.offset > 0], default=0)
        back = max([-w.offset for w in wanted if w.offset < 0], default=0)
        base = rows.filter(F.col(HOT))
        halo = [
            _halo(base, keys, order, reach, descending)
            for reach, descending in ((ahead, False), (back, True))
            if reach
        ]
        for part in halo:
            rows = rows.unionByName(part)
    along = Window.partitionBy(*group).orderBy(*_sorted(order, False))
    rows = rows.withColumns(
        {
            w.name: (F.lead if w.offset > 0 else F.lag)(w.column, abs(w.offset)).over(
                along
            )
            for w in wanted
        }
    )
    if hot:
        rows = rows.filter(~F.col(_SEED))
    return rows.drop(SLICE, HOT, _SEED)


def _halo(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    reach: int,
    descending: bool,
) -> DataFrame:
    """For each slice the ``reach`` rows that follow it (precede it if descending).

    Only the outermost ``reach`` rows of every slice are looked at: the rows
    following a slice are found among the first rows of the slices after it.
    """
    edge = Window.partitionBy(*keys, SLICE).orderBy(*_sorted(order, descending))
    heads = rows.withColumn("_rn", F.row_number().over(edge)).filter(
        F.col("_rn") <= reach
    )
    along = Window.partitionBy(*keys).orderBy(*_sorted(order, descending))
    data = [c for c in rows.columns if c not in (SLICE, HOT, _SEED)]
    record = F.struct(*data)
    following = heads.select(
        SLICE,
        (~F.col(SLICE).eqNullSafe(F.lead(SLICE).over(along))).alias("_last"),
        F.array(*[F.lead(record, i).over(along) for i in range(1, reach + 1)]).alias(
            "_next"
        ),
    ).filter("_last")
    return following.select(SLICE, F.explode("_next").alias("_row")).filter(
        F.col("_row").isNotNull()
    ).select("_row.*", SLICE, F.lit(True).alias(HOT), F.lit(True).alias(_SEED))
