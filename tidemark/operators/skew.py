"""Splitting of hot keys into time slices.

An ordered operator (running total, previous row, next row) needs the rows of
a key in order, and the plain ``Window.partitionBy(key)`` puts a whole key into
one task. A key that holds a third of the table would then be one task's work.

The answer used everywhere in this package: keys that hold more than
``1 / max_hot`` of all rows are cut into equal slices of their order column,
between the values that leave out a thousandth of the rows at either end: rows with
a wrong time fall into the first or last slice and cannot widen the others.
By counting, at most ``max_hot`` keys can pass that share, so the table of hot
keys is bounded whatever the size of the data, and may be broadcast. What has
to cross a slice boundary (a carried total, the neighbouring rows) travels as
extra rows, so no join against the data is needed.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import floor_to

SLICE = "_slice"
HOT = "_hot"


@dataclass(frozen=True)
class SkewPolicy:
    """When and how finely keys are split.

    max_hot: a key is hot above ``1 / max_hot`` of the rows.
    min_rows: never split a key with fewer rows than this.
    oversplit: slices per ``min_rows``-or-share sized piece, so that uneven
        spread over time still leaves slices of a manageable size.
    """

    max_hot: int = 10_000
    min_rows: int = 1_000_000
    oversplit: int = 16


DEFAULT_POLICY = SkewPolicy()


@dataclass(frozen=True)
class HotKeys:
    """Hot keys with the origin and width of their slices (driver-side, bounded)."""

    keys: tuple[str, ...]
    rows: tuple[tuple, ...] = ()
    schema: T.StructType | None = field(default=None, compare=False)

    def __bool__(self) -> bool:
        return bool(self.rows)


def position(col: str | Column, dtype: T.DataType) -> Column:
    """The order column as a long, the axis slices are cut on."""
    col = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(col.cast("timestamp"))
    return col.cast("long")


def find_hot(
    df: DataFrame,
    keys: list[str],
    order: str,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> HotKeys:
    """Measure which keys must be split.

    Runs a row count, and only on tables large enough to hold a hot key also
    one map-side-combined count per key. At most ``max_hot`` rows reach the
    driver.
    """
    none = HotKeys(tuple(keys))
    total = df.select(order).count()
    if total <= policy.min_rows:
        return none
    piece = max(ceil(total / policy.max_hot), policy.min_rows)
    pos = position(order, df.schema[order].dataType)
    counts = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(pos).alias("_lo"))
        .filter((F.col("_n") > piece) & F.col("_lo").isNotNull())
    )
    found = [tuple(r[k] for k in keys) for r in counts.collect()]
    if not found:
        return none
    held = [T.StructField(k, df.schema[k].dataType, True) for k in keys]
    only = df
    if keys:
        table = df.sparkSession.createDataFrame(found, T.StructType(held))
        match = F.lit(True)
        for k in keys:
            match = match & df[k].eqNullSafe(table[k])
        only = df.join(F.broadcast(table), match, "left_semi")  # at most ``max_hot`` keys
    spread = only.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx(pos, [0.001, 0.999], 2_000).alias("_ends"),
    )
    rows = []
    for r in spread.collect():
        slices = ceil(r["_n"] / piece) * policy.oversplit
        lo, hi = r["_ends"]
        width = max(1, ceil((hi - lo + 1) / slices))
        rows.append(tuple(r[k] for k in keys) + (lo, hi, width))
    bounds = [T.StructField(n, T.LongType()) for n in ("_lo", "_hi", "_width")]
    return HotKeys(tuple(keys), tuple(rows), T.StructType(held + bounds))


def with_slice(df: DataFrame, order: str, hot: HotKeys) -> DataFrame:
    """Add the slice start (0 for keys that are not split) and the hot flag.

    Without hot keys nothing is added, so consecutive operators on a key share
    one shuffle.
    """
    if not hot:
        return df
    pos = position(order, df.schema[order].dataType)
    if not hot.keys:
        lo, hi, width = hot.rows[0]
        number = floor_to(F.least(F.greatest(pos, F.lit(lo)), F.lit(hi)) - F.lit(lo), width)
        return df.withColumn(
            SLICE, F.coalesce(number, F.lit(0).cast("long"))
        ).withColumn(HOT, F.lit(True))
    table = df.sparkSession.createDataFrame(list(hot.rows), hot.schema)
    table = table.select(
        *[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(hot.keys)], "_lo", "_hi", "_width"
    )
    match = F.lit(True)
    for i, k in enumerate(hot.keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_hot_{i}"))
    # hot.rows is bounded by SkewPolicy.max_hot, see find_hot
    joined = df.join(F.broadcast(table), match, "left")
    offset = F.least(F.greatest(pos, F.col("_lo")), F.col("_hi")) - F.col("_lo")
    number = offset - F.pmod(offset, F.col("_width"))
    return joined.select(
        *df.columns,
        F.coalesce(number, F.lit(0).cast("long")).alias(SLICE),
        F.col("_width").isNotNull().alias(HOT),
    )
