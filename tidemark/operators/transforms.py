"""Row-wise operators, routing and union. All work on batch and stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_equal(column: str, value, *, keep_nulls: bool = False) -> Column:
    """``column != value``; with ``keep_nulls`` a null counts as different."""
    if keep_nulls:
        return ~F.col(column).eqNullSafe(F.lit(value))
    return F.col(column) != value


def repeat_rows(df: DataFrame, copies: Column) -> DataFrame:
    """Each row ``copies`` times; none for 0 or null."""
    times = F.coalesce(copies.cast("int"), F.lit(0))
    row = F.struct(*df.columns)
    return df.select(F.explode(F.array_repeat(row, times)).alias("_r")).select("_r.*")


def route(df: DataFrame, branches: Mapping[str, Column]) -> dict[str, DataFrame]:
    """Named branches of one input; a row goes to the first that accepts it.

    Every branch is a filter over the same scan, not a copy of the data.
    """
    taken = F.lit(False)
    out = {}
    for name, accepts in branches.items():
        accepts = F.coalesce(accepts, F.lit(False))
        out[name] = df.filter(accepts & ~taken)
        taken = taken | accepts
    return out


def tag_branch(
    df: DataFrame, branches: Mapping[str, Column], name: str = "branch"
) -> DataFrame:
    """As ``route``, as one DataFrame with the branch name; null when none accepts."""
    label = None
    for branch, accepts in branches.items():
        label = F.when(accepts, branch) if label is None else label.when(accepts, branch)
    return df.withColumn(name, label)


def with_side_output(
    df: DataFrame, condition: Column, side: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """The input unchanged, and a projection of the rows meeting ``condition``."""
    return df, df.filter(condition).select(*[c.alias(n) for n, c in side.items()])


def connect(
    left: DataFrame,
    right: DataFrame,
    on_left: Callable[[DataFrame], DataFrame],
    on_right: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Two inputs of different types through their own function into one output."""
    return on_left(left).unionByName(on_right(right))


def union_all(*inputs: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), inputs)


def map_with_lifecycle(
    df: DataFrame,
    schema: str,
    start: Callable[[], object],
    each: Callable[[object, pd.DataFrame], pd.DataFrame],
    stop: Callable[[object], None],
) -> DataFrame:
    """Map Arrow batches with a resource opened and closed once per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = start()
        try:
            for batch in batches:
                yield each(resource, batch)
        finally:
            stop(resource)

    return df.mapInPandas(run, schema)


def with_task_index(df: DataFrame, name: str = "task") -> DataFrame:
    return df.withColumn(name, F.spark_partition_id())


def rebalance(df: DataFrame, partitions: int) -> DataFrame:
    """Spread rows round-robin."""
    return df.repartition(partitions)


def shrink(df: DataFrame, partitions: int) -> DataFrame:
    """Fewer partitions without a shuffle."""
    return df.coalesce(partitions)
