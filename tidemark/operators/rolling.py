"""Per-row keyed aggregates: one output row for every input row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import (
    Neighbour,
    Running,
    hot_keys,
    neighbours,
    running,
    settle,
)
from tidemark.operators.skew import DEFAULT_POLICY, HotKeys, SkewPolicy


def rolling(
    df: DataFrame,
    keys: list[str],
    order: Sequence[str],
    value: str,
    kind: str,
    *,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Rolling sum, min or max of ``value``.

    The other columns show the values of the key's first row, as a rolling
    field aggregate over records does.
    """
    rest = [c for c in df.columns if c not in (*keys, *order, value)]
    aggs = [Running("_rolled", kind, F.col(value))]
    if rest:
        # one struct, so that a null field of the first row stays null
        aggs.append(Running("_first", "first", F.struct(*rest)))
    out = running(df, keys, order, aggs, hot=hot, policy=policy)
    kept = [c for c in (*keys, *order) if c in df.columns]
    return out.select(
        *dict.fromkeys(kept),
        F.col("_rolled").alias(value),
        *[F.col(f"_first.{c}").alias(c) for c in rest],
    )


def rolling_concat(
    df: DataFrame, keys: list[str], order: Sequence[str], items: str
) -> DataFrame:
    """Each row with all list items of its key so far.

    The result is one whole list per row, so its size is quadratic in the rows
    of a key whatever the plan. Meant for keys that are short by nature.
    """
    upto = (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(items, F.flatten(F.collect_list(items).over(upto)))


def jumps(
    df: DataFrame,
    keys: list[str],
    order: Sequence[str],
    value: str,
    threshold: float,
    *,
    first_is_zero: bool,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Rows whose value differs from the key's previous one by more than ``threshold``.

    first_is_zero: take the value before the first row as 0.0, so that the
    first row can alert; otherwise it never does.
    """
    out = neighbours(
        df, keys, order, [Neighbour("previous", value, -1)], hot=hot, policy=policy
    )
    if first_is_zero:
        out = out.withColumn("previous", F.coalesce("previous", F.lit(0.0)))
    return out.filter(F.abs(F.col(value) - F.col("previous")) > threshold)


def changelog(
    df: DataFrame,
    keys: list[str],
    order: Sequence[str],
    aggs: Sequence[tuple[str, str, Column]],
    *,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Every change of a grouped result as remove-old and add-new rows.

    ``aggs`` are (name, kind, value). Output: keys, order columns, ``is_add``,
    and the aggregates. A row that leaves the result as it was emits nothing.
    """
    plan = [Running(n, kind, v, previous=f"_old_{n}") for n, kind, v in aggs]
    versions = running(
        df.withColumn("_one", F.lit(1)),
        keys,
        order,
        [*plan, Running("_seen", "count", F.col("_one"))],
        hot=hot,
        policy=policy,
    )
    names = [n for n, _, _ in aggs]
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_old_{n}"))
    new = F.struct(F.lit(True).alias("is_add"), *names)
    old = F.struct(
        F.lit(False).alias("is_add"), *[F.col(f"_old_{n}").alias(n) for n in names]
    )
    is_first = F.col("_seen") == 1
    changes = F.when(is_first, F.array(new)).otherwise(F.array(old, new))
    return (
        versions.filter(is_first | ~same)
        .select(*keys, *order, F.explode(changes).alias("_c"))
        .select(*keys, *order, "_c.*")
    )


def top_changelog(
    df: DataFrame,
    keys: list[str],
    order: Sequence[str],
    value: str,
    n: int,
    *,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Remove-old and add-new rows for the changed places of each key's ``n`` greatest values.

    Equal values are kept, nulls change nothing. The greatest value so far is a running
    maximum; what it leaves behind, the lesser of a value and the maximum before it, has
    the second as its running maximum, and so on. Output: keys, order columns, ``is_add``,
    ``value`` and ``rank``.
    """
    rows = df.filter(F.col(value).isNotNull()).withColumn("_left_0", F.col(value))
    hot = hot_keys(rows, keys, order, hot, policy)
    for i in range(n):
        place = Running(f"_top_{i}", "max", F.col(f"_left_{i}"), previous=f"_was_{i}")
        rows = running(rows, keys, order, [place], hot=hot, policy=policy)
        # Nothing is left behind until there was a greatest value.
        left = F.when(F.col(f"_was_{i}").isNotNull(), F.least(f"_left_{i}", f"_was_{i}"))
        rows = settle(rows.withColumn(f"_left_{i + 1}", left), hot)
    changes = []
    for i in range(n):
        old, new = F.col(f"_was_{i}"), F.col(f"_top_{i}")
        changed = new.isNotNull() & ~new.eqNullSafe(old)
        for wanted, is_add, own in ((changed & old.isNotNull(), False, old), (changed, True, new)):
            entry = F.struct(F.lit(is_add).alias("is_add"), own.alias("value"), F.lit(i + 1).alias("rank"))
            changes.append(F.when(wanted, entry))
    kept = F.filter(F.array(*changes), lambda c: c.isNotNull())
    return rows.select(*keys, *order, F.explode(kept).alias("_c")).select(*keys, *order, "_c.*")
