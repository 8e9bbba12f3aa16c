"""Event sequences per key: consecutive rows that meet one predicate each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import micros
from tidemark.operators.ordered import Neighbour, neighbours
from tidemark.operators.skew import DEFAULT_POLICY, HotKeys, SkewPolicy


def match_sequence(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    steps: Sequence[tuple[str, Column]],
    *,
    within: str | None = None,
    on_timeout: bool = False,
    hot: HotKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Matches of ``steps`` on directly consecutive rows of a key.

    Every row that meets the first step starts its own attempt, so matches may
    overlap. ``within`` bounds last minus first time, strictly.

    Output: key, ``outcome`` and one struct per step. With ``on_timeout`` also
    the attempts that ran out of time: the row that should have come next is
    missing or too late. An attempt whose next row came in time but does not
    fit ends without a trace.
    """
    ts = order[0]
    names = [n for n, _ in steps]
    fits = {f"_fit_{i}": F.coalesce(p, F.lit(False)) for i, (_, p) in enumerate(steps)}
    columns = df.columns
    wanted = []
    for i in range(1, len(steps)):
        # column by column: those a query does not use are pruned
        wanted += [Neighbour(f"_{i}_{c}", c, i) for c in columns]
        wanted.append(Neighbour(f"_ok_{i}", f"_fit_{i}", i))
    rows = neighbours(df.withColumns(fits), [key], order, wanted, hot=hot, policy=policy)

    def row_ok(i: int) -> Column:
        if i == 0:
            return F.col("_fit_0")
        return in_time(i) & F.coalesce(F.col(f"_ok_{i}"), F.lit(False))

    def in_time(i: int) -> Column:
        if within is None:
            return F.col(f"_ok_{i}").isNotNull()
        gap = F.unix_micros(F.col(f"_{i}_{ts}")) - F.unix_micros(F.col(ts))
        return F.coalesce(gap < micros(within), F.lit(False))

    matched = row_ok(0)
    reached = F.lit(1)
    timed_out = F.lit(False)
    for i in range(1, len(steps)):
        timed_out = timed_out | (matched & ~in_time(i))
        matched = matched & row_ok(i)
        reached = F.when(matched, i + 1).otherwise(reached)
    outcome = F.when(matched, "matched").when(timed_out, "timeout")
    out = rows.filter(F.col("_fit_0")).withColumns(
        {"outcome": outcome, "_reached": reached}
    )
    keep = ["matched", "timeout"] if on_timeout else ["matched"]
    structs = [F.struct(*columns).alias(names[0])]
    for i in range(1, len(steps)):
        row = F.struct(*[F.col(f"_{i}_{c}").alias(c) for c in columns])
        structs.append(F.when(F.col("_reached") > i, row).alias(names[i]))
    return out.filter(F.col("outcome").isin(keep)).select(key, "outcome", *structs)
