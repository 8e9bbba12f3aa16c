"""Rankings within a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import WINDOW_END


def top_n(
    df: DataFrame,
    group: Sequence[str],
    by: str,
    n: int,
    tie: Sequence[str],
    *,
    rank: str = "rank",
) -> DataFrame:
    """The ``n`` rows of each group with the greatest ``by``, ties by ``tie``, nulls last.

    Catalyst turns the filter into a group limit below the shuffle: each map
    task sends at most ``n`` rows per group.
    """
    w = Window.partitionBy(*group).orderBy(F.desc(by), *(F.asc_nulls_last(c) for c in tie))
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def top_values(
    df: DataFrame, key: str, value: str, n: int, tie: Sequence[str]
) -> DataFrame:
    """Up to ``n`` greatest values per key with their rank, duplicates kept, nulls left out."""
    ranked = top_n(df.filter(F.col(value).isNotNull()), [key], value, n, tie)
    return ranked.select(key, value, "rank")


def report(
    ranked: DataFrame,
    line: Column,
    *,
    group: str = WINDOW_END,
    rank: str = "rank",
    header: Column | None = None,
    separator: str = "\n",
    name: str = "report",
) -> DataFrame:
    """One text block per group. Takes rows that ``top_n`` has already limited."""
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(rank), line.alias("line")))),
        lambda r: r["line"],
    )
    body = F.array_join(lines, separator)
    text = F.concat(header, F.lit(separator), body) if header is not None else body
    return ranked.groupBy(group).agg(text.alias(name))


def count_line(rank: str, label: str, what: str, count: str) -> Column:
    return F.format_string(
        f"No.%d {label}=%s count=%d", F.col(rank), F.col(what), F.col(count)
    )
