"""Change log of a ranking: which places move with each row of a window.

A window's ranking of items by their counts is a maximum of sorts: of all (count, item)
pairs that rows have brought so far, each item's last is its greatest, and the best ``n``
of two stretches of rows are among the best ``n`` of each. So a stretch hands on ``n``
pairs, whatever it holds, and stretches can be folded side by side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions.times import floor_to, micros, us_to_ms
from tidemark.operators.ordered import Running, running
from tidemark.operators.skew import DEFAULT_POLICY, SkewPolicy
from tidemark.operators.topn import top_n
from tidemark.operators.windows import WINDOW_END
from tidemark.session import scratch_path

COUNT = "n"
_RANGE = "_range"
_SEED = "_seed"


def best(pairs: list[tuple], n: int) -> list[tuple]:
    """The first ``n`` of (count, item) pairs, one for each item: greater counts first,
    then smaller items, null last."""
    greatest: dict = {}
    for count, item in pairs:
        greatest[item] = max(count, greatest.get(item, count))
    order = sorted(greatest.items(), key=lambda x: (-x[1], x[0] is None, x[0] if x[0] is not None else 0))
    return [(count, item) for item, count in order[:n]]


def changes(old: list[tuple], new: list[tuple]) -> list[tuple[bool, tuple, int]]:
    """(is_add, pair, rank) for each place that differs, removals before additions."""
    out = []
    for i, pair in enumerate(new):
        if i < len(old) and old[i] == pair:
            continue
        if i < len(old):
            out.append((False, old[i], i + 1))
        out.append((True, pair, i + 1))
    return out


def _fold(n: int, item: str, passed: list[str], schema: pa.Schema):
    """Map function over rows in order: a window's ranking so far is all it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, top = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (_RANGE, WINDOW_END, item, COUNT, _SEED)]
            rows, is_add, counts, items, ranks = [], [], [], [], []
            for i, (part, window, own, count, seed) in enumerate(zip(*columns, strict=True)):
                if (part, window) != place:
                    place = part, window
                    top = best([(s["n"], s["item"]) for s in seed or []], n)
                new = best([*top, (count, own)], n)
                for added, (c, x), rank in changes(top, new):
                    rows.append(i)
                    is_add.append(added)
                    counts.append(c)
                    items.append(x)
                    ranks.append(rank)
                top = new
            if rows:
                kept = batch.select(passed).take(pa.array(rows))
                added = [is_add, items, counts, ranks]
                fields = list(schema)[len(passed) :]
                values = [pa.array(v, f.type) for v, f in zip(added, fields, strict=True)]
                yield pa.RecordBatch.from_arrays([*kept.columns, *values], schema=schema)

    return run


def ranked_changelog(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    item: str,
    size: str,
    n: int,
    *,
    slide: str | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Every change of the ``n`` most frequent items of each window as rows come in.

    ``order`` is the total order in which rows count. Output: window_end, the order
    columns of the row that made the change, ``is_add``, the item, its count and rank.
    Equal counts rank by item, null last. Rows without a time are in no window.

    A row matters only while fewer than ``n`` items have a greater count than its own;
    how many reached one more before it is a running count by window and count, and the
    others go before the fold. What is left is folded by ranges of window and order, each
    from the best pairs of the ranges before it.
    """
    spark = df.sparkSession
    length = micros(size)
    step = micros(slide) if slide else length
    if length % step:
        raise ValueError("window size must be a multiple of the slide")
    pane = floor_to(F.unix_micros(ts), step)
    ends = F.sequence(pane + step, pane + length, F.lit(step))
    copies = df.filter(F.col(ts).isNotNull()).select(
        item, *order, F.explode(ends).alias("_end")
    ).withColumn(WINDOW_END, us_to_ms(F.col("_end"))).drop("_end")
    counted = running(
        copies, [WINDOW_END, item], order, [Running(COUNT, "count", F.lit(1))], policy=policy
    )
    # As the row that reaches its count, and as one that asks who reached one more before.
    sides = F.explode(F.array(F.lit(False), F.lit(True)))
    asked = counted.withColumn("_asks", sides).withColumn(
        "_level", F.col(COUNT) + F.col("_asks").cast("int")
    )
    above = running(
        asked, [WINDOW_END, "_level"], [*order, "_asks"],
        [Running("_above", "count", F.when(~F.col("_asks"), 1))], policy=policy,
    )
    rows = above.filter(F.col("_asks") & (F.col("_above") < n)).select(
        WINDOW_END, item, *order, COUNT
    )
    path = scratch_path(spark, "rank-ranges")
    rows.repartitionByRange(WINDOW_END, *order).withColumn(
        _RANGE, F.spark_partition_id()
    ).write.parquet(path)
    dealt = spark.read.parquet(path)
    greatest = dealt.groupBy(_RANGE, WINDOW_END, item).agg(F.max(COUNT).alias(COUNT))
    tops = top_n(greatest, [_RANGE, WINDOW_END], COUNT, n, [item])
    listed = tops.groupBy(_RANGE, WINDOW_END).agg(
        F.collect_list(F.struct(F.col(COUNT).alias("n"), F.col(item).alias("item"))).alias("_top")
    )
    earlier = Window.partitionBy(WINDOW_END).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    seeds = listed.select(
        _RANGE, WINDOW_END, F.flatten(F.collect_list("_top").over(earlier)).alias(_SEED)
    ).filter(F.size(_SEED) > 0)
    # Only the first window of a range began before it: at most one seed for each range.
    seeded = dealt.join(F.broadcast(seeds), [_RANGE, WINDOW_END], "left")
    passed = [WINDOW_END, *order]
    schema = T.StructType(
        [
            *[T.StructField(c, dealt.schema[c].dataType) for c in passed],
            T.StructField("is_add", T.BooleanType()),
            T.StructField(item, dealt.schema[item].dataType),
            T.StructField(COUNT, T.LongType()),
            T.StructField("rank", T.IntegerType()),
        ]
    )
    ordered = seeded.repartition(_RANGE).sortWithinPartitions(_RANGE, WINDOW_END, *order)
    return ordered.mapInArrow(_fold(n, item, passed, to_arrow_schema(schema)), schema)
