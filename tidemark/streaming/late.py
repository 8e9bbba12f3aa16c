"""Late rows of a stream to a side output.

Spark drops late rows inside stateful operators and only counts them. Here the
rows are sorted out before any stateful operator sees them, exactly and in
arrival order, whatever the micro-batch boundaries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import micros
from tidemark.operators.lateness import with_watermark_before
from tidemark.operators.skew import DEFAULT_POLICY, SkewPolicy
from tidemark.operators.windows import window_end_ms

BatchFn = Callable[[DataFrame, int], None]


def split_late(
    arrival: Sequence[str],
    ts: str,
    state_path: str,
    on_time: BatchFn,
    late: BatchFn,
    *,
    delay: str = "0 seconds",
    size: str | None = None,
    allowed: str = "0 seconds",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> BatchFn:
    """A ``foreachBatch`` function that routes every row to one of two outputs.

    With a window ``size`` a row is late once its window closed ``allowed`` ago;
    without, when it is older than the watermark. What carries over between
    batches is one number, the greatest event time so far, stored per batch in
    the shared ``state_path``: a batch that is run again starts from the same.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = None
        if batch_id > 0:
            seen = spark.read.parquet(f"{state_path}/batch={batch_id - 1}").first()["seen"]
        rows = with_watermark_before(
            batch, arrival, ts, delay, seen_us=seen, policy=policy
        )
        if size is None:
            is_late = F.unix_micros(ts) < F.col("watermark_us")
        else:
            end = window_end_ms(ts, size) * 1000
            is_late = end + micros(allowed) <= F.col("watermark_us")
        rows = rows.withColumn("_late", F.coalesce(is_late, F.lit(False))).persist()
        try:
            plain = rows.drop("watermark_us")
            on_time(plain.filter(~F.col("_late")).drop("_late"), batch_id)
            late(plain.filter("_late").drop("_late"), batch_id)
            rows.agg(
                F.greatest(F.max(F.unix_micros(ts)), F.lit(seen).cast("long")).alias("seen")
            ).write.mode("overwrite").parquet(f"{state_path}/batch={batch_id}")
        finally:
            rows.unpersist()

    return run


def batch_folders(path: str) -> BatchFn:
    """A sink that writes each batch to its own folder, replacing it on a rerun."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write
