"""Running totals over micro-batches, kept by batch id in a keyed store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import Running, running
from tidemark.operators.skew import DEFAULT_POLICY, SkewPolicy
from tidemark.operators.windows import WINDOW_END
from tidemark.streaming.late import BatchFn


def running_totals(
    path: str,
    order: Sequence[str],
    value: Column,
    name: str,
    *,
    at_us: str,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> BatchFn:
    """A ``foreachBatch`` function: each row with its window's total up to it.

    Batches must come in order of ``at_us``, as rows do that waited for the watermark.
    A batch starts from the totals of the one before and writes its own under its id, so
    it may run again. Windows that ended before a batch's last row are left out of them.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # several actions follow, and each would run the stream's state again
        try:
            write(batch, batch_id)
        finally:
            batch.unpersist()

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = running(
            batch, [WINDOW_END], order, [Running("_own", "sum", value)], policy=policy
        )
        if batch_id > 0:
            before = spark.read.parquet(f"{path}/totals/batch={batch_id - 1}").withColumnRenamed(
                "total", "_before"
            )
        else:
            before = batch.select(WINDOW_END).limit(0).withColumn("_before", F.lit(0).cast("long"))
        rows = rows.join(before, WINDOW_END, "left").withColumn(
            name, F.col("_own") + F.coalesce("_before", F.lit(0))
        )
        out = f"{path}/rows/batch={batch_id}"
        rows.drop("_own", "_before").write.mode("overwrite").parquet(out)
        written = spark.read.parquet(out)
        last = written.agg(F.max(at_us)).first()[0]
        now = written.groupBy(WINDOW_END).agg(F.max(name).alias("total"))
        every = now.unionByName(before.withColumnRenamed("_before", "total"))
        if last is not None:
            every = every.filter(F.col(WINDOW_END) * 1000 > last)
        every.groupBy(WINDOW_END).agg(F.max("total").alias("total")).write.mode(
            "overwrite"
        ).parquet(f"{path}/totals/batch={batch_id}")

    return run
