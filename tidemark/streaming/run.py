"""Starting streams and replaying tables through them."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.session import scratch_path
from tidemark.sources.tables import stream_table, with_instants


def start(
    writer: DataStreamWriter, checkpoint: str, *, every: str = "10 seconds"
) -> StreamingQuery:
    """Run continuously with a recovery checkpoint."""
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )


Steps = Sequence[Callable[[], None]]

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
_starting = threading.Lock()

#: A partition of state gets more than this many rows only where the session names no more partitions.
ROWS_PER_PARTITION = 500_000


def state_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions for the state of a stream over ``rows`` rows.

    In each batch a partition costs a task, its Python workers and a commit, also one without
    rows. So there are two for a core, more only if the rows need them, and never more than
    the session names.
    """
    wanted = max(2 * spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_PARTITION))
    return min(wanted, int(spark.conf.get(SHUFFLE_PARTITIONS)))


def _start(spark: SparkSession, writer: DataStreamWriter, partitions: int | None) -> StreamingQuery:
    """Start a query with a number of partitions of its own; a query copies the session's settings."""
    if partitions is None:
        return writer.start()
    with _starting:
        session = spark.conf.get(SHUFFLE_PARTITIONS)
        spark.conf.set(SHUFFLE_PARTITIONS, str(partitions))
        try:
            return writer.start()
        finally:
            spark.conf.set(SHUFFLE_PARTITIONS, session)


def _drain(
    spark: SparkSession,
    writer: DataStreamWriter,
    checkpoint: str,
    steps: Steps,
    partitions: int | None = None,
) -> None:
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    _start(spark, writer, partitions).awaitTermination()
    for step in steps:
        step()
        _start(spark, writer, partitions).awaitTermination()


def drain(
    df: DataFrame,
    label: str,
    *,
    mode: str = "append",
    finish: Steps = (),
    partitions: int | None = None,
) -> DataFrame:
    """Run a stream over all available input into a table; return the table.

    Result and checkpoint live in the shared folder, so a lost executor or a
    restart resumes from the last committed batch. Whenever the input is used up,
    the next step of ``finish`` may add more, and the stream runs on. ``partitions``
    replaces the session's number of shuffle partitions for this stream.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = (
        df.writeStream.format("parquet").outputMode(mode).option("path", f"{path}/rows")
    )
    _drain(spark, writer, f"{path}/checkpoint", finish, partitions)
    return spark.read.schema(df.schema).parquet(f"{path}/rows")


def drain_anew(
    make: Callable[[], DataFrame], label: str, steps: Steps, partitions: int | None = None
) -> DataFrame:
    """As ``drain``, with a new query for each step, as a restarted program would build it.

    ``make`` reads its input anew. What a query leaves, its offsets, its state and the
    committed files of its sink, is in the shared folder, and the next one goes on from it.
    """
    first = make()
    spark = first.sparkSession
    path = scratch_path(spark, label)
    for step in steps:
        step()
        writer = make().writeStream.format("parquet").option("path", f"{path}/rows")
        _drain(spark, writer, f"{path}/checkpoint", (), partitions)
    return spark.read.schema(first.schema).parquet(f"{path}/rows")


def drain_batches(
    df: DataFrame,
    label: str,
    each: Callable[[DataFrame, int], None],
    *,
    mode: str = "append",
    finish: Steps = (),
) -> None:
    """Run a stream over all available input through a batch function."""
    writer = df.writeStream.foreachBatch(each).outputMode(mode)
    spark = df.sparkSession
    _drain(spark, writer, scratch_path(spark, f"{label}-checkpoint"), finish)


def drain_writer(
    writer: DataStreamWriter, label: str, spark: SparkSession, finish: Steps = ()
) -> None:
    """Run a stream over all available input into the sink that ``writer`` names."""
    _drain(spark, writer, scratch_path(spark, f"{label}-checkpoint"), finish)


#: Files per micro-batch of a replay; None takes what is there.
FILES_PER_TRIGGER: int | None = None


@dataclass(frozen=True)
class Replay:
    """A table as a stream with a watermark, and the steps that end it.

    Its files may come in any order. ``delay`` is the spread of the table's event
    times, so no order can make a row late: a replay waits for all rows of a key, as
    a table does. A live stream names the disorder it allows instead.

    The steps of ``finish`` add rows far behind the last event time. They lift the
    watermark so that what is still open fires, once for waiting rows and once more
    for the deadlines those set. ``present`` keeps them out of results and rows without a
    time in; as it names the event time, Spark cannot apply it before the watermark sees
    the row. ``partitions`` suits a state that holds the table's rows.
    """

    rows: DataFrame
    last_us: int
    finish: Steps
    partitions: int

    def present(self, condition: Column | None = None) -> Column:
        keep = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
        own = F.col("ts").isNull() | (F.unix_micros("ts") <= F.lit(self.last_us))
        return F.when(own, keep).otherwise(False)


def replay_events(spark: SparkSession, directory: str, delay: str | None = None) -> Replay:
    """The events table as a stream; ``delay`` replaces the measured one."""
    table = with_instants(spark.read.parquet(f"{directory}/events.parquet"))
    at = F.unix_micros("ts")
    first, last, n = (x or 0 for x in table.agg(F.min(at), F.max(at), F.count(F.lit(1))).first())
    spread = (last - first) // 1000 + 1
    # The pattern matches just this name; a stream takes a single file only as one.
    rows = stream_table(
        spark,
        f"{directory}/event[s].parquet",
        spark.read.parquet(f"{directory}/events.parquet").schema,
        max_files=FILES_PER_TRIGGER,
    )
    path = scratch_path(spark, "end-of-time")
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema])
    marker = spark.createDataFrame([], schema)
    marker.write.parquet(path)
    end = stream_table(spark, path, schema)

    def lift(days: int) -> Callable[[], None]:
        end_us = last + 1000 * spread + days * 86_400_000_000
        # No nulls: a filter on a join's key may run before the watermark sees the row.
        values = {f.name: F.lit("0").cast("double").cast(f.dataType) for f in schema if f.name != "ts"}
        values["ts"] = F.timestamp_micros(F.lit(end_us))
        row = spark.range(1).select(*[c.alias(n) for n, c in values.items()])
        return lambda: row.write.mode("append").parquet(path)

    both = rows.unionByName(end).withWatermark("ts", delay or f"{spread} milliseconds")
    return Replay(both, last, (lift(3650), lift(7300)), state_partitions(spark, n))


def replay_in_order(
    spark: SparkSession, df: DataFrame, column: str, slices: int = 4
) -> tuple[DataFrame, Steps]:
    """``df`` as a stream whose micro-batches are slices of ``column`` in order.

    For operators that judge rows by their arrival. Each step adds one slice and
    the stream takes it as one micro-batch; rows without a value are in the first.
    """
    at = F.unix_micros(F.col(column).cast("timestamp"))
    shares = [i / slices for i in range(1, slices)]
    cuts = df.agg(F.percentile_approx(at, shares, 10_000)).first()[0] or []
    path = scratch_path(spark, "in-order")
    df.limit(0).write.parquet(path)
    bounds = [None, *cuts, None]

    def add(low: int | None, high: int | None) -> Callable[[], None]:
        keep = F.lit(True)
        if low is not None:
            keep = keep & (at > low)
        if high is not None:
            keep = keep & (at.isNull() | (at <= high) if low is None else at <= high)
        return lambda: df.filter(keep).write.mode("append").parquet(path)

    steps = [add(a, b) for a, b in zip(bounds, bounds[1:], strict=False)]
    return spark.readStream.schema(df.schema).parquet(path), steps


def replay_arrivals(
    spark: SparkSession,
    df: DataFrame,
    arrival: str,
    watermark: Callable[[DataFrame], DataFrame],
    slices: int = 4,
) -> Replay:
    """``df`` as a live stream: micro-batches are equal spans of the ``arrival`` time.

    ``watermark`` sets the stream's watermark, which may lag less than the rows are out of
    order; rows are then judged batch by batch. Each step adds one slice, the last two end
    markers as in ``replay_events``.
    """
    at, us = F.unix_micros(arrival), F.unix_micros("ts")
    measured = df.agg(F.min(at), F.max(at), F.min(us), F.max(us), F.count(F.lit(1))).first()
    low, high, first, last, n = (x or 0 for x in measured)
    number = F.least(
        F.floor((at - low) * slices / F.lit(max(high - low, 1))), F.lit(slices - 1)
    )
    path = scratch_path(spark, "arrivals")
    df.limit(0).write.parquet(path)

    def add(i: int) -> Callable[[], None]:
        return lambda: df.filter(number == i).write.mode("append").parquet(path)

    def lift(days: int) -> Callable[[], None]:
        values = {f.name: F.lit(None).cast(f.dataType) for f in df.schema}
        values["ts"] = F.timestamp_micros(F.lit(2 * last - first + days * 86_400_000_000))
        row = spark.range(1).select(*[c.alias(n) for n, c in values.items()])
        return lambda: row.write.mode("append").parquet(path)

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    rows = watermark(spark.readStream.schema(schema).parquet(path))
    steps = (*[add(i) for i in range(slices)], lift(3650), lift(7300))
    return Replay(rows, last, steps, state_partitions(spark, n))
