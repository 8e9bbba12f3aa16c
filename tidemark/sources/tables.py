"""Parquet tables, literals, and tables registered for SQL."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A parquet table with zone-less timestamps read as UTC instants.

    Watermarks accept only ``TimestampType``. The cast is a projection, so
    column pruning and filters on the other columns still reach the scan.
    """
    return with_instants(spark.read.parquet(f"{directory}/{name}.parquet"))


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """A parquet folder as a stream, with bounded micro-batches."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return with_instants(reader.parquet(path))


def with_instants(df: DataFrame) -> DataFrame:
    ntz = {
        f.name: F.col(f.name).cast("timestamp")
        for f in df.schema
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    return df.withColumns(ntz) if ntz else df


def from_rows(
    spark: SparkSession,
    rows: Iterable[Sequence],
    schema: str,
    *,
    arrival: str | None = "arrival",
) -> DataFrame:
    """A few literal rows; ``arrival`` numbers them in the given order."""
    rows = [tuple(r) for r in rows]
    if arrival:
        rows = [r + (i,) for i, r in enumerate(rows)]
        schema = f"{schema}, {arrival} long"
    return spark.createDataFrame(rows, schema)


def as_table(
    df: DataFrame,
    columns: dict[str, str | Column],
    *,
    event_time: str | None = None,
    delay: str = "0 seconds",
) -> DataFrame:
    """Choose and rename columns, and mark one as event time."""
    out = df.select(
        *[
            (F.col(src) if isinstance(src, str) else src).alias(name)
            for name, src in columns.items()
        ]
    )
    return out.withWatermark(event_time, delay) if event_time else out


def register(df: DataFrame, view: str) -> str:
    """Make ``df`` (batch or stream) queryable with ``spark.sql``."""
    df.createOrReplaceTempView(view)
    return view
