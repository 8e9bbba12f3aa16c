"""Console output and several sinks for one stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.transforms import route

BatchFn = Callable[[DataFrame, int], None]


def to_console(df: DataFrame, *, rows: int = 20, mode: str = "append") -> DataStreamWriter:
    return (
        df.writeStream.format("console")
        .outputMode(mode)
        .option("numRows", rows)
        .option("truncate", False)
    )


def fan_out(*sinks: BatchFn) -> BatchFn:
    """Feed every sink from one computation of the batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def fan_out_routed(
    branches: Mapping[str, Column], sinks: Mapping[str, BatchFn]
) -> BatchFn:
    """Side outputs of a stream: every branch of a batch to its own sink."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, part in route(batch, branches).items():
                if name in sinks:
                    sinks[name](part, batch_id)
        finally:
            batch.unpersist()

    return run
