"""Kafka text sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.sources.files import read_lines


def sink_options(servers: str, topic: str, *, source_topic: str | None = None) -> dict:
    """Options of the Kafka sink. Writing to the topic being read would loop."""
    if source_topic is not None and source_topic == topic:
        raise ValueError(f"topic {topic!r} is both source and sink")
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def encode(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("string").alias("value"))


def stream_to_topic(
    df: DataFrame, column: str, options: dict, checkpoint: str
) -> DataStreamWriter:
    return (
        encode(df, column)
        .writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )


def publish_file(spark: SparkSession, path: str, options: dict) -> None:
    """Send the lines of a file, one task per file split."""
    read_lines(spark, path).write.format("kafka").options(**options).save()
