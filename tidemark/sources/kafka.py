"""Kafka text topics.

Needs the ``spark-sql-kafka`` package on the cluster; the decoding below is
plain DataFrame code over the Kafka source's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KAFKA_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset long, "
    "timestamp timestamp, timestampType int"
)


def source_options(
    servers: str,
    topic: str,
    *,
    group: str | None = None,
    starting: str = "latest",
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source; new data only unless told otherwise."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return decode(spark.readStream.format("kafka").options(**options).load())


def decode(df: DataFrame) -> DataFrame:
    """Message bytes as UTF-8 text, with the position that orders them."""
    return df.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ingest_ts"),
        "topic",
        "partition",
        "offset",
    )
