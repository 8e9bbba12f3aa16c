"""Text-shaped inputs: behaviour files, access logs, keyed times.

Each ``parse_*`` works on any DataFrame with a string column (files, Kafka
values, batch or stream). Lines that do not parse come back as rejects rather
than failing the job or vanishing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The field layouts and time pattern of the input formats.
BEHAVIOR_FIELDS = ("user_id", "item_id", "category_id", "behavior", "epoch_seconds")
BEHAVIOR_TYPES = ("long", "long", "int", "string", "long")
ACCESS_LOG_FIELDS = {"ip": 0, "user_id": 2, "time": 3, "method": 5, "url": 6}
ACCESS_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"

#: A line without all of these is a reject.
BEHAVIOR_REQUIRED = ("user_id", "item_id", "category_id", "behavior", "ts")


def read_behavior(
    spark: SparkSession, path: str, *, streaming: bool = False
) -> DataFrame:
    """The good lines of behaviour files (user, item, category, behaviour, epoch seconds).

    ``rejected`` of the parsed lines gives the others.
    """
    lines = read_lines(spark, path, streaming=streaming)
    return accepted(parse_behavior(lines), BEHAVIOR_REQUIRED)


def read_lines(
    spark: SparkSession, path: str, *, streaming: bool = False
) -> DataFrame:
    """Text lines in a column ``value``."""
    return (spark.readStream if streaming else spark.read).text(path)


def _field(parts: Column, index: int) -> Column:
    return F.get(parts, F.lit(index))


def parse_behavior(df: DataFrame, column: str = "value") -> DataFrame:
    """Behaviour lines held in a string column, e.g. message values; keeps the line."""
    parts = F.split(F.col(column), ",")
    cols = [
        _field(parts, i).try_cast(t).alias(n)
        for i, (n, t) in enumerate(zip(BEHAVIOR_FIELDS, BEHAVIOR_TYPES))
    ]
    return df.select(F.col(column).alias("line"), *cols).select(
        "line", *BEHAVIOR_FIELDS[:-1], F.timestamp_seconds("epoch_seconds").alias("ts")
    )


def parse_access_log(df: DataFrame, column: str = "value") -> DataFrame:
    """Access-log lines, split on single spaces; keeps the line for rejects."""
    parts = F.split(F.col(column), " ")
    fields = {n: _field(parts, i) for n, i in ACCESS_LOG_FIELDS.items()}
    return df.select(
        F.col(column).alias("line"),
        fields["ip"].alias("ip"),
        fields["user_id"].alias("user_id"),
        F.try_to_timestamp(fields["time"], F.lit(ACCESS_LOG_TIME)).alias("ts"),
        fields["method"].alias("method"),
        fields["url"].alias("url"),
    )


def parse_keyed_times(df: DataFrame, column: str = "value") -> DataFrame:
    """Lines of ``key seconds``."""
    parts = F.split(F.col(column), " ")
    return df.select(
        F.col(column).alias("line"),
        _field(parts, 0).alias("key"),
        F.timestamp_seconds(_field(parts, 1).try_cast("long")).alias("ts"),
    )


def accepted(parsed: DataFrame, required: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Rows whose required fields parsed.

    A filter would parse each line twice, once to judge it and once to use it, as it moves
    below the parsing. Good rows are unfolded from an array of one instead.
    """
    good = F.lit(True)
    for name in required:
        good = good & F.col(name).isNotNull()
    row = F.struct(*[c for c in parsed.columns if c != "line"])
    return parsed.select(F.explode(F.when(good, F.array(row))).alias("_row")).select("_row.*")


def rejected(parsed: DataFrame, required: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Rows that did not parse, as raw lines."""
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    return parsed.filter(missing).select("line")
