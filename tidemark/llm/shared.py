"""Written intermediate tables, row keys and session settings of these operators."""

from __future__ import annotations

import sys
import types
import uuid

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import prepare, scratch_path

#: Arrow batches end at this many rows or bytes: whole texts are wide rows, and an
#: executor's workers share what the JVM leaves of its memory.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and bounded Arrow batches."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it from there.

    Later steps neither compute it again nor depend on the executors that did.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, label: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"_{label}"
    while name.lower() in taken:
        name = f"_{label}_{uuid.uuid4().hex[:8]}"
    return name


def text_of(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column].cast("string"), F.lit(""))


def text_key(column: Column) -> Column:
    """Tells texts of one ``doc_id`` apart; with it, names a document."""
    return F.xxhash64(column)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of columns that both sides have."""
    out = F.lit(True)
    for n in names:
        out = out & left[n].eqNullSafe(right[n])
    return out


def first_of_each(rows: DataFrame, group: str, order: list[str], most: int) -> DataFrame:
    """At most ``most`` rows of each ``group`` in ``order``; rows that agree in these are one.

    Copies go before they are counted, so a repeated row takes one place, and the rows that
    may be collected are bounded by the number of groups.
    """
    different = rows.dropDuplicates([group, *order])
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return different.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by URI or by absolute path."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:/") and not path.startswith("file://"):
            path = "file://" + path[5:]
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def worker_memory(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, not just one task.

    Functions of this package reach workers by value, so their own module
    globals would start anew with each task.
    """
    holder = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker"))
    return holder.__dict__.setdefault(name, {})
