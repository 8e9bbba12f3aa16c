"""Keyed and document sinks: set-based, replay-safe writes per micro-batch.

Connectors differ only in the writer, a factory called once per task. A writer
has ``write(rows)`` for one bulk request and ``close()``.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


class Writer(Protocol):
    def write(self, rows: list[Row]) -> None: ...

    def close(self) -> None: ...


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key.

    A grouped maximum: map tasks reduce to one row per key before the shuffle,
    and writing the result again changes nothing.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_r")).select(*keys, "_r.*")


def write_partitions(
    df: DataFrame, open_writer: Callable[[], Writer], batch_size: int = 1000
) -> None:
    """Send rows from every partition in bulk requests of ``batch_size``."""

    def send(rows: Iterable[Row]) -> None:
        rows = iter(rows)
        first = list(itertools.islice(rows, batch_size))
        if not first:
            return
        writer = open_writer()
        try:
            chunk = first
            while chunk:
                writer.write(chunk)
                chunk = list(itertools.islice(rows, batch_size))
        finally:
            writer.close()

    df.foreachPartition(send)


def hash_fields(
    df: DataFrame, field: str, value: str, order: Sequence[str] = ()
) -> DataFrame:
    """(field, value) text pairs of a hash; last write wins with ``order``."""
    rows = latest(df, [field], order) if order else df
    return rows.select(
        F.col(field).cast("string").alias("field"),
        F.col(value).cast("string").alias("value"),
    )


def documents(
    df: DataFrame, id_columns: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """Index documents with an id made from the row, so a replay overwrites."""
    doc_id = F.concat_ws("-", *[F.col(c).cast("string") for c in id_columns])
    return df.select(
        doc_id.alias("doc_id"), F.to_json(F.struct(*fields)).alias("document")
    )


def upsert_batch(
    open_writer: Callable[[], Writer],
    keys: Sequence[str],
    order: Sequence[str],
    batch_size: int = 1000,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: newest row per key, then bulk writes."""

    def run(batch: DataFrame, _: int) -> None:
        write_partitions(latest(batch, keys, order), open_writer, batch_size)

    return run
