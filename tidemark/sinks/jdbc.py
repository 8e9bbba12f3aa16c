"""Relational upsert: stage the newest row per key, then one set-based merge.

The micro-batch is written in parallel to a staging table by Spark's JDBC
writer, and applied to the target by two statements (update, then insert the
missing) in one transaction, run once per batch through the driver's JDBC.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.sinks.keyed import latest


@dataclass(frozen=True)
class Target:
    """Where rows go. ``properties`` (user, password, driver) come from the caller."""

    url: str
    table: str
    keys: tuple[str, ...]
    values: tuple[str, ...]
    properties: dict[str, str]

    def staging(self) -> str:
        return f"{self.table}_staging"


def merge_statements(target: Target) -> list[str]:
    """ANSI update-then-insert from the staging table."""
    t, s = target.table, target.staging()
    match = " AND ".join(f"s.{k} = {t}.{k}" for k in target.keys)
    sets = ", ".join(
        f"{v} = (SELECT s.{v} FROM {s} s WHERE {match})" for v in target.values
    )
    columns = ", ".join((*target.keys, *target.values))
    picked = ", ".join(f"s.{c}" for c in (*target.keys, *target.values))
    return [
        f"UPDATE {t} SET {sets} WHERE EXISTS (SELECT 1 FROM {s} s WHERE {match})",
        f"INSERT INTO {t} ({columns}) SELECT {picked} FROM {s} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {t} WHERE {match})",
    ]


def run_over_jdbc(target: Target, session) -> Callable[[list[str]], None]:
    """Run statements in one transaction with the JDBC driver Spark has loaded."""

    def run(statements: list[str]) -> None:
        jvm = session.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in target.properties.items():
            props.setProperty(k, v)
        conn = jvm.java.sql.DriverManager.getConnection(target.url, props)
        try:
            conn.setAutoCommit(False)
            for sql in statements:
                statement = conn.createStatement()
                statement.executeUpdate(sql)
                statement.close()
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        finally:
            conn.close()

    return run


def stage_over_jdbc(target: Target, max_connections: int = 32):
    def stage(rows: DataFrame) -> None:
        rows.write.option("numPartitions", max_connections).jdbc(
            target.url, target.staging(), mode="overwrite", properties=target.properties
        )

    return stage


def upsert_batch(
    target: Target,
    order: Sequence[str],
    *,
    stage: Callable[[DataFrame], None] | None = None,
    execute: Callable[[list[str]], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function. Applying a batch again leaves the same table."""

    def run(batch: DataFrame, _: int) -> None:
        rows = latest(batch, target.keys, order).select(*target.keys, *target.values)
        (stage or stage_over_jdbc(target))(rows)
        (execute or run_over_jdbc(target, batch.sparkSession))(merge_statements(target))

    return run
