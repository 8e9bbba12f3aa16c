"""Session set-up and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import tidemark

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the library relies on.

    Leave ``master`` unset on a cluster so that spark-submit decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created.

    Event times are UTC throughout, and ``transformWithState`` needs the
    RocksDB state store. Functions of this package travel to the workers by
    value, so the package need not be installed on them.
    """
    cloudpickle.register_pickle_by_value(tidemark)
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A session that names none gets a folder below the warehouse, which is
    shared storage on a cluster; never a machine's own temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        named = f"{warehouse}/_checkpoints"
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, one per call."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"
