"""A file-backed store for keyed writes, below a folder that all executors share.

Every bulk request is one file of JSON lines with a name of its own, so a repeated
task adds the same rows again and readers take the last version of a key.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession

from tidemark.sinks.keyed import latest


class FolderWriter:
    """Writes rows of strings and numbers; ``folder`` is a URI or an absolute path."""

    def __init__(self, folder: str):
        if folder.startswith("file:/") and not folder.startswith("file://"):
            folder = "file://" + folder[5:]
        if "://" in folder:
            self.store, self.base = fs.FileSystem.from_uri(folder)
        else:
            self.store, self.base = fs.LocalFileSystem(), folder
        self.store.create_dir(self.base, recursive=True)

    def write(self, rows: list[Row]) -> None:
        lines = "".join(json.dumps(r.asDict()) + "\n" for r in rows)
        with self.store.open_output_stream(f"{self.base}/{uuid.uuid4().hex}.json") as f:
            f.write(lines.encode())

    def close(self) -> None:
        pass


def writer(folder: str) -> Callable[[], FolderWriter]:
    return lambda: FolderWriter(folder)


def stored(spark: SparkSession, folder: str, schema: str, keys: list[str], version: list[str]) -> DataFrame:
    """What the store holds: the last version of each key."""
    return latest(spark.read.schema(schema).json(folder), keys, version)
