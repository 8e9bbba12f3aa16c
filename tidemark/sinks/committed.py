"""A sink whose batches appear whole or not at all.

Tasks write files under names of their own. When all tasks of a batch are done, the driver
writes the list of their files once, under the batch's number, and readers take listed
files only: what a failed task, an aborted batch or a second try of a task left behind is
never read. A batch that runs again after it was committed changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

from tidemark.sinks.folder import FolderWriter

#: Rows in one request to the store.
REQUEST_ROWS = 1000


@dataclass
class Written(WriterCommitMessage):
    """The files of one task."""

    files: tuple[str, ...]


class CommittedWriter(DataSourceStreamWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator: Iterator[Row]) -> Written:
        store, held, files = FolderWriter(f"{self.folder}/data"), [], []

        def send() -> None:
            name = f"{store.base}/{uuid.uuid4().hex}.json"
            lines = "".join(json.dumps(r.asDict()) + "\n" for r in held)
            with store.store.open_output_stream(name) as f:
                f.write(lines.encode())
            files.append(name.rsplit("/", 1)[-1])
            held.clear()

        for row in iterator:
            held.append(row)
            if len(held) == REQUEST_ROWS:
                send()
        if held:
            send()
        return Written(tuple(files))

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        commits = FolderWriter(f"{self.folder}/commits")
        name = f"{commits.base}/{batchId}.json"
        if commits.store.get_file_info(name).type != fs.FileType.NotFound:
            self.abort(messages, batchId)  # this batch was committed before
            return
        listed = [{"batch": batchId, "file": f} for m in messages if m for f in m.files]
        # Readers see a list under its final name only once it is whole.
        draft = f"{commits.base}/_{batchId}.{uuid.uuid4().hex}"
        with commits.store.open_output_stream(draft) as f:
            f.write("".join(json.dumps(x) + "\n" for x in listed).encode())
        commits.store.move(draft, name)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        store = FolderWriter(f"{self.folder}/data")
        for m in messages:
            for f in m.files if m else ():
                path = f"{store.base}/{f}"
                if store.store.get_file_info(path).type != fs.FileType.NotFound:
                    store.store.delete_file(path)


class CommittedSink(DataSource):
    """``format("tidemark_committed")`` with the option ``path``, a shared folder."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_committed"

    def schema(self) -> str:
        return "value string"

    def streamWriter(self, schema, overwrite: bool) -> CommittedWriter:
        return CommittedWriter(self.options["path"])


def committed(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of all committed batches with their ``batch``.

    The lists of files are a table that is joined with the rows by their file's name, so
    neither passes through the driver.
    """
    listed = spark.read.schema("batch long, file string").json(f"{folder}/commits/*.json")
    rows = spark.read.schema(schema).json(f"{folder}/data/*.json")
    named = rows.selectExpr("*", "_metadata.file_name AS file")
    return named.join(listed, "file").drop("file")
