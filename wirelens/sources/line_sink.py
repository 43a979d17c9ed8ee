"""Lines of a stream delivered once: a streaming sink with a commit for each micro-batch."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from wirelens.sources.pcap_source import located

NAME = "metric_lines"
#: Why a line isn't taken.
EMPTY, LONG, NO_JSON = "empty", "too long", "no JSON object"
MOST_BYTES = 1 << 20


def rejection(line: str | None, most: int = MOST_BYTES) -> str | None:
    """Why a receiver of JSON lines would never take this one; None if it would."""
    if not line:
        return EMPTY
    if len(line.encode()) > most:
        return LONG
    try:
        return None if isinstance(json.loads(line), dict) else NO_JSON
    except ValueError:
        return NO_JSON


@dataclass
class Staged(WriterCommitMessage):
    """Files of one task: lines to deliver and rejected ones, with the folder that they wait in."""

    folder: str
    names: list[str]


class Writer(DataSourceStreamArrowWriter):
    """Tasks write what they have to a folder of the run; the commit of a micro-batch moves the files of the attempts that
    count to the batch's own folder, by one rename of a folder that isn't there yet."""

    def __init__(self, options: dict):
        self.path, self.most, self.run = options["path"], int(options.get("mostbytes", MOST_BYTES)), uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, place = located(self.path)
        names: dict[bool, str] = {}
        files: dict[bool, pa.NativeFile] = {}
        try:
            for batch in iterator:
                for line in batch.column("line").to_pylist():
                    why = rejection(line, self.most)
                    bad = why is not None
                    if bad not in files:
                        store.create_dir(f"{place}/_{self.run}", recursive=True)
                        names[bad] = f"{'rejected' if bad else 'part'}-{uuid.uuid4().hex}.jsonl"
                        files[bad] = store.open_output_stream(f"{place}/_{self.run}/{names[bad]}")
                    files[bad].write((json.dumps({"reason": why, "payload": line}) if bad else line.replace("\n", " ")).encode() + b"\n")
        finally:
            for file in files.values():
                file.close()
        return Staged(f"{place}/_{self.run}", list(names.values()))

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        store, place = located(self.path)
        done = f"{place}/batch={batchId}"
        if store.get_file_info(done).type == fs.FileType.NotFound:  # else the batch was delivered before the query was lost
            ready = f"{place}/_{self.run}-{batchId}"
            store.create_dir(ready, recursive=True)
            for message in messages:
                for name in message.names if message else ():
                    store.move(f"{message.folder}/{name}", f"{ready}/{name}")
            store.move(ready, done)
        self.abort(messages, batchId)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        """What waits goes, that of lost attempts too; a path belongs to one query."""
        store, place = located(self.path)
        if store.get_file_info(place).type == fs.FileType.Directory:
            for found in store.get_file_info(fs.FileSelector(place)):
                if found.type == fs.FileType.Directory and found.base_name.startswith("_"):
                    store.delete_dir(found.path)


class LineSink(DataSource):
    """``df.writeStream.format("metric_lines").start(path)`` for a column ``line`` of JSON objects.

    A micro-batch is in ``path``/batch=<n> whole or not at all: ``part-*`` hold its lines, ``rejected-*`` what no receiver would take,
    with the reason. A batch that runs again after the query was lost, or whose tasks were tried several times, is delivered once;
    what lost attempts wrote is in no batch. ``mostBytes`` bounds a line. A receiver reads whole batches in their order.

    Cases: null and empty lines are rejected; a line break inside a line becomes a blank. The path is shared by driver and
    executors, and its store renames folders at once, as a file system does; object stores don't.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamWriter(self, schema, overwrite: bool) -> Writer:
        return Writer({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(LineSink)
