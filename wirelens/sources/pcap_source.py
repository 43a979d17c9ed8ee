"""Classic pcap as a Spark data source: files read in byte ranges, in batch or as a stream, and written by tasks."""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

from wirelens.sources.pcap import ETHERNET, MAGIC, MOST, SNAPLEN, TRUNCATED

NAME = "capture"
SCHEMA = "path string, offset long, observed_ns long, packet_len int, captured_len int, flags int, frame binary, error string"
ARROW = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("observed_ns", pa.int64()), ("packet_len", pa.int32()), ("captured_len", pa.int32()), ("flags", pa.int32()), ("frame", pa.binary()), ("error", pa.string())])
HEADER, RECORD = 24, 16
RANGE_BYTES, FILES_A_BATCH, BATCH_ROWS = 64 << 20, 1000, 8192
#: Bytes read at a time, and bytes in which a first record is looked for at a time.
BUFFER, WINDOW = 4 << 20, 1 << 20
#: So many headers in a row, or all up to the end of the file, have to be plausible where a range begins: packets of at
#: most LARGEST bytes, captured within so many seconds of the file's first one.
CHAIN, LARGEST, YEARS = 6, 262_144, 10 * 366 * 86_400


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a local path or of a URI that Arrow knows (file, hdfs, s3, gs)."""
    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(path: str) -> list[tuple[str, int]]:
    """Names and sizes of the capture at ``path``, or of those in it that don't begin with ``_`` or a dot, by name."""
    store, place = located(path)
    found = store.get_file_info(place)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if found.type == fs.FileType.File:
        return [(path, found.size)]
    files = [f for f in store.get_file_info(fs.FileSelector(place)) if f.type == fs.FileType.File and f.base_name[0] not in "_."]
    return sorted((f"{path.rstrip('/')}/{f.base_name}", f.size) for f in files)


@dataclass
class Range(InputPartition):
    """Records of a file whose headers begin in [start, stop)."""

    path: str
    start: int
    stop: int
    size: int


def ranges(files: list[tuple[str, int]], width: int) -> list[Range]:
    return [Range(path, at, min(size, at + width), size) for path, size in files for at in range(0, max(size, 1), width)]


class Capture:
    """A capture file of which any place is read through a buffer."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file, self.size, self.at, self.held = file, size, 0, b""
        head = self.bytes(0, HEADER)
        found = MAGIC.get(head[:4])
        self.error = None if found and len(head) == HEADER else "no classic pcap file"
        self.order, self.unit = found or ("<", 1)
        if not self.error and struct.unpack_from(self.order + "I", head, 20)[0] != ETHERNET:
            self.error = "no Ethernet capture"
        self.began = struct.unpack(self.order + "I", self.bytes(HEADER, 4))[0] if size >= HEADER + 4 else 0

    def bytes(self, at: int, length: int) -> bytes:
        """Up to ``length`` bytes, fewer at the end."""
        if at < self.at or at + length > self.at + len(self.held):
            self.at, self.held = at, self.file.read_at(min(max(length, BUFFER), max(0, self.size - at)), at)
        return self.held[at - self.at : at - self.at + length]

    def _plausible(self, at: int) -> int | None:
        """Where the record with a header at ``at`` ends, if it is one."""
        head = self.bytes(at, RECORD)
        if len(head) < RECORD:
            return None
        seconds, fraction, captured, length = struct.unpack(self.order + "4I", head)
        good = abs(seconds - self.began) <= YEARS and fraction * self.unit < 1_000_000_000 and 0 < captured <= length <= LARGEST
        return at + RECORD + captured if good else None

    def _chain(self, at: int) -> int:
        """How many records in a row stand at ``at``: ``CHAIN`` if as many or if they lead to the file's very end, the
        number before a record that the file's end cuts, or -1 if something else follows."""
        for k in range(CHAIN):
            end = self._plausible(at)
            if end is None:
                return -1
            if end >= self.size:
                return CHAIN if end == self.size else k
            if end + RECORD > self.size:
                return k + 1
            at = end
        return CHAIN

    def first_record(self, start: int) -> int:
        """The first place from ``start`` on at which a chain of records begins; the file's size if there is none.

        Bytes of a window are tested all at once for the length fields, what is left by following the chain. Where the
        file's end cuts a record, the place with the most records before it counts.
        """
        start, best = max(start, HEADER), (0, self.size)
        while start < self.size:
            raw = np.frombuffer(self.bytes(start, WINDOW + RECORD), np.uint8)
            n = len(raw) - RECORD + 1
            if n <= 0:
                break
            number = [raw[8 + k : 8 + k + n].astype(np.int64) for k in range(8)]
            if self.order == "<":
                number = [number[k] for k in (3, 2, 1, 0, 7, 6, 5, 4)]
            captured, length = ((number[k] << 24) + (number[k + 1] << 16) + (number[k + 2] << 8) + number[k + 3] for k in (0, 4))
            for at in np.flatnonzero((captured > 0) & (captured <= length) & (length <= LARGEST)).tolist():
                chain = self._chain(start + at)
                if chain == CHAIN:
                    return start + at
                best = (chain, start + at) if chain > best[0] else best
            start += n
        return best[1]

    def records(self, start: int, stop: int) -> Iterator[tuple]:
        """(offset, ns, length, captured, flags, frame, error) of the records that begin in [start, stop)."""
        if self.error:
            if start == 0:
                yield 0, None, None, None, None, None, self.error
            return
        at = HEADER if start <= HEADER else self.first_record(start)
        stop, behind = min(stop, self.size), None
        while True:
            if at >= stop:
                behind = self.first_record(stop) if behind is None else behind
                if at in (behind, self.size):
                    return
                if at > behind:
                    yield at, None, None, None, None, None, "the next range begins elsewhere"
                    return
                stop = behind  # records that the next range doesn't know as such
            head = self.bytes(at, RECORD)
            if len(head) < RECORD:
                yield at, None, None, None, None, None, "truncated record header"
                return
            seconds, fraction, captured, length = struct.unpack(self.order + "4I", head)
            if captured > MOST or at + RECORD + captured > self.size:
                yield at, None, None, None, None, None, "record too long"
                return
            kept = min(captured, SNAPLEN)
            cut = TRUNCATED if captured > SNAPLEN or captured < length else 0
            yield at, seconds * 1_000_000_000 + fraction * self.unit, length, kept, cut, self.bytes(at + RECORD, kept), None
            at += RECORD + captured


def read(part: Range) -> Iterator[pa.RecordBatch]:
    store, place = located(part.path)
    with store.open_input_file(place) as file:
        rows: list[tuple] = []
        for row in Capture(file, part.size).records(part.start, part.stop):
            rows.append((part.path, *row))
            if len(rows) == BATCH_ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ARROW.types, strict=True)], schema=ARROW)


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.width = options["path"], int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[Range]:
        return ranges(listed(self.path), self.width)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read(partition)


class StreamReader(DataSourceStreamReader):
    """New files of a folder, by name: the offset is the last name that was read, and files come at most so many a batch."""

    def __init__(self, options: dict):
        self.path, self.width = options["path"], int(options.get("rangebytes", RANGE_BYTES))
        self.most, self.last = int(options.get("filesperbatch", FILES_A_BATCH)), ""

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        new = [path for path, _ in listed(self.path) if path > self.last][: self.most]
        self.last = new[-1] if new else self.last
        return {"after": self.last}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.last = max(self.last, end["after"])
        return ranges([f for f in listed(self.path) if start["after"] < f[0] <= end["after"]], self.width)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read(partition)


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class Writer(DataSourceArrowWriter):
    """A file for each task that has packets. Tasks write to a folder that readers don't list; the commit moves the files
    of those attempts that count, so what lost tasks leave is never seen."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.run = options["path"], overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, place = located(self.path)
        name, file = f"part-{uuid.uuid4().hex}.pcap", None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if file is None:
                    store.create_dir(f"{place}/_{self.run}", recursive=True)
                    file = store.open_output_stream(f"{place}/_{self.run}/{name}", buffer_size=BUFFER)
                    file.write(bytes.fromhex("4d3cb2a1") + struct.pack("<HHiIII", 2, 4, 0, 0, LARGEST, ETHERNET))
                times, frames = batch.column("observed_ns").to_pylist(), batch.column("frame").to_pylist()
                lengths = batch.column("packet_len").to_pylist() if "packet_len" in batch.schema.names else [None] * len(frames)
                out = bytearray()
                for ns, frame, length in zip(times, frames, lengths, strict=True):
                    if ns is not None and frame:
                        out += struct.pack("<4I", ns // 1_000_000_000, ns % 1_000_000_000, len(frame), max(length or 0, len(frame))) + frame
                file.write(bytes(out))
        finally:
            if file is not None:
                file.close()
        return Written(name if file is not None else None)

    def commit(self, messages: list[Written | None]) -> None:
        store, place = located(self.path)
        store.create_dir(place, recursive=True)
        if self.overwrite:
            for path, _ in listed(self.path):
                store.delete_file(located(path)[1])
        for message in messages:
            if message and message.name:
                store.move(f"{place}/_{self.run}/{message.name}", f"{place}/{message.name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        store, place = located(self.path)
        if store.get_file_info(f"{place}/_{self.run}").type == fs.FileType.Directory:
            store.delete_dir(f"{place}/_{self.run}")


class CaptureSource(DataSource):
    """``spark.read.format("capture").load(path)``, ``readStream`` alike, and ``df.write.format("capture").save(path)``.

    Reading gives ``SCHEMA``: a row for each packet, whose place in its file is ``offset``. A file is cut into ranges of
    ``rangeBytes``, so its size has no limit and a large one is read by many tasks. Records have no marks to begin at: a range
    looks for the first place from which a chain of plausible headers leads on, and the range before tells, by where
    its own chain ends, that it is the right one.

    Cases: a file that is none, and a record that can't be read, give a row with ``error``; behind a broken record reading
    goes on in the next range. Ranges that disagree, as where a packet holds a capture of its own, give an error row too;
    ``rangeBytes`` above the file's size reads it as a whole. Frames are cut at ``SNAPLEN``. Files whose names begin with ``_``
    or a dot aren't read. As a stream, files have to be whole when they appear, under names that sort behind those before, as
    rotating captures have them; ``filesPerBatch`` bounds a batch, and the offset is one name.

    Writing takes ``observed_ns``, ``frame`` and, if there is one, ``packet_len``; rows without time or frame, which a capture
    can't hold, are left out. Paths are local ones or URIs that Arrow opens, shared by driver and executors.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> dict:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> Reader:
        return Reader(self._options())

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(self._options())

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self._options(), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(CaptureSource)
