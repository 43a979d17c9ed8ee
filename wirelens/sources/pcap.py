"""Classic pcap files as a table of packets."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "path string, arrival_seq long, observed_ns long, packet_len int, captured_len int, flags int, frame binary, error string"
SNAPLEN, MOST, ETHERNET, TRUNCATED = 2048, 16 << 20, 1, 1
# A file's magic number, as it stands in the file: byte order and nanoseconds in a unit of its fractions.
MAGIC = {
    bytes.fromhex("d4c3b2a1"): ("<", 1000), bytes.fromhex("a1b2c3d4"): (">", 1000),
    bytes.fromhex("4d3cb2a1"): ("<", 1), bytes.fromhex("a1b23c4d"): (">", 1),
}


def records(raw: bytes) -> Iterator[tuple]:
    """(seq, ns, length, captured, flags, frame, error) of each packet; what can't be read ends the file with an error."""
    found = MAGIC.get(raw[:4])
    if found is None or len(raw) < 24:
        yield 0, None, None, None, None, None, "no classic pcap file"
        return
    order, unit = found
    if struct.unpack_from(order + "I", raw, 20)[0] != ETHERNET:
        yield 0, None, None, None, None, None, "no Ethernet capture"
        return
    pos, seq = 24, 0
    while pos < len(raw):
        if pos + 16 > len(raw):
            yield seq, None, None, None, None, None, "truncated record header"
            return
        seconds, fraction, captured, length = struct.unpack_from(order + "4I", raw, pos)
        if captured > MOST or pos + 16 + captured > len(raw):
            yield seq, None, None, None, None, None, "record too long"
            return
        frame = raw[pos + 16 : pos + 16 + min(captured, SNAPLEN)]
        cut = TRUNCATED if captured > SNAPLEN or captured < length else 0
        yield seq, seconds * 1_000_000_000 + fraction * unit, length, len(frame), cut, frame, None
        pos, seq = pos + 16 + captured, seq + 1


def read_pcap(spark: SparkSession, path: str) -> DataFrame:
    """The packets of all files at ``path``; a file is read by one task, as its records have no marks to begin at.

    A file that can't be read, or that ends badly, gives a row with ``error`` after its good packets.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                for row in records(bytes(content)):
                    rows.append((name, *row))
                    if len(rows) == 10_000:
                        yield _frame(rows)
                        rows = []
                yield _frame(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, SCHEMA)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    whole = pd.DataFrame(rows, columns=names, dtype=object)
    return whole.astype({"arrival_seq": "int64", "observed_ns": "Int64", "packet_len": "Int32", "captured_len": "Int32", "flags": "Int32"})
