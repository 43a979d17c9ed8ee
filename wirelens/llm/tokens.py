"""Token ids of whole texts, as a byte-level BPE tokenizer file gives them."""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Texts whose characters all lie below this are split by Python's ``re``; the tokenizer itself takes the others.
LATIN = 0x250
#: Words whose ids a worker remembers; at the limit it forgets all and starts again.
CACHE_WORDS = 300_000
#: Texts are encoded in slices of about this many characters, so that long texts don't gather in memory.
SLICE_CHARS = 4_000_000


def _class(kinds: str) -> str:
    return "".join(f"\\u{c:04x}" for c in range(LATIN) if unicodedata.category(chr(c))[0] in kinds)


def _splitter() -> re.Pattern:
    letter, number, space = _class("L"), _class("N"), "\\t-\\r \\x85\\xa0"
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Words(dict):
    """Packed ids by word, filled as words are met."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        packed = self[word] = struct.pack(f"<{len(ids)}I", *ids)
        return packed


class Encoder:
    """Ids of texts, equal to those of the tokenizer file, which adds no special tokens of its own.

    Byte-pair merges stay within a word, so a word's ids are the same wherever it stands: each is merged once and
    remembered. Texts that hold the string of an added token (its id stands for it), and those outside Latin script, go
    to the tokenizer itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        added, bytes_ = {t["content"] for t in said.get("added_tokens", [])}, byte_of()
        ranks = {bytes(bytes_[c] for c in token): i for token, i in said["model"]["vocab"].items() if token not in added}
        merged = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.words = _Words(merged.encode_ordinary)
        self.split = _splitter().findall
        self.others = re.compile("|".join([f"[^\\u0000-\\u{LATIN - 1:04x}]", *map(re.escape, sorted(added))]))

    def packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if self.others.search(text):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        return b"".join(map(self.words.__getitem__, self.split(text)))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cuts(tokens: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else ``most`` tokens each but for a shorter first."""
    first = tokens if tokens <= most else tokens % most or most
    return [(0, first), *((start, most) for start in range(first, tokens, most))]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, most: int, carry: list[str], with_ids: bool = True) -> DataFrame:
    """Each document's ids, ended by ``end_id`` and cut into pieces of at most ``most``.

    Columns: ``carry``, then piece (from 0), start, length, ids_crc32 (unsigned) and, if asked for, ids. A null text
    is an empty one: its only piece is the end id.
    """
    schema = T.StructType([docs.schema[c] for c in carry])
    for name in ("piece", "start", "length", "ids_crc32"):
        schema = schema.add(name, T.IntegerType() if name == "piece" else T.LongType())
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    end = struct.pack("<I", end_id)
    width = len(carry)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = encoder(tokenizer).packed
        for batch in batches:
            at = 0
            texts = batch.column(width)
            while at < batch.num_rows:
                rows, piece, start, length, crc, buffers, chars, first = [], [], [], [], [], [], 0, at
                while at < batch.num_rows and chars < SLICE_CHARS:
                    text = texts[at].as_py() or ""
                    chars += len(text) + 100
                    ids = packed(text) + end
                    for k, (s, n) in enumerate(cuts(len(ids) // 4, most)):
                        part = ids[4 * s : 4 * (s + n)]
                        rows.append(at)
                        piece.append(k)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            buffers.append(part)
                    at += 1
                kept = batch.slice(first, at - first).take(pa.array(np.asarray(rows) - first, pa.int64()))
                columns = [*kept.columns[:width], pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                if with_ids:
                    values = np.frombuffer(b"".join(buffers), dtype="<i4")
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(values)))
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return docs.select(*carry, "text").mapInArrow(encode, schema)
