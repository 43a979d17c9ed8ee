"""Small helpers in Python over a column, in Arrow batches both ways."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def by_value(one: Callable, kind: T.DataType | str) -> Callable[[Column], Column]:
    """``one`` for each value of a column. Its nested results become Arrow arrays at once, where a plain UDF would convert each
    of their parts by itself, which takes as long as the decoding."""
    kind = T.DataType.fromDDL(kind) if isinstance(kind, str) else kind
    made = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def each(values: pa.Array) -> pa.Array:
        return pa.array([one(v) for v in values.to_pylist()], type=made)

    return each


def flat(fields: str) -> T.StructType:
    """A struct of plain fields, from ``name:kind,...``; unlike Spark's own reader it needs no session, so tasks can use it."""
    kinds = {"string": T.StringType(), "binary": T.BinaryType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in (part.split(":") for part in fields.split(","))])


def ends(lengths: np.ndarray) -> np.ndarray:
    """Where each of values that lie behind each other begins, and the last one's end."""
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def as_array(offsets: np.ndarray, data: pa.Buffer, kind: pa.DataType | None = None) -> pa.Array:
    """Values that lie behind each other, as bytes or text."""
    return pa.Array.from_buffers(kind or pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), data])


def laid(raw: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, where each row's begin and end, and which rows are null."""
    absent = raw.is_null().to_numpy(zero_copy_only=False)
    raw = raw.cast(pa.binary())
    at = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64) if len(raw) else np.zeros(1, np.int64)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    return data, at[:-1], np.where(absent, at[:-1], at[1:]), absent


def taken(data: np.ndarray, low: np.ndarray, high: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Pieces of the bytes; as text, malformed UTF-8 is replaced."""
    at = ends(high - low)
    raw = data[np.repeat(low - at[:-1], high - low) + np.arange(at[-1])]
    if pa.types.is_string(kind) and (raw > 127).any():
        return pa.array([bytes(raw[a:b]).decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)], kind)
    return as_array(at, pa.py_buffer(raw), kind)
