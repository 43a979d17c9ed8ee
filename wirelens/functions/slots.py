"""The slot of a key among those that a clustered store deals keys to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wirelens.functions.bytes import let, number

SLOTS = 16384


def crc16(raw: Column) -> Column:
    """CRC-16 (polynomial 0x1021, from 0, most significant bit first) of a binary value, as a fold over its bytes.

    A byte's eight steps are three shifts of one number, so no table is looked up.
    """

    def step(acc: Column, at: Column) -> Column:
        mixed = let(F.shiftright(acc, 8).bitwiseXOR(number(raw, at, 1).cast("int")).bitwiseAND(255), lambda x: x.bitwiseXOR(F.shiftright(x, 4)))
        return let(mixed, lambda x: F.shiftleft(acc, 8).bitwiseXOR(F.shiftleft(x, 12)).bitwiseXOR(F.shiftleft(x, 5)).bitwiseXOR(x).bitwiseAND(0xFFFF))

    size = F.octet_length(raw)
    return F.when(size == 0, 0).otherwise(F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), step))


def hash_tag(key: Column) -> Column:
    """What of a key decides on its slot: what stands between its first ``{`` and the ``}`` behind, if that is something,
    else the whole key."""
    tag = F.regexp_extract(key, r"^[^{]*\{([^}]+)\}", 1)
    return F.when(tag != "", tag).otherwise(key)


def slot(key: Column) -> Column:
    """Keys with one hash tag have one slot; null for a null key."""
    return F.pmod(crc16(F.encode(hash_tag(key), "UTF-8")), F.lit(SLOTS))
