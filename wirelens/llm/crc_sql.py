"""CRC-32 in DuckDB SQL, for oracles of operators that draw rows by it."""

from __future__ import annotations

#: A common table expression ``crc`` of one row: the 256 remainders of a byte.
CRC_TABLE = """crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce([n::UBIGINT] || list_transform(range(8), lambda k: k::UBIGINT),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS v)"""


def crc32_of(text: str) -> str:
    """The unsigned CRC-32 of the UTF-8 bytes of ``text``, whose characters lie below U+0100, where ``crc`` is joined."""
    octets = f"flatten(list_transform(string_split({text}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::UBIGINT] ELSE [(192 + unicode(x) // 64)::UBIGINT, (128 + unicode(x) % 64)::UBIGINT] END))"
    return f"xor(list_reduce([4294967295::UBIGINT] || {octets}, lambda c, b: xor(c >> 8, crc.v[(xor(c & 255, b) + 1)::BIGINT])), 4294967295)"
