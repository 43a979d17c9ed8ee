"""Reading packets byte by byte in the JVM; offsets count from 0, and what lies past the end is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wirelens.functions.formats import ipv4_text


def number(raw: Column, at: Column | int, size: int) -> Column:
    """A big-endian number of up to 7 bytes. ``at`` is named once: places follow from numbers, and naming each twice would double
    the work with every one that another depends on."""
    digits = F.hex(F.substring(raw, (F.lit(at) if isinstance(at, int) else at) + 1, F.lit(size)))
    # '' where bytes are missing, of which conv makes null
    return F.conv(digits if size == 1 else F.regexp_extract(digits, f"^.{{{2 * size}}}$", 0), 16, 10).cast("long")


def piece(raw: Column, at: Column | int, size: Column | int) -> Column:
    return F.substring(raw, (F.lit(at) if isinstance(at, int) else at) + 1, F.lit(size) if isinstance(size, int) else size)


def address_text(raw: Column) -> Column:
    """An IPv4 (4 bytes) or IPv6 (16 bytes) address; null for other sizes. The longest run of two or more zero groups, the
    first of equals, is left out; addresses that hold an IPv4 one end in it."""
    size = F.octet_length(raw)

    def short(groups: Column) -> Column:
        out = groups
        for n in range(2, 9):
            found = f"^(.*?)(?:^|:)0(?::0){{{n - 1}}}(?::|$)(.*)$"
            out = F.when(groups.rlike(found), F.regexp_replace(groups, found, "$1::$2")).otherwise(out)
        return out

    def v6(digits: Column) -> Column:
        groups = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.regexp_replace(F.substring(digits, i * 4 + 1, F.lit(4)), "^0{1,3}", "")), ":")
        held = (F.substring(digits, 1, 24) == "0" * 24) & (F.substring(digits, 25, 4) != "0000")
        start = F.when(F.substring(digits, 1, 24) == "0" * 20 + "ffff", "::ffff:").when(held, "::")
        return F.when(start.isNotNull(), F.concat(start, ipv4_text(F.substring(raw, 13, 4)))).otherwise(let(groups, short))

    return F.when(size == 4, ipv4_text(raw)).when(size == 16, let(F.lower(F.hex(raw)), v6))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, where plain nesting would compute it at each use."""
    return F.element_at(F.transform(F.array(value), body), 1)
