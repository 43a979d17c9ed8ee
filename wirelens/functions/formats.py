"""Texts of times, addresses and transaction keys; epoch nanoseconds stay BIGINT, as timestamps hold microseconds only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NANO = 1_000_000_000


def epoch_text(ns: Column) -> Column:
    """``seconds.nnnnnnnnn``, sign and magnitude."""
    size = F.abs(ns)
    sign = F.when(ns < 0, "-").otherwise("")
    return F.concat(sign, (size - size % NANO).cast("decimal(38,0)").__truediv__(NANO).cast("long").cast("string"), F.lit("."), F.lpad((size % NANO).cast("string"), 9, "0"))


def utc_text(ns: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS.nnnnnnnnn`` in UTC (the session's time zone must be UTC); seconds round down."""
    rest = F.pmod(ns, F.lit(NANO))
    seconds = F.expr("bigint(0)") + ((ns - rest).cast("decimal(38,0)") / NANO).cast("long")
    return F.concat(F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss"), F.lit("."), F.lpad(rest.cast("string"), 9, "0"))


def entry_time(entry_id: Column) -> Column:
    """The milliseconds at the front of an entry id ``<ms>-<n>``; null if it has another form."""
    return F.when(entry_id.rlike(r"^\d{1,18}-\d+$"), F.split(entry_id, "-")[0].cast("long"))


def mac_text(raw: Column) -> Column:
    """Six bytes as ``aa:bb:cc:dd:ee:ff``."""
    return F.regexp_replace(F.lower(F.hex(raw)), "(..)(?=.)", "$1:")


def ipv4_text(raw: Column) -> Column:
    octets = [F.conv(F.hex(F.substring(raw, i, 1)), 16, 10) for i in range(1, 5)]
    return F.concat_ws(".", *octets)


def duid_text(raw: Column) -> Column:
    """Lower-case hex of at most 131 bytes."""
    return F.lower(F.hex(F.substring(raw, 1, 131)))


def transaction_key() -> Column:
    """A transaction's key from the key columns."""
    return F.format_string(
        "%s %s:%d->%s:%d id=%d %s/%d/%d", "transport", "client_ip", "client_port", "server_ip", "server_port", "dns_id", "qname", "qtype", "qclass"
    )
