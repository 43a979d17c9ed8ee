"""Names of protocol numbers."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that the wire protocols assign to numbers.
RCODES = {
    0: "NOERROR", 1: "FORMERR", 2: "SERVFAIL", 3: "NXDOMAIN", 4: "NOTIMP", 5: "REFUSED", 6: "YXDOMAIN", 7: "YXRRSET",
    8: "NXRRSET", 9: "NOTAUTH", 10: "NOTZONE", 16: "BADVERS",
}
RR_TYPES = {
    1: "A", 2: "NS", 5: "CNAME", 6: "SOA", 12: "PTR", 13: "HINFO", 15: "MX", 16: "TXT", 17: "RP", 24: "SIG", 25: "KEY",
    28: "AAAA", 29: "LOC", 33: "SRV", 35: "NAPTR", 39: "DNAME", 41: "OPT", 43: "DS", 46: "RRSIG", 47: "NSEC", 48: "DNSKEY",
    50: "NSEC3", 51: "NSEC3PARAM", 52: "TLSA", 59: "CDS", 60: "CDNSKEY", 64: "SVCB", 65: "HTTPS", 252: "AXFR", 255: "ANY",
    257: "CAA",
}
DHCPV4_MESSAGES = {
    1: "DISCOVER", 2: "OFFER", 3: "REQUEST", 4: "DECLINE", 5: "ACK", 6: "NAK", 7: "RELEASE", 8: "INFORM", 9: "FORCERENEW",
    10: "LEASEQUERY", 11: "LEASEUNASSIGNED", 12: "LEASEUNKNOWN", 13: "LEASEACTIVE",
}
DHCPV6_MESSAGES = {
    1: "SOLICIT", 2: "ADVERTISE", 3: "REQUEST", 4: "CONFIRM", 5: "RENEW", 6: "REBIND", 7: "REPLY", 8: "RELEASE", 9: "DECLINE",
    10: "RECONFIGURE", 11: "INFORMATION_REQUEST", 12: "RELAY_FORW", 13: "RELAY_REPL", 14: "LEASEQUERY",
    15: "LEASEQUERY_REPLY", 16: "LEASEQUERY_DONE", 17: "LEASEQUERY_DATA",
}


def named(number: Column, table: dict[int, str]) -> Column:
    """The number's name, or null."""
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(entries, number.cast("int"))


def rcode_name(number: Column) -> Column:
    return F.coalesce(named(number, RCODES), number.cast("string"))


def rr_type_name(number: Column) -> Column:
    return F.coalesce(named(number, RR_TYPES), F.concat(F.lit("TYPE"), number.cast("string")))


def dhcpv4_event_type(message: Column) -> Column:
    return F.concat(F.lit("dhcpv4."), F.coalesce(F.lower(named(message, DHCPV4_MESSAGES)), F.lit("packet")), F.lit(".observed"))


def dhcpv6_event_type(message: Column) -> Column:
    """Lease queries have no event type of their own."""
    own = {k: v.lower().replace("_", "-") for k, v in DHCPV6_MESSAGES.items() if k < 14}
    return F.concat(F.lit("dhcpv6."), F.coalesce(named(message, own), F.lit("packet")), F.lit(".observed"))
