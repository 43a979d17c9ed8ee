"""Events to wide rows, metric points and full JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelens.functions.formats import utc_text
from wirelens.functions.names import DHCPV4_MESSAGES, dhcpv4_event_type, named, rcode_name, rr_type_name
from wirelens.operators.identity import event_id

HOST, INTERFACE = "capture-01", "eth0"
EVENT_TYPES = {"OBSERVED": "dns.transaction.observed", "UNANSWERED": "dns.query.unanswered", "UNMATCHED": "dns.response.unmatched"}
#: The wide table's columns with the value that an absent one has.
WIDE = {
    "event_id": "", "observed_time": "", "source_type": "", "source_host": "", "capture_interface": "", "event_type": "",
    "src_ip": "", "dst_ip": "", "src_mac": "", "message_type": "", "client_key": "", "requested_address": "",
    "assigned_address": "", "is_relayed": 0, "qname": "", "qtype": "", "qclass": 0, "rcode": "", "rtt_seconds": 0.0,
    "rtt_valid": 0, "role": "", "service_role": "", "client_ip": "", "server_ip": "",
}


def frame_of(kind: Column, seq: Column) -> Column:
    return F.concat(kind, F.lit("-"), seq.cast("string")).cast("binary")


def wide(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """The 24 columns of the wide table; what ``values`` doesn't have, or has as null, gets its default."""
    return df.select(*[F.coalesce(values[c], F.lit(d)).alias(c) if c in values else F.lit(d).alias(c) for c, d in WIDE.items()])


def dns_event_type() -> Column:
    out = F.lit(None).cast("string")
    for outcome, name in EVENT_TYPES.items():
        out = F.when(F.col("outcome") == outcome, name).otherwise(out)
    return out


def dns_values() -> dict[str, Column]:
    """The wide row's values of a transaction with leg and service_role."""
    has_query = F.col("outcome") != "UNMATCHED"
    return {
        "event_id": event_id(F.lit(HOST), F.lit(INTERFACE), F.col("observed_ns"), frame_of(F.col("kind"), F.col("seq"))),
        "observed_time": utc_text(F.col("observed_ns")),
        "source_type": F.lit("dns"),
        "source_host": F.lit(HOST),
        "capture_interface": F.lit(INTERFACE),
        "event_type": dns_event_type(),
        "src_ip": F.when(has_query, F.col("client_ip")).otherwise(F.col("server_ip")),
        "dst_ip": F.when(has_query, F.col("server_ip")).otherwise(F.col("client_ip")),
        "src_mac": F.when(has_query, F.col("mac")),
        "qname": F.when(has_query, F.col("qname")),
        "qtype": F.when(has_query, rr_type_name(F.col("qtype"))),
        "qclass": F.when(has_query, F.col("qclass")),
        "rcode": F.when(F.col("outcome") != "UNANSWERED", rcode_name(F.col("rcode"))),
        "rtt_seconds": F.when(F.col("rtt_valid") == 1, F.col("rtt_ns") / 1e9),
        "rtt_valid": F.col("rtt_valid"),
        "role": F.col("leg"),
        "service_role": F.col("service_role"),
        "client_ip": F.col("client_ip"),
        "server_ip": F.col("server_ip"),
    }


def wide_dns(tx: DataFrame) -> DataFrame:
    """Wide rows of transactions with leg and service_role. Name, type and class are those of the query, so an
    unmatched response has none; source and destination are those of the query if there is one."""
    return wide(tx, dns_values())


def dhcp_messages(wire: DataFrame) -> DataFrame:
    """The DHCP packets of the wire with the addresses that they ask for or assign."""
    number = (F.col("seq") % 200 + 1).cast("string")
    return wire.where("kind = 'dhcp'").select(
        "seq", "observed_ns", "user_id", "message", "mac",
        F.when(F.col("message") == 3, F.concat(F.lit("198.51.100."), number)).alias("requested_address"),
        F.when(F.col("message").isin(2, 5), F.concat(F.lit("198.51.100."), number)).alias("assigned_address"),
        (F.col("user_id") % 5 == 0).cast("int").alias("is_relayed"),
    )


def wide_dhcp(messages: DataFrame) -> DataFrame:
    return wide(
        messages,
        {
            "event_id": event_id(F.lit(HOST), F.lit(INTERFACE), F.col("observed_ns"), frame_of(F.lit("dhcp"), F.col("seq"))),
            "observed_time": utc_text(F.col("observed_ns")),
            "source_type": F.lit("dhcpv4"),
            "source_host": F.lit(HOST),
            "capture_interface": F.lit(INTERFACE),
            "event_type": dhcpv4_event_type(F.col("message")),
            "src_ip": F.lit("0.0.0.0"),
            "dst_ip": F.lit("255.255.255.255"),
            "src_mac": F.col("mac"),
            "message_type": F.coalesce(named(F.col("message"), DHCPV4_MESSAGES), F.lit("UNSPECIFIED")),
            "client_key": F.col("mac"),
            "requested_address": F.col("requested_address"),
            "assigned_address": F.col("assigned_address"),
            "is_relayed": F.col("is_relayed"),
        },
    )


def dimensions(values: dict[str, Column]) -> Column:
    """A map of the dimensions that have a value, in the order of their names."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in sorted(values.items())])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull() & (e["value"] != "")))


#: Dimensions that can be turned off or on, and those that are on.
OPTIONAL, USUAL = {"cf_server_ip", "cf_qtype", "cf_client_key"}, frozenset({"cf_server_ip", "cf_qtype"})


def metric_points(tx: DataFrame, dhcp: DataFrame, enabled: list[str] | None = None, chosen: frozenset[str] | set[str] = USUAL) -> DataFrame:
    """(observed_ns, name, value, dims): counts of transactions and DHCP events, and round trips in seconds.

    ``enabled`` lists the metrics to emit; none or an empty list means all. ``chosen`` names the optional dimensions that
    points have; the client's key has as many values as there are clients and is usually off.
    """
    on = lambda dims: {k: v for k, v in dims.items() if k not in OPTIONAL or k in chosen}
    observed = F.col("outcome") == "OBSERVED"
    short = {"cf_role": F.col("leg"), "cf_service_role": F.col("service_role")}
    full = on(short | {"cf_rcode": rcode_name(F.col("rcode")), "cf_qtype": rr_type_name(F.col("qtype")), "cf_server_ip": F.col("server_ip")})

    def point(name: str, value: Column, dims: dict[str, Column], when: Column) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"), dimensions(dims).alias("dims")))

    points = F.array(
        point("dns.transactions_total", F.lit(1), full, observed),
        point("dns.rtt_seconds", F.col("rtt_ns") / 1e9, full, observed & (F.col("rtt_valid") == 1)),
        point("dns.unanswered_total", F.lit(1), short, F.col("outcome") == "UNANSWERED"),
        point("dns.unmatched_total", F.lit(1), short, F.col("outcome") == "UNMATCHED"),
    )
    dns = tx.select("observed_ns", F.explode(F.array_compact(points)).alias("p")).select("observed_ns", "p.*")
    dims = {"source_type": F.lit("dhcpv4"), "cf_client_key": F.col("mac"), "cf_message_type": named(F.col("message"), DHCPV4_MESSAGES), "cf_is_relayed": F.when(F.col("is_relayed") == 1, "true").otherwise("false")}
    leases = dhcp.select("observed_ns", F.lit("dhcp.events_total").alias("name"), F.lit(1.0).alias("value"), dimensions(on(dims)).alias("dims"))
    both = dns.unionByName(leases)
    return both.where(F.col("name").isin(enabled)) if enabled else both


def sourcetype(configured: dict[str, str], source_type: Column, service_role: Column) -> Column:
    """The configured type of a source, else ``wire:<source>``; DNS events of a service role have it as a suffix."""
    own = F.lit(None).cast("string")
    for name, value in configured.items():
        own = F.when(source_type == name, value).otherwise(own)
    base = F.coalesce(own, F.concat(F.lit("wire:"), source_type))
    return F.when((source_type == "dns") & (F.coalesce(service_role, F.lit("")) != ""), F.concat(base, F.lit(":"), service_role)).otherwise(base)


def row_json(wide_rows: DataFrame) -> DataFrame:
    """(event_id, time, body): each wide row as JSON, keys in order, without values that are absent."""
    fields = [F.when(F.col(c) != F.lit(d), F.col(c)).alias(c) for c, d in sorted(WIDE.items())]
    return wide_rows.select("event_id", F.col("observed_time").alias("time"), F.to_json(F.struct(*fields)).alias("body"))
