"""Frames to events: decoded messages with their key, matched, and put into one record of envelope and payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wirelens.functions.formats import duid_text, epoch_text, transaction_key
from wirelens.functions.names import DHCPV4_MESSAGES, DHCPV6_MESSAGES, dhcpv6_event_type, named
from wirelens.operators import classify, decap, dhcp, dns, project
from wirelens.operators.correlate import KEY, transactions
from wirelens.operators.identity import event_id

#: A captured packet's key: the side that the server is on counts too.
FRAME_KEY = [*KEY, "local_is_server"]
INSTANCE, METHOD = "capture-01-1", "pcap-replay"
#: An event whose JSON is longer loses its raw payloads, and is dropped if that doesn't help.
LARGEST = 8192
LEG_NAMES = {"client_facing": "DNS_LEG_CLIENT_FACING", "backend": "DNS_LEG_BACKEND", "recursion_upstream": "DNS_LEG_RECURSION_UPSTREAM", "unknown": "DNS_LEG_UNKNOWN"}
#: What parts of an event's JSON come to at most: all that has a fixed size; a warning; a question but for its name, of which a
#: character takes up to 6; a record with three names of 255; and a byte of the payload, raw and as options.
FIXED_BYTES, WARNING_BYTES, QUESTION_BYTES, RECORD_BYTES, PAYLOAD_BYTES = 4000, 200, 300, 5500, 16
#: Numbers of 64 bits, which JSON holds as strings.
LONG = {"observed_time_unix_nano", "ingest_time_unix_nano", "rtt_nanos", "packet_len", "captured_len"}


def keyed(messages: DataFrame, local: list[str], backend: list[str]) -> DataFrame:
    """Decoded DNS packets (src, dst, ``m``) with kind, rcode and the columns of their transaction's key.

    The server is the side with port 53, of two such sides the destination, of none too; so both halves of an exchange
    agree, but for those between two ports 53. Name, type and class are those of the first question.
    """
    to_server = (F.col("dst_port") == classify.DNS_PORT) | (F.col("src_port") != classify.DNS_PORT)
    q = F.get("m.questions", F.lit(0))
    sides = {f"{side}_{what}": F.when(to_server == (side == "client"), F.col(f"src_{what}")).otherwise(F.col(f"dst_{what}")) for side in ("client", "server") for what in ("ip", "port")}
    asked = {"qname": F.coalesce(q["qname"], F.lit("")), "qtype": F.coalesce(q["qtype"], F.lit(0)), "qclass": F.coalesce(q["qclass"], F.lit(0))}
    own = messages.withColumns(sides | asked | {"kind": F.when(F.col("m.qr"), "response").otherwise("query"), "rcode": F.when(F.col("m.qr"), F.col("m.rcode")), "dns_id": F.col("m.id")})
    return own.withColumn("leg", classify.leg(local, backend)).withColumn("local_is_server", F.col("leg") == "client_facing")


def dns_messages(packets: DataFrame) -> DataFrame:
    """Captured packets (seq, observed_ns, frame) on DNS ports, decoded as ``m``, which is null where there is no message.

    The filter and all below the message are native and come first. To be stored before ``m`` is asked about, as a
    condition on it would be moved below and decode twice.
    """
    return dns_payloads(packets).withColumn("m", dns.parse(F.col("message")))


def dns_payloads(packets: DataFrame) -> DataFrame:
    """What :func:`dns_messages` gives but for ``m``: captured packets on DNS ports with their ``message``."""
    captured = packets.where(decap.dns_predicate(F.col("frame")))
    return decap.dns_message(decap.decapsulated(captured)).drop("payload", "partial")


def dns_transactions(messages: DataFrame, local: list[str], backend: list[str], roles: list[tuple[int, str, str]], timeout_ns: int) -> DataFrame:
    """Transactions of decoded messages, which should be stored: keyed and matched, with leg and service role. One shuffle
    brings a key's packets together."""
    found = transactions(keyed(messages, local, backend), timeout_ns, key=FRAME_KEY, carry=["m", "packet", "message"])
    return classify.with_service_role(found, roles)


def envelope(source_type: Column | str, event_type: Column, schema: str, stream: str, frame: Column = None) -> Column:
    """The 14 values that every event begins with. Its id is that of the captured frame. When it was ingested is the
    caller's to say, in a column ``ingest_ns``; 0 stands for not at all."""
    text = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.struct(
        event_id(F.lit(project.HOST), F.lit(project.INTERFACE), F.col("observed_ns"), F.col("frame") if frame is None else frame).alias("event_id"),
        F.lit(1).alias("schema_version"), text(source_type).alias("source_type"), F.lit(project.HOST).alias("source_host"), F.lit(INSTANCE).alias("source_instance"),
        F.lit(project.INTERFACE).alias("capture_interface"), F.lit(METHOD).alias("observation_method"), F.col("observed_ns").alias("observed_time_unix_nano"),
        F.col("ingest_ns").cast("long").alias("ingest_time_unix_nano"), event_type.alias("event_type"), F.lit("VISIBILITY_PACKET_PAYLOAD").alias("visibility"),
        F.lit("OBSERVATION_CONFIDENCE_OBSERVED").alias("confidence"), F.lit(schema).alias("payload_schema"), F.lit(stream).alias("stream_name"),
    )


def _message(m: str, raw: str) -> Column:
    """A decoded DNS message as events show it."""
    header = ["id", "qr", "opcode", "aa", "tc", "rd", "ra", "ad", "cd", "rcode", "qdcount", "ancount", "nscount", "arcount"]
    record = lambda r: F.struct(
        *[r[c].alias(c) for c in ("name", "type", "type_name", "class", "ttl", "malformed")], r["rdata"].alias("rdata_raw"), r["text"].alias("rdata_text")
    )
    option = lambda o: F.struct(o["code"].alias("code"), F.octet_length(o["value"]).alias("length"), o["value"].alias("raw_value"))
    edns = F.struct(
        F.col(f"{m}.edns.udp_size").alias("udp_payload_size"), F.col(f"{m}.edns.extended_rcode").alias("extended_rcode"), F.col(f"{m}.edns.version").alias("version"),
        F.col(f"{m}.edns.do_bit").alias("do_bit"), F.transform(f"{m}.edns.options", option).alias("options"),
    )
    whole = F.struct(
        F.struct(*[F.col(f"{m}.{c}").alias(c) for c in header]).alias("header"), F.col(f"{m}.questions").alias("questions"),
        *[F.transform(f"{m}.{c}", record).alias(c) for c in ("answers", "authority", "additional")], F.when(F.col(f"{m}.edns").isNotNull(), edns).alias("edns"),
        F.col(raw).alias("raw_dns_payload"), F.lit(False).alias("raw_payload_truncated"),
    )
    return F.when(F.col(m).isNotNull(), whole)


def dns_events(tx: DataFrame, as_bytes: bool = False) -> DataFrame:
    """``tx`` (stored) with ``event``, envelope and dns_transaction, in place of what it is made of. A transaction's frame, and so its id, is the query's if there is
    one, else the response's. With ``as_bytes`` packets and messages are bytes already (:func:`wirelens.operators.payload.packed`)."""
    asks = F.col("outcome") != "UNMATCHED"
    warnings = F.concat(*[F.coalesce(F.col(c), F.array().cast("array<struct<code:string,path:string>>")) for c in ("w_query", "w_response")])
    if "ingest_ns" not in tx.columns:
        tx = tx.withColumn("ingest_ns", F.lit(0).cast("long"))
    split = tx.withColumns({"q_m": F.when(asks, F.col("m")), "q_raw": F.when(asks, F.col("message"))})
    split = split.withColumns({"w_query": F.col("q_m.warnings"), "w_response": F.col("response_m.warnings")})
    message = (lambda m, raw: F.col(raw)) if as_bytes else _message
    role = F.lit(None).cast("string")
    for leg, name in LEG_NAMES.items():
        role = F.when(F.col("leg") == leg, name).otherwise(role)
    payload = F.struct(
        F.when(asks, F.col("packet")).alias("query_packet"), F.col("response_packet"), message("q_m", "q_raw").alias("query"), message("response_m", "response_message").alias("response"),
        role.alias("role"), F.coalesce("rtt_ns", F.lit(0)).alias("rtt_nanos"), (F.col("rtt_valid") == 1).alias("rtt_valid"), transaction_key().alias("transaction_key"),
        F.col("client_ip"), F.col("client_port"), F.col("server_ip"), F.col("service_role"),
        F.transform(warnings, lambda w: F.struct(w["code"].alias("code"), w["path"].alias("field_path"))).alias("parser_warnings"),
    )
    event = F.struct(envelope("dns", project.dns_event_type(), "wire.v1.DnsTransaction", "events.dns").alias("envelope"), payload.alias("dns_transaction"))
    parts = {"m", "message", "packet", "frame", "response_m", "response_message", "response_packet"}
    return split.select(*[c for c in tx.columns if c not in parts], event.alias("event"))


def dhcp_messages(packets: DataFrame) -> DataFrame:
    """Captured packets (observed_ns, frame) on DHCP ports, decoded: ``dhcp4`` or ``dhcp6``, both null where there is no
    message, and ``family``. To be stored before these are asked about.

    Ports decide, those of version 4 first; each payload is decoded once, by its own decoder.
    """
    ports = lambda numbers: F.col("src_port").isin(*numbers) | F.col("dst_port").isin(*numbers)
    whole = (F.col("transport") == "udp") & (F.col("status") == "OK")
    family = F.when(whole & ports(decap.DHCPV4_PORTS), "dhcpv4").when(whole & ports(decap.DHCPV6_PORTS), "dhcpv6")
    seen = decap.decapsulated(packets.where(decap.dhcp_predicate(F.col("frame")))).withColumn("family", family)
    return seen.withColumns({f"dhcp{v}": parse(F.when(F.col("family") == f"dhcpv{v}", F.col("payload"))) for v, parse in ((4, dhcp.parse4), (6, dhcp.parse6))}).drop("payload")


def is_dhcp() -> Column:
    return F.col("dhcp4").isNotNull() | F.col("dhcp6").isNotNull()


def dhcp_rows(messages: DataFrame) -> DataFrame:
    """Wide rows of decoded DHCP messages (stored) of both versions. A client of version 6 is known by its DUID in hex, of at most
    131 bytes."""
    is4 = F.col("family") == "dhcpv4"
    v6_type = F.coalesce(named(F.col("dhcp6.message"), DHCPV6_MESSAGES), F.lit("UNSPECIFIED"))
    frame = event_id(F.lit(project.HOST), F.lit(project.INTERFACE), F.col("observed_ns"), F.col("frame"))
    return project.wide(
        messages.where(is_dhcp()).withColumns(dhcp.interpretation("dhcp4")),
        {
            "event_id": frame, "observed_time": project.utc_text(F.col("observed_ns")), "source_type": F.col("family"), "source_host": F.lit(project.HOST),
            "capture_interface": F.lit(project.INTERFACE), "event_type": F.when(is4, F.col("event_type")).otherwise(dhcpv6_event_type(F.col("dhcp6.message"))),
            "src_ip": F.col("src_ip"), "dst_ip": F.col("dst_ip"), "src_mac": F.col("src_mac"),
            "message_type": F.when(is4, F.coalesce(named(F.col("dhcp4.message"), DHCPV4_MESSAGES), F.lit("UNSPECIFIED"))).otherwise(v6_type),
            "client_key": F.when(is4, F.col("client_key")).otherwise(duid_text(F.col("dhcp6.client_duid"))),
            "requested_address": F.when(is4, F.col("dhcp4.requested_address")),
            "assigned_address": F.when(is4, F.col("lease_address")).otherwise(F.get("dhcp6.addresses", F.lit(0))),
            "is_relayed": F.when(is4, F.col("is_relayed")).otherwise(F.col("dhcp6.message").isin(12, 13)).cast("int"),
        },
    )


def counters(packets: DataFrame, messages: DataFrame) -> DataFrame:
    """(family, formatted, skipped, warnings) of captured packets (seq) and their decoded messages (stored); family is ''
    for packets that are no DHCP message.

    A skipped packet is one that passes no decoder: not UDP, cut, on other ports, or too short.
    """
    found = messages.where(is_dhcp()).select("seq", "family", F.size(F.coalesce("dhcp4.warnings", "dhcp6.warnings")).alias("w"))
    whole = packets.select("seq").join(found, "seq", "left")
    return whole.groupBy(F.coalesce("family", F.lit("")).alias("family")).agg(
        F.count("family").alias("formatted"), F.count_if(F.col("family").isNull()).alias("skipped"), F.coalesce(F.sum("w"), F.lit(0)).alias("warnings")
    )


def shown(value: Column, kind: T.DataType, name: str = "") -> Column:
    """A value as JSON shows it: names in order, defaults left out (null), 64-bit numbers as text, bytes in base64."""
    if isinstance(kind, T.StructType):
        fields = [shown(value[f.name], f.dataType, f.name).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        inner = (lambda x: shown(x, kind.elementType)) if isinstance(kind.elementType, T.StructType) else (lambda x: F.base64(x) if isinstance(kind.elementType, T.BinaryType) else x)
        return F.when(F.size(value) > 0, F.transform(value, inner))
    if isinstance(kind, T.BinaryType):
        return F.when(F.octet_length(value) > 0, F.base64(value))
    if isinstance(kind, T.StringType):
        return F.when(value != "", value)
    if isinstance(kind, T.BooleanType):
        return F.when(value, value)
    return F.when(value != 0, value.cast("string") if name in LONG else value)


def event_json(events: DataFrame) -> Column:
    return F.to_json(shown(F.col("event"), events.schema["event"].dataType))


def _most_bytes() -> Column:
    """No DNS event's JSON is longer than this: a fixed part, parts of questions, bytes and warnings by their lengths, and what a
    record may come to, whose compressed names can be far longer than its bytes."""
    most = F.lit(FIXED_BYTES) + WARNING_BYTES * F.coalesce(F.size("event.dns_transaction.parser_warnings"), F.lit(0))
    for side in ("query", "response"):
        message = F.col(f"event.dns_transaction.{side}")
        asked = F.aggregate(message["questions"], F.lit(0), lambda n, q: n + QUESTION_BYTES + 6 * F.char_length(q["qname"]))
        records = F.size(message["answers"]) + F.size(message["authority"]) + F.size(message["additional"])
        most += F.coalesce(asked + RECORD_BYTES * records + PAYLOAD_BYTES * F.octet_length(message["raw_dns_payload"]), F.lit(0))
    return most


def capped(events: DataFrame, largest: int = LARGEST) -> DataFrame:
    """Stored ``events`` of DNS whose JSON has at most ``largest`` bytes. Longer ones lose their raw payloads and say so;
    those that would still be longer are left out. The record has no wire form here, so its JSON is what is measured; it
    is only made of events that may be too long (:func:`_most_bytes`)."""
    raw = lambda side: F.coalesce(F.ceil(F.octet_length(f"event.dns_transaction.{side}.raw_dns_payload") / 3) * 4, F.lit(0))
    sized = events.withColumns({"_size": F.when(_most_bytes() > largest, F.octet_length(event_json(events))).otherwise(0), "_raw": raw("query") + raw("response")})
    fits = sized.where((F.col("_size") <= largest) | (F.col("_size") - F.col("_raw") <= largest))
    less = F.col("event")
    for side in ("query", "response"):
        message = F.col(f"event.dns_transaction.{side}")
        cut = message.withField("raw_dns_payload", F.lit(None).cast("binary")).withField("raw_payload_truncated", F.lit(True))
        less = less.withField(f"dns_transaction.{side}", F.when(message.isNotNull(), cut))
    return fits.withColumn("event", F.when(F.col("_size") > largest, less).otherwise(F.col("event"))).drop("_size", "_raw")


def collector_lines(events: DataFrame, configured: dict[str, str] | None = None) -> DataFrame:
    """(event_id, line): each event as a collector takes it, with host, source, sourcetype and time around it."""
    e = F.col("event")["envelope"]
    role = F.col("event.dns_transaction.service_role") if "dns_transaction" in events.schema["event"].dataType.names else F.lit("")
    kind = project.sourcetype(configured or {}, e["source_type"], role)
    around = F.to_json(F.struct(e["source_host"].alias("host"), e["stream_name"].alias("source"), kind.alias("sourcetype")))
    line = F.concat(F.lit('{"event":'), event_json(events), F.lit(","), F.substring(around, 2, F.length(around) - 2), F.lit(',"time":'), epoch_text(e["observed_time_unix_nano"]), F.lit("}"))
    return events.select(e["event_id"].alias("event_id"), line.alias("line"))


def wide_rows(events: DataFrame) -> DataFrame:
    """Wide rows of DNS events: addresses are those of the query's packet if there is one, names those of the query."""
    has = F.col("outcome") != "UNMATCHED"
    packet = lambda part, name: F.when(has, F.col(f"event.dns_transaction.query_packet.{part}.{name}")).otherwise(F.col(f"event.dns_transaction.response_packet.{part}.{name}"))
    rows = events.withColumns({"mac": packet("link", "src_mac"), "own_id": F.col("event.envelope.event_id")})
    values = project.dns_values() | {"event_id": F.col("own_id"), "src_mac": F.col("mac"), "src_ip": packet("network", "src_ip"), "dst_ip": packet("network", "dst_ip")}
    return project.wide(rows, values)
