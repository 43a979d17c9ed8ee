"""Decoding of messages with many options and record kinds, made from every event, against the values they were made of."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelens.functions.names import RR_TYPES
from wirelens.operators import decap, dhcp, dns, events
from wirelens.operators.dhcp import RELAY_NAMES
from wirelens.sources import rich_frames
from wirelens.sources.tables import stored


def _listed(column: str | Column, show: Callable[[Column], Column], by: str = ";") -> Column:
    return F.coalesce(F.array_join(F.transform(column, show), by), F.lit(""))


def _warnings(d: str) -> Column:
    return _listed(f"{d}.warnings", lambda w: F.concat_ws("@", w["code"], w["path"]))


def _dhcp4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every decoded value of a DHCPv4 message, and what it means."""
    frames = rich_frames.dhcp4(rich_frames.rows(spark, sf_dir))
    d = stored(decap.decapsulated(frames).select("seq", dhcp.parse4(F.col("payload")).alias("dhcp")), "messages").withColumns(dhcp.interpretation())
    plain = ["xid", "flags", "ciaddr", "yiaddr", "giaddr", "chaddr_mac", "sname", "file", "message", "subnet_mask", "hostname", "domain", "requested_address", "lease_seconds", "server_id", "text", "max_size", "t1", "t2", "class_id", "client_id_text", "tftp_server", "boot_file", "proxy", "fqdn_flags", "fqdn_rcode1", "fqdn_rcode2", "fqdn"]
    pairs = lambda c: _listed(c, lambda x: F.concat_ws("=", x["code"].cast("string"), x["text"]), ",")
    routes = lambda c: _listed(c, lambda r: F.concat_ws(">", r["destination"], r["router"]))
    return d.select(
        "seq", *[F.col(f"dhcp.{c}").alias(c) for c in plain], F.array_join("dhcp.routers", ",").alias("routers"), F.array_join("dhcp.dns_servers", ",").alias("dns_servers"), F.array_join(F.col("dhcp.parameters").cast("array<string>"), ",").alias("parameters"),
        F.lower(F.hex("dhcp.client_id")).alias("client_id"), pairs("dhcp.vendor.suboptions").alias("vendor"), F.col("dhcp.vendor.success").alias("vendor_ok"), _listed("dhcp.vendor.warnings", lambda w: w["code"]).alias("vendor_warnings"), pairs("dhcp.relay.suboptions").alias("relay"),
        _listed("dhcp.relay.suboptions", lambda x: x["name"], ",").alias("relay_names"), F.col("dhcp.relay.circuit_id").alias("circuit"), F.col("dhcp.relay.remote_id").alias("remote"), F.col("dhcp.relay.subscriber_id").alias("subscriber"),
        F.array_join("dhcp.search", ",").alias("search"), routes("dhcp.routes").alias("routes"), routes("dhcp.microsoft_routes").alias("microsoft_routes"), F.size("dhcp.options").alias("n_options"), F.size(F.filter("dhcp.options", lambda o: o["fragment"])).alias("n_fragments"),
        _listed(F.filter("dhcp.options", lambda o: o["source"] != "raw_options"), lambda o: F.concat_ws(":", o["source"], o["code"].cast("string")), ",").alias("overloaded"), _warnings("dhcp").alias("warnings"),
        "event_type", "client_key", "transaction_key", "lease_address", "is_relayed", "is_broadcast", "is_renewal", "is_rebind",
    )


def _dhcp6(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = rich_frames.dhcp6(rich_frames.rows(spark, sf_dir))
    d = stored(decap.decapsulated(frames).select("seq", "vlan_ids", "src_ip", "dst_ip", dhcp.parse6(F.col("payload")).alias("d")), "messages")
    return d.select(
        "seq", F.array_join(F.col("vlan_ids").cast("array<string>"), ",").alias("vlans"), "src_ip", "dst_ip", *[F.col(f"d.{c}").alias(c) for c in ("message", "transaction_id", "hop_count", "link_address", "peer_address", "vendor_class_enterprise", "vendor_class")],
        events.duid_text(F.col("d.client_duid")).alias("client"), F.lower(F.hex("d.server_duid")).alias("server"), F.array_join(F.col("d.requested").cast("array<string>"), ",").alias("requested"), F.array_join("d.addresses", ",").alias("addresses"),
        _listed("d.vendor", lambda v: F.concat_ws(":", v["enterprise"].cast("string"), v["code"].cast("string"), F.lower(F.hex(v["value"]))), ",").alias("vendor"), F.size("d.options").alias("n_options"), _warnings("d").alias("warnings"),
    )


def _dns(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = rich_frames.dns(rich_frames.rows(spark, sf_dir))
    d = stored(decap.dns_message(decap.decapsulated(frames)).select("seq", "vlan_ids", "ip_version", "src_ip", "dst_ip", "dst_port", dns.parse(F.col("message")).alias("m")), "messages")
    record = lambda r: F.concat_ws(" ", r["name"], r["type_name"], r["ttl"].cast("string"), r["text"])
    return d.select(
        "seq", F.array_join(F.col("vlan_ids").cast("array<string>"), ",").alias("vlans"), "ip_version", "src_ip", "dst_ip", "dst_port", F.col("m.id").alias("id"), F.col("m.rcode").alias("rcode"), _listed("m.questions", lambda q: F.concat_ws("/", q["qname"], q["qtype_name"])).alias("questions"),
        _listed("m.answers", record).alias("answers"), *[F.col(f"m.edns.{c}").alias(c) for c in ("udp_size", "extended_rcode", "do_bit")], _listed("m.edns.options", lambda o: F.concat_ws("=", o["code"].cast("string"), F.lower(F.hex(o["value"])))).alias("options"), _warnings("m").alias("warnings"),
    )


def _counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters over one capture of all three, of which the DNS packets are skipped."""
    rows = rich_frames.rows(spark, sf_dir)
    whole = rich_frames.dhcp4(rows).unionByName(rich_frames.dhcp6(rows)).unionByName(rich_frames.dns(rows))
    packets = stored(whole.withColumn("seq", F.monotonically_increasing_id()), "capture")
    return events.counters(packets, stored(events.dhcp_messages(packets), "messages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"decode_dhcp4_from_events": _dhcp4, "decode_dhcp6_from_events": _dhcp6, "decode_dns_from_events": _dns, "dhcp_counters_from_events": _counters}


def _each(n: str, value: str, by: str = ";") -> str:
    return f"list_aggregate(list_transform(range({n}), lambda i: {value}), 'string_agg', '{by}')"


_HEX = lambda v, d: f"printf('%0{d}x', {v})"
_TYPES = "CASE m WHEN 1 THEN 'discover' WHEN 2 THEN 'offer' WHEN 3 THEN 'request' WHEN 4 THEN 'decline' WHEN 5 THEN 'ack' WHEN 6 THEN 'nak' WHEN 7 THEN 'release' ELSE 'inform' END"
_E = "WITH e AS (SELECT event_id AS seq, user_id AS u, event_id % 8 + 1 AS m, event_id % 6 = 0 AS over, '02005e10' || printf('%04x', user_id % 65536) AS mac FROM events)"
_MAC = "substr(mac, 1, 2) || ':' || substr(mac, 3, 2) || ':' || substr(mac, 5, 2) || ':' || substr(mac, 7, 2) || ':' || substr(mac, 9, 2) || ':' || substr(mac, 11, 2)"
_ID = f"CASE WHEN seq % 3 = 0 THEN '00' || lower(hex(encode('id' || u))) ELSE '01' || mac END"
_DHCP4 = f"""{_E} SELECT seq, seq::BIGINT AS xid, CASE WHEN u % 3 = 0 THEN 32768 ELSE 0 END::INT AS flags, '0.0.0.0' AS ciaddr, '198.51.100.' || (seq % 200 + 1) AS yiaddr,
  CASE WHEN u % 5 = 0 THEN '192.0.2.254' ELSE '0.0.0.0' END AS giaddr, {_MAC} AS chaddr_mac, CASE WHEN over THEN '' ELSE 'srv' || seq % 7 END AS sname, CASE WHEN over THEN '' ELSE 'boot' || seq % 5 END AS file,
  m::INT AS message, '255.255.255.0' AS subnet_mask, 'host' || u AS hostname, 'example.com' AS domain, '198.51.100.' || (seq % 200 + 1) AS requested_address, ((seq % 24 + 1) * 3600)::BIGINT AS lease_seconds,
  '192.0.2.2' AS server_id, 'note' || seq % 3 AS text, 1500 AS max_size, ((seq % 24 + 1) * 1800)::BIGINT AS t1, ((seq % 24 + 1) * 3150)::BIGINT AS t2,
  'maker' || seq % 2 AS class_id, CASE WHEN seq % 3 = 0 THEN 'id' || u ELSE {_MAC} END AS client_id_text, 'tftp' || seq % 4 AS tftp_server, 'img' || seq % 9 AS boot_file, 'http://wpad/' || seq % 3 AS proxy,
  CASE WHEN seq % 2 = 0 THEN 4 ELSE 1 END AS fqdn_flags, CASE WHEN seq % 2 = 0 THEN 0 ELSE 2 END AS fqdn_rcode1, CASE WHEN seq % 2 = 0 THEN 0 ELSE 3 END AS fqdn_rcode2, CASE WHEN seq % 2 = 0 THEN 'c' || u || '.example.com' ELSE 'pc' || u END AS fqdn,
  '192.0.2.1,192.0.2.' || (seq % 250 + 1) AS routers, '192.0.2.53,192.0.2.54' AS dns_servers, '1,3,6,15,' || (seq % 200 + 20) AS parameters, {_ID} AS client_id,
  '1=ab' || seq % 10 || ',2=00' || {_HEX('seq % 256', 2)} AS vendor, seq % 11 <> 0 AS vendor_ok, CASE WHEN seq % 11 = 0 THEN 'vendor_subopt_len_overrun' ELSE '' END AS vendor_warnings,
  '1=eth' || u % 48 || ',2=0001' || mac || ',6=sub' || seq % 100 || CASE WHEN seq % 17 = 0 THEN ',10=' ELSE '' END AS relay,
  '{RELAY_NAMES[1]},{RELAY_NAMES[2]},{RELAY_NAMES[6]}' || CASE WHEN seq % 17 = 0 THEN ',{RELAY_NAMES.get(10, "")}' ELSE '' END AS relay_names, 'eth' || u % 48 AS circuit, '0001' || mac AS remote, 'sub' || seq % 100 AS subscriber,
  'Eng' || seq % 5 || '.example.com,mkt.example.com' AS search, CASE WHEN seq % 4 = 0 THEN {_each(str(rich_frames.MANY_ROUTES), "'10.0.' || i || '.0/24>192.0.2.1'")} ELSE '10.0.' || seq % 250 || '.0/24>192.0.2.1' END AS routes, '10.0.' || seq % 100 || '.0/24>192.0.2.1' AS microsoft_routes,
  (25 + over::INT + (seq % 4 = 0)::INT + (seq % 13 = 0)::INT)::INT AS n_options, ((seq % 4 = 0)::INT * 2 + (seq % 13 = 0)::INT * 2)::INT AS n_fragments, CASE WHEN over THEN 'file:1,sname:12' ELSE '' END AS overloaded,
  concat_ws(';', CASE WHEN seq % 13 = 0 THEN 'opt_len_overrun@raw_options[' || (24 + (NOT over)::INT + (seq % 4 = 0)::INT) || ']' END, CASE WHEN seq % 17 = 0 THEN 'relay_subopt_truncated@decoded.relay_agent_information.suboptions[3]' END) AS warnings,
  'dhcpv4.' || {_TYPES} || '.observed' AS event_type, {_ID} AS client_key, {_HEX('seq', 8)} || '-' || {_MAC} AS transaction_key, CASE WHEN m IN (2, 5) THEN '198.51.100.' || (seq % 200 + 1) ELSE '' END AS lease_address,
  u % 5 = 0 AS is_relayed, u % 3 = 0 AS is_broadcast, false AS is_renewal, false AS is_rebind FROM e"""
_ADDRESS = lambda n: f"'2001:db8::' || printf('%x', {n} % 65535 + 1)"
_DHCP6 = f"""{_E} SELECT seq, CASE WHEN u % 2 = 0 THEN (u % 4094 + 1)::VARCHAR ELSE '' END AS vlans, 'fe80::1' AS src_ip, 'ff02::1:2' AS dst_ip, CASE WHEN r THEN 12 ELSE [1, 3, 7, 11][seq % 4 + 1] END::INT AS message,
  CASE WHEN NOT r THEN (seq % 16777216)::INT END AS transaction_id, CASE WHEN r THEN (seq % 8)::INT END AS hop_count, CASE WHEN r THEN {_ADDRESS('u')} END AS link_address, CASE WHEN r THEN 'fe80::1' END AS peer_address,
  CASE WHEN NOT r THEN 4242 END::BIGINT AS vendor_class_enterprise, CASE WHEN NOT r THEN 'class' || seq % 4 END AS vendor_class, CASE WHEN NOT r THEN '00030001' || mac END AS client, CASE WHEN NOT r THEN '0003000102005e200001' END AS server,
  CASE WHEN r THEN '' ELSE '23,24,' || (seq % 200 + 1) END AS requested, CASE WHEN r THEN '' WHEN seq % 7 = 0 THEN {_ADDRESS('u')} ELSE {_ADDRESS('seq')} || ',' || {_ADDRESS('u')} END AS addresses,
  CASE WHEN r THEN '' ELSE seq % 5000 || ':1:' || lower(hex(encode('v' || seq % 9))) || ',' || seq % 5000 || ':2:dead' || {_HEX('seq % 256', 2)} END AS vendor, CASE WHEN r THEN 2 ELSE 7 + (seq % 11 = 0)::INT END::INT AS n_options,
  CASE WHEN r THEN '' ELSE concat_ws(';', CASE WHEN seq % 11 = 0 THEN 'opt_len_overrun@raw_options[7]' END, CASE WHEN seq % 7 = 0 THEN 'ia_len_short@decoded.assigned_addresses' END) END AS warnings
  FROM (SELECT *, u % 5 = 0 AS r FROM e)"""
_KIND = "[" + ", ".join(f"'{RR_TYPES[k]}'" for k in rich_frames.KINDS) + "][seq % 9 + 1]"
_DNS = f"""{_E}, n AS (SELECT *, 'q' || u % 37 || '.example.com' AS q, 't' || seq % 50 || '.q' || u % 37 || '.example.com' AS t FROM e)
SELECT seq, CASE u % 3 WHEN 0 THEN '' WHEN 1 THEN (u % 4094 + 1)::VARCHAR ELSE (u % 4094 + 1) || ',7' END AS vlans, 6 AS ip_version, '2001:db8::35' AS src_ip, {_ADDRESS('u')} AS dst_ip, (40000 + u % 10000)::INT AS dst_port, (seq % 65536)::INT AS id,
  CASE WHEN seq % 10 = 0 THEN 0 ELSE (seq % 2) * 16 END::INT AS rcode, q || '/' || {_KIND} AS questions,
  q || ' ' || {_KIND} || ' ' || seq % 3600 || ' ' || ['192.0.2.' || seq % 256, {_ADDRESS('seq')}, t, (seq % 30) || ' ' || t, 'w' || seq % 100 || ' x', (seq % 5) || ' 2 53 ' || t, t || ' ' || q || ' ' || seq || ' 7200 3600 1209600 3600', t, t][seq % 9 + 1] AS answers,
  CASE WHEN seq % 10 <> 0 THEN 1232 END::INT AS udp_size, CASE WHEN seq % 10 <> 0 THEN seq % 2 END::INT AS extended_rcode, CASE WHEN seq % 10 <> 0 THEN seq % 4 = 0 END AS do_bit, CASE WHEN seq % 10 <> 0 THEN '8=' || {_HEX('seq', 8)} ELSE '' END AS options, '' AS warnings FROM n"""
_COUNTERS = """SELECT 'dhcpv4' AS family, count(*) AS formatted, 0::BIGINT AS skipped, (sum((event_id % 13 = 0)::INT + (event_id % 17 = 0)::INT))::BIGINT AS warnings FROM events
  UNION ALL SELECT 'dhcpv6', count(*), 0, (sum(CASE WHEN user_id % 5 = 0 THEN 0 ELSE (event_id % 11 = 0)::INT + (event_id % 7 = 0)::INT END))::BIGINT FROM events UNION ALL SELECT '', 0, count(*), 0 FROM events"""


def oracle_sql() -> dict[str, str]:
    return {"decode_dhcp4_from_events": _DHCP4, "decode_dhcp6_from_events": _DHCP6, "decode_dns_from_events": _DNS, "dhcp_counters_from_events": _COUNTERS}
