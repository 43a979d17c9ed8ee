"""The wire: packets as a table, projected from the driver's ``events``.

Clicks and views are DNS queries, purchases and errors responses, sign-ups DHCP messages; a user is a client that talks
to one server about one name, so that user_id stands for the whole transaction key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL = ["192.0.2.53"]
BACKEND = ["192.0.2.10"]
SERVICE_ROLES = [(0, "192.0.2.53", "resolver"), (1, "192.0.2.10", "authoritative"), (2, "192.0.2.53", "shadowed")]


def _two(number: Column) -> Column:
    """Hex of at least two digits, as ``printf`` has it."""
    digits = F.lower(F.hex(number))
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(2)), "0")


def client_text(ip: Column) -> Column:
    """The wire's text of an address in a packet. Clients are numbered through from 198.18.0.1; the wire writes all but the last octet's
    share of the number as third octet, also beyond 255, which in a packet is carried into the second."""
    octets = F.split(ip, r"\.")
    third = (octets[1].cast("int") - 18) * 256 + octets[2].cast("int")
    return F.when(ip.startswith("198.") & ~ip.startswith("198.18.") & (octets[1].cast("int") > 18), F.concat(F.lit("198.18."), third.cast("string"), F.lit("."), octets[3])).otherwise(ip)


def mac_text(mac: Column) -> Column:
    """The wire's text of a client's MAC address in a packet, as :func:`client_text`: all but the last byte's share of its number is
    the fifth part."""
    parts = F.split(mac, ":")
    fifth = (F.conv(parts[3], 16, 10).cast("int") - 16) * 256 + F.conv(parts[4], 16, 10).cast("int")
    return F.when(mac.startswith("02:00:5e:") & (parts[3] > "10"), F.concat(F.lit("02:00:5e:10:"), _two(fifth), F.lit(":"), parts[5])).otherwise(mac)


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    kind = F.when(F.col("event_type").isin("click", "view"), "query").when(F.col("event_type").isin("purchase", "error"), "response").otherwise("dhcp")
    third = F.expr("user_id div 250")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        event.alias("seq"),
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("observed_ns"),
        kind.alias("kind"),
        user,
        F.when(user % 10 == 0, "tcp").otherwise("udp").alias("transport"),
        F.lit(4).alias("ip_version"),
        F.concat(F.lit("198.18."), third.cast("string"), F.lit("."), (user % 250 + 1).cast("string")).alias("client_ip"),
        F.when(user % 4 == 3, F.lit(53)).otherwise((40000 + user % 10000).cast("int")).alias("client_port"),
        F.element_at(F.array(*map(F.lit, ["192.0.2.53", "192.0.2.10", "203.0.113.9", "203.0.113.10"])), (user % 4 + 1).cast("int")).alias("server_ip"),
        F.lit(53).alias("server_port"),
        (user * 7 % 65536).cast("int").alias("dns_id"),
        F.concat(F.lit("host"), F.expr("string(user_id div 4 % 37)"), F.lit(".example.com")).alias("qname"),
        F.element_at(F.array(*map(F.lit, [1, 28, 15, 16])), F.expr("int((user_id div 4) % 4) + 1")).alias("qtype"),
        F.lit(1).alias("qclass"),
        F.when(F.col("event_type") == "purchase", F.lit(0)).when(F.col("event_type") == "error", (event % 3 + 1).cast("int")).alias("rcode"),
        F.when(kind == "dhcp", F.element_at(F.array(*map(F.lit, [1, 2, 3, 5])), (event % 4 + 1).cast("int"))).alias("message"),
        F.concat(F.lit("02:00:5e:10:"), _two(F.expr("user_id div 256")), F.lit(":"), _two(user % 256)).alias("mac"),
    )


WIRE_SQL = """
wire AS (
  SELECT event_id AS seq, epoch_us(ts) * 1000 AS observed_ns,
    CASE WHEN event_type IN ('click', 'view') THEN 'query' WHEN event_type IN ('purchase', 'error') THEN 'response' ELSE 'dhcp' END AS kind,
    user_id, CASE WHEN user_id % 10 = 0 THEN 'tcp' ELSE 'udp' END AS transport, 4 AS ip_version,
    '198.18.' || (user_id // 250) || '.' || (user_id % 250 + 1) AS client_ip,
    CASE WHEN user_id % 4 = 3 THEN 53 ELSE (40000 + user_id % 10000)::INT END AS client_port,
    ['192.0.2.53', '192.0.2.10', '203.0.113.9', '203.0.113.10'][user_id % 4 + 1] AS server_ip, 53 AS server_port,
    (user_id * 7 % 65536)::INT AS dns_id, 'host' || (user_id // 4 % 37) || '.example.com' AS qname,
    [1, 28, 15, 16][(user_id // 4) % 4 + 1] AS qtype, 1 AS qclass,
    CASE event_type WHEN 'purchase' THEN 0 WHEN 'error' THEN (event_id % 3 + 1)::INT END AS rcode,
    CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'error') THEN [1, 2, 3, 5][event_id % 4 + 1] END AS message,
    '02:00:5e:10:' || printf('%02x', user_id // 256) || ':' || printf('%02x', user_id % 256) AS mac
  FROM events)
"""
