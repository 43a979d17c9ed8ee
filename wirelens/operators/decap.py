"""Frames to transport payloads, and the port predicates that come before any decoding: all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelens.functions.bytes import address_text, number, piece
from wirelens.functions.formats import mac_text

VLAN = (0x8100, 0x88A8)
IPV4, IPV6 = 0x0800, 0x86DD
UDP, TCP = 17, 6
EXTENSIONS = (0, 43, 60)
FRAGMENT = 44
DNS_PORTS, DHCPV4_PORTS, DHCPV6_PORTS = (53,), (67, 68), (546, 547)


def port_predicate(frame: Column, ports_v4: tuple[int, ...], ports_v6: tuple[int, ...], protocols: tuple[int, ...]) -> Column:
    """Whether a kernel filter passes the frame: at most one VLAN tag, the protocol at its fixed place, and either port.

    Later IPv4 fragments fail; IPv6 extension headers aren't followed. It is one pattern over the headers' digits: with the
    numbers behind each other it would be more code than the JVM compiles.
    """

    def one_of(numbers: tuple[int, ...], digits: int) -> str:
        return "(?:" + "|".join(f"{n:0{digits}X}" for n in numbers) + ")"

    def either(ports: tuple[int, ...]) -> str:
        return f"(?:{one_of(ports, 4)}|.{{4}}{one_of(ports, 4)})"

    # the ports are behind as many words as the header has
    at = "|".join(f"(?=.{n:X})(?=.{{{8 * n}}}{either(ports_v4)})" for n in (*range(5, 16), *range(5)))
    v4 = f"{IPV4:04X}(?:{at}).{{12}}[02468ACE]000.{{2}}{one_of(protocols, 2)}"
    v6 = f"{IPV6:04X}.{{12}}{one_of(protocols, 2)}.{{66}}{either(ports_v6)}"
    return F.coalesce(F.hex(F.substring(frame, 13, 70)).rlike(f"^(?:{one_of(VLAN, 4)}.{{4}})?(?:{v4}|{v6})"), F.lit(False))


def dns_predicate(frame: Column) -> Column:
    return port_predicate(frame, DNS_PORTS, DNS_PORTS, (UDP, TCP))


def dhcp_predicate(frame: Column) -> Column:
    return port_predicate(frame, DHCPV4_PORTS, DHCPV6_PORTS, (UDP,))


def _tags(frame: Column) -> Column:
    """Ethertype, where its payload begins, and the VLAN ids; a third tag stays as ethertype."""
    start = F.struct(number(frame, 12, 2).alias("kind"), F.lit(14).alias("at"), F.array().cast("array<int>").alias("vlans"))

    def step(acc: Column, _: Column) -> Column:
        more = F.struct(
            number(frame, acc["at"] + 2, 2).alias("kind"),
            (acc["at"] + 4).alias("at"),
            F.array_append(acc["vlans"], number(frame, acc["at"], 2).bitwiseAND(0xFFF).cast("int")).alias("vlans"),
        )
        return F.when(acc["kind"].isin(*VLAN), more).otherwise(acc)

    return F.aggregate(F.array(F.lit(1), F.lit(2)), start, step)


def _extensions(frame: Column, ip: Column) -> Column:
    """IPv6: the protocol after at most 8 extension headers, where it begins, and the fragment's offset."""
    start = F.struct(number(frame, ip + 6, 1).alias("next"), (ip + 40).alias("at"), F.lit(0).cast("long").alias("offset"), F.lit(False).alias("fragment"))

    def step(acc: Column, _: Column) -> Column:
        extension = F.struct(
            number(frame, acc["at"], 1).alias("next"), (acc["at"] + (number(frame, acc["at"] + 1, 1).cast("int") + 1) * 8).alias("at"), acc["offset"].alias("offset"), acc["fragment"].alias("fragment")
        )
        fragment = F.struct(number(frame, acc["at"], 1).alias("next"), (acc["at"] + 8).alias("at"), F.shiftright(number(frame, acc["at"] + 2, 2), 3).alias("offset"), F.lit(True).alias("fragment"))
        going = acc["offset"] == 0
        return F.when(going & acc["next"].isin(*EXTENSIONS), extension).when(going & (acc["next"] == FRAGMENT), fragment).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(8)), start, step)


def decapsulated(packets: DataFrame) -> DataFrame:
    """``packets`` (with ``frame``) with status, addresses, ports and payload of UDP and TCP.

    status: OK, TRUNCATED (a header or the UDP length reaches past the frame), UNSUPPORTED (not IP, more than two VLAN
    tags, a version that contradicts the ethertype, too many extension headers) or OTHER (no UDP or TCP, later
    fragments). A payload ends where the IP packet does, or with the frame if that is shorter. ``packet`` holds what was
    seen below the payload; its lengths are those of ``packet_len`` and ``captured_len`` if there are such columns.

    Numbers of each header are columns that what follows refers to: read where they are needed, they would be read again for
    each number that depends on them, and be more code at once than the JVM compiles.
    """
    frame = F.col("frame")
    size = F.octet_length(frame)
    a = packets.withColumn("_e", _tags(frame)).withColumns({"_ip": F.col("_e.at"), "_kind": F.col("_e.kind"), "vlan_ids": F.col("_e.vlans")})
    is4, is6 = F.col("_kind") == IPV4, F.col("_kind") == IPV6
    ip = F.col("_ip")
    a = a.withColumns(
        {
            "_x": F.when(is6, _extensions(frame, ip)), "_first": number(frame, ip, 1), "_second": number(frame, ip + 1, 1), "_ip_2": number(frame, ip + 2, 2), "_ip_4": number(frame, ip + 4, 2),
            "_ip_6": number(frame, ip + 6, 2), "_ttl": number(frame, ip + F.when(is4, 8).otherwise(7), 1), "_ip_9": number(frame, ip + 9, 1),
        }
    )
    header = F.col("_first").bitwiseAND(15).cast("int") * 4
    a = a.withColumns(
        {
            "ip_version": F.when(is4, 4).when(is6, 6),
            "_version": F.shiftright("_first", 4),
            "protocol": F.when(is4, F.col("_ip_9")).otherwise(F.col("_x.next")),
            "_l4": F.when(is4, ip + header).otherwise(F.col("_x.at")),
            "_fragment": F.when(is4, F.col("_ip_6").bitwiseAND(0x1FFF)).otherwise(F.col("_x.offset")),
            "_end": F.when(is4, ip + F.when(F.col("_ip_2") >= header, F.col("_ip_2")).otherwise(size)).otherwise(ip + 40 + F.col("_ip_4")),
            "_short": F.when(is4, (size < F.col("_ip") + 20) | (header < 20) | (size < F.col("_ip") + header)).otherwise((size < F.col("_ip") + 40) | F.col("_x.next").isNull() | F.col("_x.at").isNull() | (F.col("_x.at") > size)),
        }
    )
    l4 = F.col("_l4")
    a = a.withColumns({"_l4_0": number(frame, l4, 2), "_l4_2": number(frame, l4 + 2, 2), "_l4_4": number(frame, l4 + 4, 2), "_l4_6": number(frame, l4 + 6, 2), "_l4_12": number(frame, l4 + 12, 1), "_l4_13": number(frame, l4 + 13, 1)})
    udp_length, tcp_header = F.col("_l4_4"), F.shiftright("_l4_12", 4).cast("int") * 4
    udp, tcp = F.col("protocol") == UDP, F.col("protocol") == TCP
    bad_udp = udp & F.coalesce((size < l4 + 8) | (udp_length < 8) | (size < l4 + udp_length), F.lit(True))
    bad_tcp = tcp & F.coalesce((size < l4 + 20) | (tcp_header < 20) | (size < l4 + tcp_header), F.lit(True))
    status = (
        F.when(F.col("_kind").isNull(), "TRUNCATED")
        .when(~(is4 | is6), "UNSUPPORTED")
        .when(F.col("_version").isNull(), "TRUNCATED")
        .when(F.col("_version") != F.col("ip_version"), "UNSUPPORTED")
        .when(F.coalesce(F.col("_short"), F.lit(True)), "TRUNCATED")
        .when(F.col("_fragment") != 0, "OTHER")
        .when(F.col("protocol").isin(*EXTENSIONS, FRAGMENT), "UNSUPPORTED")
        .when(~(udp | tcp), "OTHER")
        .when(bad_udp | bad_tcp, "TRUNCATED")
        .otherwise("OK")
    )
    a = a.withColumn("status", status)
    fine = F.col("status") == "OK"
    tcp_start = l4 + tcp_header
    tcp_size = F.greatest(F.least(F.col("_end"), size.cast("long")) - tcp_start, F.lit(0)).cast("int")
    payload = F.when(fine & udp, piece(frame, l4 + 8, (udp_length - 8).cast("int"))).when(fine & tcp, piece(frame, tcp_start, tcp_size))
    width = F.when(F.col("ip_version") == 4, 4).otherwise(16)
    source = F.when(F.col("ip_version") == 4, F.col("_ip") + 12).otherwise(F.col("_ip") + 8)
    addressed = fine | (F.col("status") == "OTHER")
    a = a.withColumns({"_src": address_text(F.when(addressed, piece(frame, source, width))), "_dst": address_text(F.when(addressed, piece(frame, source + width, width)))})
    return a.select(
        *packets.columns, "status", "vlan_ids", "ip_version",
        F.when(udp, "udp").when(tcp, "tcp").alias("transport"),
        mac_text(piece(frame, 6, 6)).alias("src_mac"),
        F.col("_src").alias("src_ip"),
        F.col("_dst").alias("dst_ip"),
        F.when(fine, F.col("_l4_0")).cast("int").alias("src_port"),
        F.when(fine, F.col("_l4_2")).cast("int").alias("dst_port"),
        payload.alias("payload"),
        F.when(fine, _observation(packets, a)).alias("packet"),
    )


def _observation(packets: DataFrame, a: DataFrame) -> Column:
    """What was seen of a packet below its payload: link, network and transport; null where there is nothing to tell."""
    frame, l4 = F.col("frame"), F.col("_l4")
    is4, udp = F.col("ip_version") == 4, F.col("protocol") == UDP
    # the traffic class of IPv6 lies across two bytes
    tos = F.when(is4, F.col("_second")).otherwise(F.shiftright(F.col("_first") * 256 + F.col("_second"), 4).bitwiseAND(255))
    size = F.octet_length(frame)
    known = lambda name, default: F.col(name) if name in packets.columns else default
    flags = F.when(~udp, F.col("_l4_13")).cast("int")
    tcp = F.when(~udp, F.struct(flags.alias("flags"), F.greatest(F.least(F.col("_end"), size.cast("long")) - l4 - F.shiftright("_l4_12", 4) * 4, F.lit(0)).cast("int").alias("payload_len")))
    datagram = F.when(udp, F.struct(F.col("_l4_4").cast("int").alias("length"), (F.col("_l4_6") != 0).alias("checksum_present")))
    return F.struct(
        F.col("observed_ns").alias("observed_time_unix_nano") if "observed_ns" in packets.columns else F.lit(0).cast("long").alias("observed_time_unix_nano"),
        F.struct(
            mac_text(piece(frame, 6, 6)).alias("src_mac"), mac_text(piece(frame, 0, 6)).alias("dst_mac"), F.col("vlan_ids"), F.col("_kind").cast("int").alias("ethertype"),
        ).alias("link"),
        F.struct(
            F.when(is4, "NETWORK_PROTOCOL_IPV4").otherwise("NETWORK_PROTOCOL_IPV6").alias("protocol"),
            F.col("_src").alias("src_ip"), F.col("_dst").alias("dst_ip"),
            F.col("protocol").cast("int").alias("next_header"), F.col("_ttl").cast("int").alias("ttl_or_hop_limit"),
            F.shiftright(tos, 2).cast("int").alias("dscp"), tos.bitwiseAND(3).cast("int").alias("ecn"),
            F.when(is4, F.col("_ip_6").bitwiseAND(0x2000) != 0).otherwise(F.coalesce(F.col("_x.fragment"), F.lit(False))).alias("fragmented"),
            F.coalesce(F.col("_fragment"), F.lit(0)).cast("int").alias("fragment_offset"),
        ).alias("network"),
        F.struct(
            F.when(udp, "TRANSPORT_PROTOCOL_UDP").otherwise("TRANSPORT_PROTOCOL_TCP").alias("protocol"), F.col("protocol").cast("int").alias("ip_protocol_number"),
            F.col("_l4_0").cast("int").alias("src_port"), F.col("_l4_2").cast("int").alias("dst_port"), tcp.alias("tcp"), datagram.alias("udp"),
        ).alias("transport"),
        known("packet_len", size).cast("long").alias("packet_len"), known("captured_len", size).cast("long").alias("captured_len"),
        (known("packet_len", size) > known("captured_len", size)).alias("truncated"),
    )


def dns_message(packets: DataFrame) -> DataFrame:
    """Decapsulated packets with ``message``: the payload, over TCP without its length prefix. Short or partial TCP
    messages (one segment doesn't hold all) have none, and ``partial`` tells the latter."""
    length = number(F.col("payload"), 0, 2)
    have = F.octet_length("payload") - 2
    tcp = F.col("transport") == "tcp"
    message = F.when(~tcp, F.col("payload")).when(length <= have, piece(F.col("payload"), 2, length.cast("int")))
    return packets.withColumns({"message": message, "partial": tcp & F.coalesce(length > have, F.lit(False))})
