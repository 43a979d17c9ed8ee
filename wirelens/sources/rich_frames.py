"""Frames with many options and record kinds, each made from the values of a row of ``events``, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelens.sources.frames import MAC_A, MAC_B
from wirelens.sources.tables import dealt

MASK, ROUTER = "FFFFFF00", "C0000201"
#: Routes of a message whose classless routes don't fit one option.
MANY_ROUTES = 45


def hexed(number: Column, digits: int) -> Column:
    return F.lpad(F.hex(number), digits, "0")


def text(value: Column | str) -> Column:
    return F.hex(F.encode(F.lit(value) if isinstance(value, str) else value, "UTF-8"))


def size(hex_: Column, digits: int, more: int = 0) -> Column:
    return hexed((F.length(hex_) / 2).cast("int") + more, digits)


def option(code: int, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.concat(F.lit(f"{code:02X}"), size(value, 2), value)


def option6(code: int, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.concat(F.lit(f"{code:04X}"), size(value, 4), value)


def name(labels: Column) -> Column:
    """A dotted name as labels."""
    return F.concat(F.array_join(F.transform(F.split(labels, r"\."), lambda x: F.concat(hexed(F.length(x), 2), text(x))), ""), F.lit("00"))


def udp4(src: str, sport: int, dst: str, dport: int, payload: Column) -> Column:
    """Ethernet, IPv4 and UDP around a payload; addresses are eight hex digits."""
    datagram = F.concat(F.lit(f"{sport:04X}{dport:04X}"), size(payload, 4, 8), F.lit("0000"), payload)
    return F.unhex(F.concat(F.lit(f"{MAC_B}{MAC_A}0800" + "4500"), size(datagram, 4, 20), F.lit("00000000" + "4011" + "0000" + src + dst), datagram))


def udp6(src: Column, sport: Column, dst: Column, dport: Column, payload: Column, tags: Column | None = None) -> Column:
    """The same over IPv6, with VLAN tags (hex, each eight digits) if there are any."""
    datagram = F.concat(hexed(sport, 4), hexed(dport, 4), size(payload, 4, 8), F.lit("0000"), payload)
    return F.unhex(F.concat(F.lit(MAC_B + MAC_A), tags if tags is not None else F.lit(""), F.lit("86DD" + "60000000"), size(datagram, 4), F.lit("1140"), src, dst, datagram))


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, user, observed_ns, mac in hex) of every event, dealt out to all cores, as frames and what reads them take far longer than
    the table, whose row groups may be few."""
    return dealt(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts")).select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("user"), (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("observed_ns"),
        F.concat(F.lit("02005E10"), hexed(F.expr("user_id % 65536"), 4)).alias("mac"),
    )


def dhcp4(events: DataFrame) -> DataFrame:
    """A DHCPv4 message for each event: every option that has a meaning of its own; some rows overload the name fields, hold
    options too long for one piece, suboptions that are cut, or end in an option that is."""
    seq, user, mac = F.col("seq"), F.col("user"), F.col("mac")
    n = lambda k: (seq % k).cast("string")
    named = lambda stem, k: text(F.concat(F.lit(stem), n(k)))
    when = lambda condition, value: F.when(condition, value).otherwise(F.lit(""))
    overload = seq % 6 == 0
    mask, host = option(1, MASK), option(12, text(F.concat(F.lit("host"), user.cast("string"))))
    route = lambda i: F.concat(F.lit("180A00"), hexed(i, 2), F.lit(ROUTER))
    long_ = "".join(f"180A00{i:02X}{ROUTER}" for i in range(MANY_ROUTES))
    routes = F.when(seq % 4 == 0, F.concat(option(121, long_[:510]), option(121, long_[510:]))).otherwise(option(121, route((seq % 250).cast("int"))))
    fqdn = F.when(seq % 2 == 0, F.concat(F.lit("040000"), name(F.concat(F.lit("c"), user.cast("string"), F.lit(".example.com"))))).otherwise(F.concat(F.lit("010203"), text(F.concat(F.lit("pc"), user.cast("string")))))
    vendor = F.concat(option(1, named("ab", 10)), option(2, F.concat(F.lit("00"), hexed(seq % 256, 2))), when(seq % 11 == 0, F.lit("030578")))
    relay = F.concat(option(1, text(F.concat(F.lit("eth"), (user % 48).cast("string")))), option(2, F.concat(F.lit("0001"), mac)), option(6, named("sub", 100)), when(seq % 17 == 0, F.lit("0A")))
    client = F.when(seq % 3 == 0, F.concat(F.lit("00"), text(F.concat(F.lit("id"), user.cast("string"))))).otherwise(F.concat(F.lit("01"), mac))
    options = F.concat(
        option(53, hexed(seq % 8 + 1, 2)), when(~overload, F.concat(mask, host)), when(overload, option(52, "03")), option(3, F.concat(F.lit(ROUTER + "C00002"), hexed(seq % 250 + 1, 2))), option(6, "C0000235" + "C0000236"), option(15, text("example.com")),
        option(50, F.concat(F.lit("C63364"), hexed(seq % 200 + 1, 2))), option(51, hexed((seq % 24 + 1) * 3600, 8)), option(54, "C0000202"), option(55, F.concat(F.lit("0103060F"), hexed(seq % 200 + 20, 2))), F.lit("00"), option(56, named("note", 3)), option(57, "05DC"),
        option(58, hexed((seq % 24 + 1) * 1800, 8)), option(59, hexed((seq % 24 + 1) * 3150, 8)), option(60, named("maker", 2)), option(61, client), option(66, named("tftp", 4)), option(67, named("img", 9)), option(43, vendor), option(82, relay), option(81, fqdn),
        option(119, F.concat(name(F.concat(F.lit("Eng"), n(5), F.lit(".example.com"))), F.lit("036D6B74C005"))), routes, option(249, route((seq % 100).cast("int"))), option(252, text(F.concat(F.lit("http://wpad/"), n(3)))), F.when(seq % 13 == 0, F.lit("3A04C0")).otherwise(F.lit("FF")),
    )
    server, file = F.concat(F.lit("srv"), n(7)), F.concat(F.lit("boot"), n(5))
    head = F.concat(
        F.lit("01010600"), hexed(seq, 8), F.lit("0000"), F.when(user % 3 == 0, "8000").otherwise("0000"), F.lit("00000000"), F.lit("C63364"), hexed(seq % 200 + 1, 2), F.lit("00000000"), F.when(user % 5 == 0, "C00002FE").otherwise("00000000"),
        mac, F.lit("00" * 10), F.rpad(F.when(overload, F.concat(host, F.lit("FF"))).otherwise(text(server)), 128, "0"), F.rpad(F.when(overload, F.concat(mask, F.lit("FF"))).otherwise(text(file)), 256, "0"), F.lit("63825363"),
    )
    return events.select("seq", "observed_ns", udp4("00000000", 68, "FFFFFFFF", 67, F.concat(head, options)).alias("frame"))


LINK_LOCAL, ALL_SERVERS, PREFIX = "FE80" + "0" * 27 + "1", "FF02" + "0" * 23 + "10002", "20010DB8" + "0" * 20


def dhcp6(events: DataFrame) -> DataFrame:
    """A DHCPv6 message for each event, a fifth of them wrapped by a relay; some have short associations or a cut option."""
    seq, user, mac = F.col("seq"), F.col("user"), F.col("mac")
    duid = F.concat(F.lit("00030001"), mac)
    address = F.concat(F.lit(PREFIX), hexed(seq % 65535 + 1, 4))
    association = F.concat(hexed(user, 8), F.lit("00" * 8), option6(5, F.concat(address, F.lit("00" * 8))))
    temporary = F.concat(hexed(user, 8), option6(5, F.concat(F.lit(PREFIX), hexed(user % 65535 + 1, 4), F.lit("00" * 8))))
    vendor = F.concat(hexed(seq % 5000, 8), option6(1, text(F.concat(F.lit("v"), (seq % 9).cast("string")))), option6(2, F.concat(F.lit("DEAD"), hexed(seq % 256, 2))))
    klass = F.concat(hexed(F.lit(4242), 8), size(t := text(F.concat(F.lit("class"), (seq % 4).cast("string"))), 4), t)
    kind = F.element_at(F.array(*map(F.lit, ["01", "03", "07", "0B"])), (seq % 4 + 1).cast("int"))
    plain = F.concat(
        kind, hexed(seq % 16777216, 6), option6(1, duid), option6(2, "0003000102005E200001"), option6(6, F.concat(F.lit("00170018"), hexed(seq % 200 + 1, 4))),
        option6(3, F.when(seq % 7 == 0, F.lit("0000000000")).otherwise(association)), option6(4, temporary), option6(17, vendor), option6(16, klass), F.when(seq % 11 == 0, F.lit("00060008" + "0017")).otherwise(F.lit("")),
    )
    relayed = F.concat(F.lit("0C"), hexed(seq % 8, 2), F.lit(PREFIX), hexed(user % 65535 + 1, 4), F.lit(LINK_LOCAL), option6(9, plain), option6(18, text(F.concat(F.lit("if"), (user % 9).cast("string")))))
    client, server = F.lit(LINK_LOCAL), F.lit(ALL_SERVERS)
    frame = udp6(client, F.lit(546), server, F.lit(547), F.when(user % 5 == 0, relayed).otherwise(plain), F.when(user % 2 == 0, F.concat(F.lit("8100"), hexed(user % 4094 + 1, 4))).otherwise(F.lit("")))
    return events.select("seq", "observed_ns", frame.alias("frame"))


#: Record kinds of the answers, by ``seq`` % 9.
KINDS = [1, 28, 5, 15, 16, 33, 6, 2, 12]


def dns(events: DataFrame) -> DataFrame:
    """A DNS response for each event, over IPv6 and up to two VLAN tags: an answer of one of nine kinds, the names compressed,
    and, but for every tenth, EDNS with an option."""
    seq, user = F.col("seq"), F.col("user")
    qname = F.concat(F.lit("Q"), (user % 37).cast("string"), F.lit(".Example.com"))
    target = F.concat(hexed(F.length(label := F.concat(F.lit("t"), (seq % 50).cast("string"))), 2), text(label), F.lit("C00C"))
    word = F.concat(F.lit("w"), (seq % 100).cast("string"))
    data = [
        F.concat(F.lit("C00002"), hexed(seq % 256, 2)), F.concat(F.lit(PREFIX), hexed(seq % 65535 + 1, 4)), target, F.concat(hexed(seq % 30, 4), target),
        F.concat(hexed(F.length(word), 2), text(word), F.lit("0178")), F.concat(hexed(seq % 5, 4), F.lit("0002"), F.lit("0035"), target), F.concat(target, F.lit("C00C"), hexed(seq, 8), F.lit("00001C2000000E100012750000000E10")), target, target,
    ]
    pick = lambda values: F.element_at(F.array(*values), (seq % 9 + 1).cast("int"))
    chosen = pick(data)
    answer = F.concat(F.lit("C00C"), hexed(pick([F.lit(k) for k in KINDS]), 4), F.lit("0001"), hexed(seq % 3600, 8), size(chosen, 4), chosen)
    plain = seq % 10 == 0
    edns = F.concat(F.lit("00" + "0029" + "04D0"), hexed(seq % 2, 2), F.lit("00"), F.when(seq % 4 == 0, "8000").otherwise("0000"), F.lit("0008" + "00080004"), hexed(seq, 8))
    message = F.concat(hexed(seq % 65536, 4), F.lit("8180" + "0001" + "0001" + "0000"), F.when(plain, "0000").otherwise("0001"), name(qname), hexed(pick([F.lit(k) for k in KINDS]), 4), F.lit("0001"), answer, F.when(plain, F.lit("")).otherwise(edns))
    tag = lambda v: F.concat(F.lit("8100"), hexed(v, 4))
    tags = F.when(user % 3 == 0, F.lit("")).when(user % 3 == 1, tag(user % 4094 + 1)).otherwise(F.concat(tag(user % 4094 + 1), tag(F.lit(7))))
    server, client = F.lit(PREFIX + "0035"), F.concat(F.lit(PREFIX), hexed(user % 65535 + 1, 4))
    return events.select("seq", "observed_ns", udp6(server, F.lit(53), client, 40000 + user % 10000, message, tags).alias("frame"))
