"""Decoding never fails, whatever the bytes; pcap files give back what was put in."""

import random
import struct

from pyspark.sql import functions as F

from wirelens.functions import formats
from wirelens.operators import decap, dhcp, dns, events, identity
from wirelens.plans import packets
from wirelens.sources import frames, rich_frames
from wirelens.sources.pcap import read_pcap
from wirelens.sources.tables import stored
from wirelens.sources.wire import BACKEND, LOCAL, SERVICE_ROLES


def payloads():
    out = []
    for made in (packets.dns_fixtures(), packets.dhcp4_fixtures(), packets.dhcp6_fixtures()):
        out += [f[42:] for f in made.values()] + [f[62:] for f in made.values()]
    return out


def test_decoders_survive_cuts_and_flips():
    rng = random.Random(1)
    for raw in payloads():
        for _ in range(40):
            cut = bytearray(raw[: rng.randint(0, len(raw))])
            for _ in range(rng.randint(0, 3)):
                if cut:
                    cut[rng.randrange(len(cut))] ^= 1 << rng.randrange(8)
            for parse in (dns.parsed, dhcp.parsed4, dhcp.parsed6):
                parse(bytes(cut))


def test_names():
    raw = b"\3WwW\7example\0" + b"\xc0\0" + b"\xc0\x0f"
    assert dns.name_at(raw, 0) == ("www.example", 13, True)
    assert dns.name_at(raw, 13) == ("www.example", 2, True)
    assert dns.name_at(raw, 15) == ("", 2, False)  # to itself
    assert dns.name_at(b"\x3f" + b"a" * 10, 0)[2] is False
    assert dns.name_at((b"\x3f" + b"a" * 63) * 5 + b"\0", 0)[2] is False  # more than 255 octets


def test_extended_rcode_and_second_opt():
    opt = b"\0" + struct.pack(">HHIH", 41, 1232, 0x01000000, 0)
    m = dns.parsed(frames.dns(1, "a", 1, 0x8182, opt + opt, (0, 0, 2)))
    assert m["rcode"] == 18 and m["warnings"] == [{"code": "dns_multiple_opt", "path": "additional"}]


def test_partial_tcp_has_no_message(spark):
    whole = frames.udp(b"z" * 40, ("192.0.2.1", 5000), ("192.0.2.2", 53), tcp=True)
    longer = bytearray(whole)
    longer[54:56] = b"\1\0"
    df = spark.createDataFrame([(1, bytearray(whole)), (2, longer)], "i int, frame binary")
    got = {r.i: (r.status, r.partial, None if r.message is None else len(r.message)) for r in decap.dns_message(decap.decapsulated(df)).collect()}
    assert got == {1: ("OK", False, 40), 2: ("OK", True, None)}


def test_event_id_known_answer(spark):
    row = spark.range(1).select(identity.event_id(F.lit("host-a"), F.lit("eth0"), F.lit(1234567890).cast("long"), F.unhex(F.lit("01020304"))).alias("e")).first()
    assert row.e == "48b0b7cd68da51bb65d478f8f8ef99bf"


def test_sampling_is_about_one_in_n():
    import numpy as np

    kept = identity.sampled(np.arange(100_000, dtype=np.uint64), 10).mean()
    assert 0.085 < kept < 0.115
    assert identity.sampled(np.arange(5, dtype=np.uint64), 0).all()


def test_times(spark):
    rows = [(1_730_000_000_123_456_789,), (-1,), (0,), (-1_000_000_001,)]
    got = spark.createDataFrame(rows, "ns long").select(formats.epoch_text(F.col("ns")).alias("e"), formats.utc_text(F.col("ns")).alias("u")).collect()
    assert [tuple(r) for r in got] == [
        ("1730000000.123456789", "2024-10-27 03:33:20.123456789"), ("-0.000000001", "1969-12-31 23:59:59.999999999"),
        ("0.000000000", "1970-01-01 00:00:00.000000000"), ("-1.000000001", "1969-12-31 23:59:58.999999999"),
    ]


def test_pcap(spark, tmp_path):
    def write(name, order, magic, unit, rows, link=1):
        head = bytes.fromhex(magic) + struct.pack(order + "HHiIII", 2, 4, 0, 0, 65535, link)
        (tmp_path / name).write_bytes(head + b"".join(struct.pack(order + "4I", s, f, len(d), n) + d for s, f, d, n in rows))

    write("a.pcap", "<", "d4c3b2a1", 1000, [(1, 2, b"abc", 3), (1, 3, b"d" * 3000, 3000)])
    write("b.pcap", ">", "a1b23c4d", 1, [(5, 7, b"xy", 9)])
    write("c.pcap", "<", "d4c3b2a1", 1000, [], link=101)
    (tmp_path / "d.pcap").write_bytes(b"\x0a\x0d\x0d\x0a" + bytes(40))
    rows = read_pcap(spark, str(tmp_path)).collect()
    got = sorted((r.path[-6:], r.arrival_seq, r.observed_ns, r.packet_len, r.captured_len, r.flags, r.error) for r in rows)
    assert got == [
        ("a.pcap", 0, 1_000_002_000, 3, 3, 0, None), ("a.pcap", 1, 1_000_003_000, 3000, 2048, 1, None), ("b.pcap", 0, 5_000_000_007, 9, 2, 1, None),
        ("c.pcap", 0, None, None, None, None, "no Ethernet capture"), ("d.pcap", 0, None, None, None, None, "no classic pcap file"),
    ]


def test_size_cap(spark):
    """Events that are too long lose their raw payloads, those that still are go; what isn't measured is never too long."""
    rows = rich_frames.rows(spark, "/root/testdata/sf0.001").where("seq % 3 = 0")
    messages = stored(events.dns_messages(rich_frames.dns(rows)), "messages")
    found = stored(events.dns_events(stored(events.dns_transactions(messages, LOCAL, BACKEND, SERVICE_ROLES, 10**9), "tx")), "events")
    sized = found.select("seq", F.octet_length(events.event_json(found)).alias("n"), F.octet_length("event.dns_transaction.response.raw_dns_payload").alias("raw"), events._most_bytes().alias("most")).collect()
    assert len(sized) > 150 and all(r.most >= r.n for r in sized)
    lengths = sorted(r.n for r in sized)
    for largest in (lengths[-1], lengths[len(lengths) // 2], lengths[0], lengths[0] - 60, 10):
        want = {r.seq: r.n > largest for r in sized if r.n <= largest or r.n - 4 * -(-r.raw // 3) <= largest}
        got = events.capped(found, largest).select("seq", "event.dns_transaction.response.raw_payload_truncated", F.col("event.dns_transaction.response.raw_dns_payload").isNull().alias("gone")).collect()
        assert {r.seq: r.gone for r in got} == want and all(r.raw_payload_truncated == r.gone for r in got)
    cut = events.capped(found, lengths[len(lengths) // 2]).where("event.dns_transaction.response.raw_payload_truncated")
    assert 0 < cut.count() < len(sized)
