"""The capture data source: ranges of any width give what a reading from the beginning gives."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from wirelens.sources import pcap, pcap_source
from wirelens.sources.pcap_source import ranges


def image(records, order="<", magic="4d3cb2a1"):
    out = bytes.fromhex(magic) + struct.pack(order + "HHiIII", 2, 4, 0, 0, 65535, 1)
    return out + b"".join(struct.pack(order + "4I", s, n, len(f), max(length, len(f))) + f for s, n, f, length in records)


def some(seed, n=300):
    draw = random.Random(seed)
    kinds = [lambda k: bytes(k), lambda k: draw.randbytes(k), lambda k: struct.pack("<I", draw.randrange(2000)) * (k // 4 + 1), lambda k: b"\xff" * k]
    return [(1_700_000_000 + i // 7, draw.randrange(1000), draw.choice(kinds)(draw.choice([1, 14, 60, 200, 1500, 5000])), draw.choice([0, 9000])) for i in range(n)]


def by_ranges(path, raw, width):
    rows = []
    for part in ranges([(str(path), len(raw))], width):
        for batch in pcap_source.read(part):
            rows += [tuple(r.values())[1:] for r in batch.to_pylist()]
    return rows


@pytest.mark.parametrize("order,magic", [("<", "4d3cb2a1"), (">", "a1b2c3d4")])
def test_ranges_of_any_width(tmp_path, monkeypatch, order, magic):
    monkeypatch.setattr(pcap_source, "BUFFER", 4096)
    monkeypatch.setattr(pcap_source, "WINDOW", 3000)
    for seed in range(3):
        raw = image(some(seed), order, magic)
        (tmp_path / "a.pcap").write_bytes(raw)
        want = [r[1:] for r in pcap.records(raw)]
        for width in (1 << 30, 50_000, 9_999, 1_000, 333):
            got = by_ranges(tmp_path / "a.pcap", raw, width)
            assert [r[1:] for r in got] == want
            assert [r[0] for r in got] == sorted({r[0] for r in got})


def test_what_can_not_be_read(tmp_path):
    good = image(some(5, 60))
    for tail in (b"\0" * 5, struct.pack("<4I", 1_700_000_000, 5, 900, 900) + b"cut", struct.pack("<4I", 1, 5, 0, 0)):
        (tmp_path / "t.pcap").write_bytes(good + tail)
        want = [r[1:] for r in pcap.records(good + tail)]
        for width in (1 << 30, 7_000, len(good), len(good) - 3):
            assert [r[1:] for r in by_ranges(tmp_path / "t.pcap", good + tail, width)] == want
    for raw, error in ((b"", "no classic pcap file"), (b"\x0a\x0d\x0d\x0a" + bytes(99), "no classic pcap file"), (image([])[:20] + struct.pack("<I", 101), "no Ethernet capture")):
        (tmp_path / "n.pcap").write_bytes(raw)
        assert by_ranges(tmp_path / "n.pcap", raw, 40) == [(0, None, None, None, None, None, error)]
    (tmp_path / "n.pcap").write_bytes(image([]))
    assert by_ranges(tmp_path / "n.pcap", image([]), 40) == []


def test_reading_goes_on_behind_a_broken_record(tmp_path):
    first, last = image(some(1, 50)), image(some(2, 50))[24:]
    raw = first + struct.pack("<4I", 1_700_000_000, 0, 1 << 30, 1 << 30) + last
    (tmp_path / "b.pcap").write_bytes(raw)
    got = by_ranges(tmp_path / "b.pcap", raw, len(first) + 16)
    assert [r[-1] for r in got if r[-1]] == ["record too long"]
    assert len(got) == 101 and [r[5] for r in got[51:]] == [r[5] for r in pcap.records(image(some(2, 50)))]


def test_a_capture_inside_a_packet_is_told(tmp_path):
    inner = image([(1_700_000_000, 1, bytes([k] * 40), 0) for k in range(40)])[24:]
    raw = image([*some(3, 20), (1_700_000_003, 0, b"x" * 100 + inner, 0), *some(4, 20)])
    (tmp_path / "i.pcap").write_bytes(raw)
    inside = raw.index(b"x" * 100) + 300
    got = by_ranges(tmp_path / "i.pcap", raw, inside)
    assert "the next range begins elsewhere" in [r[-1] for r in got]
    assert [r[1:] for r in by_ranges(tmp_path / "i.pcap", raw, 1 << 30)] == [r[1:] for r in pcap.records(raw)]


def test_written_and_read_in_batch_and_as_a_stream(spark, tmp_path):
    pcap_source.register(spark)
    path, name = f"{tmp_path}/captures", pcap_source.NAME
    packets = spark.range(4000).select((F.col("id") * 1_000_003 + 1_700_000_000_000_000_000).alias("observed_ns"), F.encode(F.repeat(F.lit("ab"), (F.col("id") % 90 + 1).cast("int")), "utf-8").alias("frame"), (F.col("id") % 500).cast("int").alias("packet_len"))
    odd = spark.createDataFrame([(None, bytearray(b"x"), 1), (5, None, 2), (5, bytearray(), 3)], "observed_ns long, frame binary, packet_len int")
    packets.unionByName(odd).write.format(name).mode("append").save(path)
    want = {(r[0], bytes(r[1]), max(r[2], len(r[1]))) for r in packets.collect()}
    read = spark.read.format(name).option("rangeBytes", 5000).load(path)
    rows = read.collect()
    assert {(r.observed_ns, bytes(r.frame), r.packet_len) for r in rows} == want and len(rows) == 4000
    assert all(r.flags == int(r.packet_len > len(r.frame)) and r.error is None for r in rows)
    assert read.rdd.getNumPartitions() > 8 and len({r.path for r in rows}) < read.rdd.getNumPartitions()

    def arrived(start):
        stream = spark.readStream.format(name).option("filesPerBatch", 1).option("rangeBytes", 3000).load(path).select("observed_ns", "error")
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").option("path", f"{tmp_path}/out").trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()
        return spark.read.parquet(f"{tmp_path}/out").count() - start

    first = arrived(0)
    assert first == 4000
    (tmp_path / "captures" / "zz-later.pcap").write_bytes(image([(7, 8, b"late", 0)]))
    assert arrived(first) == 1
    packets.limit(10).write.format(name).mode("overwrite").save(path)
    assert spark.read.format(name).load(path).count() == 10
    assert not [p.name for p in (tmp_path / "captures").iterdir() if p.name.startswith("_")]


def test_lost_attempts_leave_nothing(spark, tmp_path):
    pcap_source.register(spark)

    def fails(batches):
        from pyspark import TaskContext

        for k, batch in enumerate(batches):
            yield batch
            if TaskContext.get().partitionId() == 3:
                raise RuntimeError("lost")

    packets = spark.range(400).selectExpr("id AS observed_ns", "cast('abc' AS binary) AS frame").repartition(6)
    with pytest.raises(Exception, match="lost"):
        packets.mapInArrow(fails, packets.schema).write.format(pcap_source.NAME).mode("append").save(f"{tmp_path}/c")
    left = list((tmp_path / "c").iterdir()) if (tmp_path / "c").exists() else []
    assert left == []
