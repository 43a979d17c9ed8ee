"""Events as bytes in batches: what is made of packets before the shuffle, and how often it is worked on."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from wirelens.functions.bytes import number
from wirelens.operators import dns, events, payload
from wirelens.plans import from_frames, packets
from wirelens.sources import frames
from wirelens.sources import wire as source
from wirelens.sources.tables import stored

DATA = "/root/testdata/sf0.001"


def test_messages_of_a_batch():
    rng = random.Random(3)
    known = [bytes(v)[42:] for v in packets.dns_fixtures().values()] + [frames.dns(5, "Host3.Example.com", 1), frames.dns(5, "", 1)]
    known += [frames.dns(9, ".".join(["x" * 63] * 3 + ["w" * last]), 28, 0x8183) for last in (61, 62)]
    rows = [None, b"", bytes(12)]
    for _ in range(3000):
        raw = bytearray(rng.choice(known))
        for _ in range(rng.choice([0, 0, 1, 2])):
            raw[rng.randrange(len(raw))] = rng.choice([0, 1, 3, 63, 64, 192, 46, 65, 90, 200])
        rows.append(bytes(raw[: rng.choice([len(raw), len(raw), rng.randrange(len(raw))])]))
    batch = pa.array(rows, pa.binary())
    assert dns.parsed_batch(batch).to_pylist() == [dns.parsed(v) for v in rows]
    assert dns.parsed_batch(batch.slice(100, 50)).to_pylist() == [dns.parsed(v) for v in rows[100:150]]
    assert dns.parsed_batch(batch[:0]).to_pylist() == []


def _events(spark):
    """The same events as structs and with packets and messages as bytes: those of fixtures and of the table."""
    odd = [(-i - 1, i, bytearray(v), None) for i, v in enumerate(packets.dns_fixtures().values())]
    wire = frames.dns_frames(source.wire(spark, DATA).where("seq < 400"))
    captured = stored(from_frames._recorded(wire.union(spark.createDataFrame(odd, wire.schema))), "capture")
    found = []
    for messages, as_bytes in ((stored(events.dns_messages(captured), "messages"), False), (payload.packed(events.dns_payloads(captured)), True)):
        kept = messages.where("m IS NOT NULL").withColumn("frame", frames.recorded())
        tx = stored(events.dns_transactions(kept, source.LOCAL, source.BACKEND, source.SERVICE_ROLES, from_frames.TIMEOUT), "transactions")
        found.append(stored(events.dns_events(tx, as_bytes).select("event"), "events"))
    return found


def test_bytes_before_the_shuffle(spark):
    whole, parts = _events(spark)
    assert whole.schema["event"].dataType.simpleString() == payload.KIND.simpleString()
    sizes = sorted(r[0] for r in whole.select(F.octet_length(payload.encoded("event", payload.KIND))).collect())
    assert len(sizes) > 100
    for largest in (8192, sizes[len(sizes) // 2]):
        want = {r.event_id: r for r in payload.entries(whole, largest).collect()}
        got = {r.event_id: r for r in payload.entries(parts, largest, payload.KIND).collect()}
        assert want == got and any(r.truncated for r in got.values()) == (largest < 8192)


def test_events_are_stored_once(spark, monkeypatch):
    """Each table of whole events costs as much as encoding them; there were nine."""
    labels = []
    for module in (from_frames, payload):
        monkeypatch.setattr(module, "stored", lambda df, label: labels.append(label) or stored(df, label))
    plan = from_frames._payload(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert labels == ["capture", "entries"] and plan.count("ArrowEvalPython") == 1


def test_places_that_follow_from_numbers(spark):
    """A number's place is read once, however deep numbers depend on each other."""
    at = F.lit(0).cast("long")
    for _ in range(6):
        at = number(F.col("raw"), at, 2)
    df = spark.createDataFrame([(bytearray(b"\x00\x01\x00\x00\x02"),)], "raw binary").select(at.alias("n"), *[number(F.col("raw"), i, 2).alias(f"n{i}") for i in (3, 4, 5)])
    assert df._jdf.queryExecution().analyzed().toString().count("substring(") == 9
    row = df.first()
    assert (row.n3, row.n4, row.n5) == (2, None, None)
