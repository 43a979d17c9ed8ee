"""Correlation: hand-made scenarios, and batch, streaming and a sequential reading against each other."""

import random

import pandas as pd
import pytest

from wirelens.operators.correlate import KEY, transactions
from wirelens.streaming.correlator import DRAIN_NS, correlated, outcomes, pending_left, run_once, settled, tick

TIMEOUT = 5_000_000_000
Q, R = "query", "response"
FIELDS = "seq long, observed_ns long, kind string, rcode int, transport string, ip_version int, client_ip string, client_port int, server_ip string, server_port int, dns_id int, qname string, qtype int, qclass int"


def packet(seq, ns, kind, **other):
    key = {"transport": "udp", "ip_version": 4, "client_ip": "192.0.2.9", "client_port": 4000, "server_ip": "192.0.2.53", "server_port": 53, "dns_id": 1, "qname": "a.example", "qtype": 1, "qclass": 1} | other
    return (seq, ns, kind, 0 if kind == R else None, *[key[k] for k in KEY])


def run(spark, rows, **options):
    out = transactions(spark.createDataFrame(rows, FIELDS), TIMEOUT, **options).collect()
    return sorted((r.seq, r.outcome, r.cause, r.rtt_ns, r.rtt_valid) for r in out)


T0, SOON = 7_000_000_000_000, 40_000_000
SCENARIOS = [
    ([(T0, R)], [(0, "UNMATCHED", "", None, 0)]),
    ([(T0, Q)], [(0, "UNANSWERED", "drain", None, 0)]),
    ([(T0, Q), (T0 + SOON, R)], [(0, "OBSERVED", "", SOON, 1)]),
    ([(T0, Q), (T0, R)], [(0, "OBSERVED", "", 0, 1)]),
    ([(T0, Q), (T0 + SOON, R), (T0 + 3 * SOON, R)], [(0, "OBSERVED", "", SOON, 1), (2, "UNMATCHED", "", None, 0)]),
    ([(T0, Q), (T0 + SOON, Q), (T0 + 4 * SOON, R)], [(0, "UNANSWERED", "collision", None, 0), (1, "OBSERVED", "", 3 * SOON, 1)]),
    ([(T0, Q), (T0 + TIMEOUT, R)], [(0, "OBSERVED", "", TIMEOUT, 1)]),
    ([(T0, Q), (T0 + TIMEOUT + 1, R)], [(0, "UNANSWERED", "timeout", None, 0), (1, "UNMATCHED", "", None, 0)]),
    ([(T0, Q), (T0 + 2 * TIMEOUT, Q)], [(0, "UNANSWERED", "timeout", None, 0), (1, "UNANSWERED", "drain", None, 0)]),
]


@pytest.mark.parametrize("steps,want", SCENARIOS)
def test_scenarios(spark, steps, want):
    assert run(spark, [packet(i, ns, kind) for i, (ns, kind) in enumerate(steps)]) == want


def test_lazy_keeps_late_answers_as_invalid(spark):
    rows = [packet(0, 1000, Q), packet(1, 1000 + TIMEOUT + 5, R)]
    assert run(spark, rows, lazy=True) == [(0, "OBSERVED", "", TIMEOUT + 5, 0)]


def test_arrival_order_gives_negative_round_trips(spark):
    rows = [packet(0, 2000, Q), packet(1, 1000, R)]
    assert run(spark, rows, order=["seq"]) == [(0, "OBSERVED", "", -1000, 0)]


@pytest.mark.parametrize("lazy,order", [(False, None), (True, None), (False, ["seq"])])
def test_slices_equal_the_whole_key(spark, lazy, order):
    """Packets of one key cut into slices of any width, with gaps of many slices, ties and nulls in key and order."""
    draw, rows, ns = random.Random(4), [], -3 * TIMEOUT
    for i in range(600):
        ns += draw.choice([0, 1, SOON, TIMEOUT // 2, TIMEOUT, TIMEOUT + 1, 40 * TIMEOUT])
        rows.append(packet(i, ns + draw.choice([0, 0, -SOON]), draw.choice([Q, R]), dns_id=draw.choice([1, 1, 1, 1, 2, None])))
    rows.append(packet(600, None, Q))
    want = run(spark, rows, lazy=lazy, order=order)
    for width in (1, SOON, TIMEOUT, 1000 * TIMEOUT) if order is None else (1, 7, 10_000):
        assert run(spark, rows, lazy=lazy, order=order, slice_width=width) == want
    carried = transactions(spark.createDataFrame(rows, FIELDS), TIMEOUT, carry=["qname", "dns_id"], slice_width=TIMEOUT)
    whole = transactions(spark.createDataFrame(rows, FIELDS), TIMEOUT, carry=["qname", "dns_id"])
    assert carried.columns == whole.columns and sorted(map(str, carried.collect())) == sorted(map(str, whole.collect()))
    assert run(spark, [], slice_width=5) == []


def test_a_hot_key_runs_in_many_tasks(spark):
    from pyspark.sql import functions as F

    packets = spark.range(80_000).select(
        F.col("id").alias("seq"), (F.col("id") * SOON).alias("observed_ns"), F.when(F.col("id") % 3 == 0, Q).otherwise(R).alias("kind"), F.lit(0).alias("rcode"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("client")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = {}
        for width in (None, 1000 * SOON):
            found = transactions(packets, TIMEOUT, key=["client"], slice_width=width)
            sizes[width] = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sizes[None][-1] > 3 * sizes[None][4] and sizes[1000 * SOON][-1] < 2 * sizes[1000 * SOON][4]


def test_every_key_column_counts(spark):
    other = [{"dns_id": 2}, {"qname": "b.example"}, {"qtype": 28}, {"client_port": 4001}, {"transport": "tcp"}]
    rows = [packet(0, 1000, Q)] + [packet(i + 1, 1100, R, **o) for i, o in enumerate(other)]
    assert [r[1] for r in run(spark, rows)] == ["UNANSWERED"] + ["UNMATCHED"] * 5


def test_batch_equals_stream_state(spark):
    rng = random.Random(6)
    rows = [packet(i, rng.randrange(60) * TIMEOUT // 4, rng.choice([Q, R]), dns_id=rng.randrange(4)) for i in range(400)]
    got = {r for r in run(spark, rows) if r[2] != "drain"}
    want = set()
    for key in {r[10] for r in rows}:
        own, pending = sorted((r[1], r[0], r[2]) for r in rows if r[10] == key), None
        while own:  # micro-batches of any size
            n = rng.randint(1, 9)
            out, pending = outcomes(own[:n], pending, TIMEOUT)
            want |= {(o[0], o[1], o[2], o[3], o[4]) for o in out}
            own = own[n:]
    assert got == want


def test_stream_times_out_restarts_and_drains(spark, tmp_path):
    """Packets in several stretches, the query started again for each: timers settle what nothing follows, and a tick the
    rest; with the causes put together it is what a batch run finds, and no state is left."""
    rng, step = random.Random(9), TIMEOUT // 3
    rows = [packet(i, T0 + i * step // 8 + rng.randrange(step // 8), rng.choice([Q, Q, R]), dns_id=rng.randrange(30)) for i in range(300)]
    rows.append(packet(300, rows[-1][1] + 20 * TIMEOUT, Q, dns_id=99))
    want = run(spark, rows)
    folder, left = str(tmp_path), []
    for k in range(0, len(rows), 100):
        part = spark.createDataFrame(rows[k : k + 100], FIELDS)
        part.write.mode("append").parquet(f"{folder}/in")
        left.append(pending_left(run_once(spark, folder, part.schema, TIMEOUT, "0 seconds")))
    assert left[0] > 0
    early = {r.seq: r.cause for r in spark.read.parquet(f"{folder}/out").collect()}
    assert sum(c == "timeout" for c in early.values()) > sum(r[2] == "timeout" for r in want)
    tick(part).write.mode("append").parquet(f"{folder}/in")
    assert pending_left(run_once(spark, folder, part.schema, TIMEOUT, "0 seconds")) == 0
    got = sorted((r.seq, r.outcome, r.cause, r.rtt_ns, r.rtt_valid) for r in spark.read.parquet(f"{folder}/out").collect())
    last = rows[-1][1]
    late = lambda r: "timeout" if r[2] == "drain" and rows[r[0]][1] + TIMEOUT < last - 1_000_000 else r[2]
    assert got == [(r[0], r[1], late(r), r[3], r[4]) for r in want]
    assert {r[2] for r in got} >= {"timeout", "drain", "collision"}


def arrive(spark, folder, rows, name="in"):
    part = spark.createDataFrame(rows, FIELDS).coalesce(1)
    part.write.mode("append").parquet(f"{folder}/{name}")
    return part


def found(spark, folder):
    return sorted((r.seq, r.outcome, r.cause, r.rtt_ns, r.rtt_valid) for r in spark.read.parquet(f"{folder}/out").collect())


def causes(want, rows, late):
    """A batch run's rows with the cause that a stream gives: what timed out before the last packet came isn't drained."""
    last = max(r[1] for r in rows) - late
    ns = {r[0]: r[1] for r in rows}
    return [(s, o, "timeout" if c == "drain" and ns[s] + TIMEOUT < last - 1_000_000 else c, *r) for s, o, c, *r in want]


def test_packets_out_of_order_over_micro_batches_equal_the_batch_form(spark, tmp_path):
    """Packets shuffled within the lateness, in several micro-batches, across a restart, give what the batch form gives."""
    rng = random.Random(3)
    rows = [packet(i, T0 + i * TIMEOUT // 6, rng.choice([Q, R]), dns_id=rng.randrange(5)) for i in range(120)]
    mixed = sorted(rows, key=lambda r: r[1] + rng.randrange(20 * TIMEOUT // 6))
    for k in range(0, 120, 30):
        part = arrive(spark, tmp_path, mixed[k : k + 30])
        if k in (30, 90):  # two files in one run, in micro-batches of their own
            run_once(spark, str(tmp_path), part.schema, TIMEOUT, "20 seconds", files=1)
    tick(part).write.mode("append").parquet(f"{tmp_path}/in")
    assert pending_left(run_once(spark, str(tmp_path), part.schema, TIMEOUT, "20 seconds")) == 0
    assert found(spark, tmp_path) == causes(run(spark, rows), rows, 4 * TIMEOUT)


def test_late_packets_are_given_and_a_stream_goes_on_after_a_tick(spark, tmp_path):
    first = [packet(0, T0, Q), packet(1, T0 + 10 * TIMEOUT, Q, dns_id=2)]
    part = arrive(spark, tmp_path, first)
    run_once(spark, str(tmp_path), part.schema, TIMEOUT, "0 seconds")
    arrive(spark, tmp_path, [packet(2, T0 + SOON, R), packet(3, T0 + 10 * TIMEOUT + SOON, R, dns_id=2)])
    run_once(spark, str(tmp_path), part.schema, TIMEOUT, "0 seconds")
    tick(part, T0 + 12 * TIMEOUT).write.mode("append").parquet(f"{tmp_path}/in")
    assert pending_left(run_once(spark, str(tmp_path), part.schema, TIMEOUT, "0 seconds")) == 0
    arrive(spark, tmp_path, [packet(4, T0 + 13 * TIMEOUT, Q), packet(5, T0 + 13 * TIMEOUT + SOON, R)])
    run_once(spark, str(tmp_path), part.schema, TIMEOUT, "0 seconds")
    tick(part).write.mode("append").parquet(f"{tmp_path}/in")
    run_once(spark, str(tmp_path), part.schema, TIMEOUT, "0 seconds")
    assert found(spark, tmp_path) == [
        (0, "UNANSWERED", "timeout", None, 0), (1, "OBSERVED", "", SOON, 1), (2, "LATE", "", None, 0), (4, "OBSERVED", "", SOON, 1),
    ]
    with pytest.raises(ValueError, match="caller's choice"):
        correlated(spark.readStream.schema(part.schema).parquet(f"{tmp_path}/in"), TIMEOUT)


def test_several_streams_of_which_one_is_far_behind(spark, tmp_path):
    """Queries come on one stream, responses on another, long after: nothing is late, as time is that of the stream behind."""
    rng = random.Random(8)
    rows = [packet(i, T0 + i * TIMEOUT // 5, rng.choice([Q, R]), dns_id=rng.randrange(3)) for i in range(80)]
    folder, inputs = str(tmp_path), {"fast": "0 seconds", "slow": "2 seconds"}
    fast, slow = ([r for r in rows if r[2] == kind] for kind in (Q, R))
    part = arrive(spark, folder, fast, "fast")
    arrive(spark, folder, slow[:5], "slow")
    run_once(spark, folder, part.schema, TIMEOUT, "", inputs)
    for k in range(5, len(slow), 20):
        arrive(spark, folder, slow[k : k + 20], "slow")
        run_once(spark, folder, part.schema, TIMEOUT, "", inputs)
    for name in inputs:
        tick(part).write.mode("append").parquet(f"{folder}/{name}")
    run_once(spark, folder, part.schema, TIMEOUT, "", inputs)
    got, want = found(spark, folder), run(spark, rows)
    assert [(r[0], r[1], r[3], r[4]) for r in got] == [(r[0], r[1], r[3], r[4]) for r in want]


def test_many_keys_settle_at_once_as_each_by_itself():
    """What a group of keys settles before a time, in steps, is what each key's packets give one by one; ties, packets without a
    number and queries that wait from one step to the next among them."""
    rng, names = random.Random(12), ["key", "ns", "seq", "numbered", "query"]
    rows = [(f"k{rng.randrange(40)}", T0 + rng.randrange(400) * TIMEOUT // 4, i if i % 50 else 0, i % 50 > 0, rng.random() < 0.5) for i in range(3000)]
    left = pd.DataFrame(rows, columns=names).iloc[:0]
    got, before = [], T0
    for at in [T0 + k * 12 * TIMEOUT for k in range(1, 9)] + [DRAIN_NS]:
        own = [r for r in rows if before <= r[1] < at]
        packets = pd.concat([left, pd.DataFrame(own, columns=names).astype(left.dtypes)], ignore_index=True)
        out, waiting, timer = settled(packets, at // 1_000_000, TIMEOUT)
        left, before = packets.iloc[waiting], at
        got += out.astype(object).where(out.notna(), None).values.tolist()
        due = [r.ns + TIMEOUT if r.query and r.ns < at else r.ns for r in left.itertuples()]
        assert timer == (min(due) // 1_000_000 if due else None)
    assert not len(left)
    want = []
    for k in sorted({r[0] for r in rows}):
        mine = sorted((r[1], r[2] if r[3] else -1, Q if r[4] else R) for r in rows if r[0] == k)
        out, pending = outcomes(mine, None, TIMEOUT)
        want += [*out, *([(pending[1], "UNANSWERED", "timeout", None, 0, None)] if pending else [])]
    plain = lambda x: "null" if x is None or x == -1 else "timeout" if x == "drain" else str(x)
    text = lambda found: sorted([plain(x) for x in r] for r in found)
    assert text(got) == text(want) and len(got) > 1500
    assert settled(left, 0, TIMEOUT)[2] is None
    last = pd.DataFrame([("k", 2**63 - 10, 1, True, True), ("k", 2**63 - 9, 2, True, False)], columns=names)
    assert settled(last, 2**53, TIMEOUT)[0]["outcome"].tolist() == ["OBSERVED"]


def test_a_stream_keeps_groups_of_keys(spark, tmp_path):
    """Several hundred keys are a few rows of state, a start with another number of groups finds them, and results are those of a
    batch run. A packet without a time is late and harms no number of its group."""
    rng, big = random.Random(5), 2**60 + 1
    rows = [packet(big + i, T0 + i * TIMEOUT // 400, rng.choice([Q, R]), dns_id=rng.randrange(300), qname=rng.choice(["a", "1:a", None])) for i in range(3000)]
    for k in (0, 1500):
        part = arrive(spark, tmp_path, rows[k : k + 1500] + [packet(k, None, R), packet(None, T0 + 500 * TIMEOUT, R, qname="other")][: 1 + k // 1500])
        query = run_once(spark, str(tmp_path), part.schema, TIMEOUT, "0 seconds", groups=4 if k == 0 else 7)
        assert 0 < pending_left(query) <= 4
    tick(part).write.mode("append").parquet(f"{tmp_path}/in")
    assert pending_left(run_once(spark, str(tmp_path), part.schema, TIMEOUT, "0 seconds")) == 0
    got = [(r.seq, r.outcome, r.rtt_ns, r.rtt_valid) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(r for r in got if r[0] is not None and r[0] >= big) == [(r[0], r[1], r[3], r[4]) for r in run(spark, rows)]
    assert {r for r in got if r[0] is None or r[0] < big} == {(0, "LATE", None, 0), (1500, "LATE", None, 0), (None, "UNMATCHED", None, 0)}
