"""Slots of keys, reads by id, and the lines of a running stream's counters."""

import json
import time

from pyspark.sql import functions as F

from wirelens.functions.slots import crc16, hash_tag, slot
from wirelens.operators import delivery
from wirelens.sources.wire import wire
from wirelens.streaming import correlator, stats
from wirelens.streaming.correlator import run_once, tick

SF = "/root/testdata/sf0.001"


def test_slots(spark):
    def plain(data):
        crc = 0
        for b in data:
            crc ^= b << 8
            for _ in range(8):
                crc = (crc << 1 ^ 0x1021) & 0xFFFF if crc & 0x8000 else crc << 1
        return crc

    keys = ["123456789", "", "{user1000}.following", "{user1000}.followers", "foo{}{bar}", "foo{{bar}}zap", "foo{bar}{zap}", "a{b", "}{x}", "ä{ö}", "{\n}", "x" * 3000, None]
    tags = ["123456789", "", "user1000", "user1000", "foo{}{bar}", "{bar", "bar", "a{b", "x", "ö", "\n", "x" * 3000, None]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, key string").select("i", hash_tag(F.col("key")).alias("tag"), slot(F.col("key")).alias("slot"), crc16(F.encode("key", "UTF-8")).alias("crc")).orderBy("i").collect()
    assert [r.tag for r in rows] == tags
    assert [r.slot for r in rows] == [None if t is None else plain(t.encode()) % 16384 for t in tags]
    assert rows[0].crc == 0x31C3 and rows[12].crc is None


def test_one_id_reads_one_bucket(spark, tmp_path):
    path, entries = str(tmp_path / "t"), delivery.entries(wire(spark, SF))
    twice = entries.unionByName(entries.where("seq = 5"))
    delivery.keep_by_id(twice, path, 16)
    ids = {r.seq: r.entry_id for r in entries.where("seq IN (5, 6)").collect()}
    found = delivery.read_by_id(spark, path, [ids[5]], 16)
    assert [r.seq for r in found.collect()] == [5, 5] and found.columns == entries.columns
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in filters and "EqualTo(entry_id" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert sorted(r.seq for r in delivery.read_by_id(spark, path, [ids[6], ids[5], "0-0"], 16).collect()) == [5, 5, 6]
    assert delivery.read_by_id(spark, path, ["0-0"], 16).collect() == [] and delivery.read_by_id(spark, path, [], 16).collect() == []


def test_lines_of_a_listener(spark, tmp_path):
    """Lines written while the stream runs sum up to what it gave."""
    said = []
    listener = stats.StatsListener(said.append)
    spark.streams.addListener(listener)
    try:
        packets = wire(spark, SF).where("kind <> 'dhcp'")
        packets.where("seq % 2 = 0").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        packets.where("seq % 2 = 1").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        tick(packets).write.mode("append").parquet(f"{tmp_path}/in")
        run_once(spark, str(tmp_path), packets.schema, 10**12, "10 days")
        want = {r.outcome.lower(): r["count"] for r in spark.read.schema(correlator.OUT).parquet(f"{tmp_path}/out").groupBy("outcome").count().collect()}
        deadline = time.time() + 60
        while time.time() < deadline and (not said or {k: v for k, v in json.loads(said[-1])["total"].items() if k != "rtt_valid" and v} != want):
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    found = [json.loads(x) for x in said]
    assert {k: v for k, v in found[-1]["total"].items() if k != "rtt_valid" and v} == want and sum(want.values()) > 100
    assert {k: sum(x["interval"][k] for x in found) for k in found[-1]["total"]} == found[-1]["total"]


def test_lines_of_a_run_with_restarts_from_few_groups(spark):
    """Totals go on over all starts and are the table's, and a micro-batch has a row of state for a group of clients, not for each."""
    seen, sf = [], "/root/testdata/sf0.01"
    found = correlator.run_available_now(spark, sf, 6 * 3600 * 10**9, seen=seen)
    want = {r.outcome.lower(): r["count"] for r in found.groupBy("outcome").count().collect()}
    total = [json.loads(line)["total"] for line in stats.lines(seen)][-1]
    assert {k: v for k, v in total.items() if k != "rtt_valid" and v} == want and sum(want.values()) > 7000
    rows = max(s["numRowsTotal"] for p in seen for s in p.stateOperators)
    clients = wire(spark, sf).where("kind <> 'dhcp'").select("user_id").distinct().count()
    assert 0 < rows <= 64 < clients


def test_a_run_has_the_partitions_of_state_that_its_packets_are_worth(spark, tmp_path):
    """Few packets have few partitions of state whatever the session's number, which stays; later starts go on with the first one's."""
    name, sf = "spark.sql.shuffle.partitions", "/root/testdata/sf0.01"
    before, seen, parts = spark.conf.get(name), [], lambda found: {s.numShufflePartitions for p in found for s in p.stateOperators}
    spark.conf.set(name, 24)
    try:
        found = correlator.run_available_now(spark, sf, 6 * 3600 * 10**9, seen=seen)
        assert parts(seen) == {1} and spark.conf.get(name) == "24"
        assert found.count() == sum(json.loads(line)["interval"][k] for line in stats.lines(seen) for k in ("observed", "unanswered", "unmatched", "late")) > 7000
        packets, given = wire(spark, SF).where("kind <> 'dhcp'"), []
        for one, partitions in ((packets, 3), (tick(packets), None)):
            one.write.mode("append").parquet(f"{tmp_path}/in")
            given += run_once(spark, str(tmp_path), packets.schema, 10**12, "10 days", partitions=partitions).recentProgress
        assert parts(given) == {3} and given[-1].stateOperators[0].numRowsTotal == 0
    finally:
        spark.conf.set(name, before)
    assert [correlator._partitions(n, 64 + n // correlator.PER_GROUP, cores) for n, cores in ((0, 12), (80_000, 12), (29_000_000, 12), (400_000_000, 12), (60_000_000, 9000))] == [1, 2, 12, 100, 1201]
