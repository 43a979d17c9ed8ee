"""Work on frames of events doesn't depend on how many row groups the table has, and decoders return Arrow arrays."""

from pyspark.sql import functions as F

from wirelens.operators import dhcp, dns
from wirelens.sources import rich_frames


def test_one_row_group_is_dealt_to_all_cores(spark):
    assert rich_frames.rows(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_decoders_return_arrow(spark):
    raw = spark.range(1).select(F.lit(b"").alias("raw"))
    for parse in (dhcp.parse4, dhcp.parse6, dns.parse):
        plan = raw.select(parse(F.col("raw")))._jdf.queryExecution().executedPlan().toString()
        assert "each(" in plan and "ArrowEvalPython" in plan
        assert raw.select(parse(F.col("raw")).alias("m")).first().m is None


def test_fragments_and_addresses():
    assert dhcp.addresses(bytes([192, 0, 2, 1, 255, 255, 255, 0, 9])) == ["192.0.2.1", "255.255.255.0"]
    assert dhcp.routes(bytes([24, 10, 0, 7, 192, 0, 2, 1])) == [{"destination": "10.0.7.0/24", "router": "192.0.2.1"}]
    raw = bytearray(240)
    raw[236:240] = dhcp.COOKIE
    found = dhcp.parsed4(bytes(raw) + bytes([12, 1, 97, 12, 1, 98, 15, 1, 99, 255]))
    assert [o["fragment"] for o in found["options"]] == [True, True, False] and found["hostname"] == "ab"
