"""Windows of a stream against a batch, across restarts, and merged sketches within their error."""

import random

from pyspark.sql import functions as F

from wirelens.streaming import windows

FIELDS = "seq long, observed_ns long, leg string, outcome string, rtt_ns long, rtt_valid int"
HOUR = 3600 * 10**9


def rows(seed, n, hours):
    draw = random.Random(seed)
    return [(i, draw.randrange(hours * HOUR), draw.choice("ab"), draw.choice(["OBSERVED", "UNANSWERED"]), draw.randrange(1000), draw.randrange(2)) for i in range(n)]


def test_windows_go_on_after_a_restart_and_forget_what_is_final(spark, tmp_path):
    folder = str(tmp_path)

    def run(some):
        spark.createDataFrame(some, FIELDS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(FIELDS).parquet(f"{folder}/in")
        query = windows.kept(windows.counters(windows.timed(stream, "2 hours")), f"{folder}/out", f"{folder}/state")
        query.awaitTermination()
        return query

    first = rows(1, 300, 3)
    second = [(i, ns + 2 * HOUR, *r) for i, ns, *r in rows(2, 300, 3)]
    run(first)
    last = run([*second, (0, 30 * HOUR, "a", "OBSERVED", 1, 1)])
    want = {}
    for _, ns, leg, outcome, *_ in [*first, *second, (0, 30 * HOUR, "a", "OBSERVED")]:
        want[ns // HOUR, leg, outcome] = want.get((ns // HOUR, leg, outcome), 0) + 1
    found = windows.latest(spark, f"{folder}/out", ["hour", "leg", "outcome"]).collect()
    assert {(r.hour, r.leg, r.outcome): r.n for r in found} == want and len(found) == len(want)
    assert sum(s["numRowsTotal"] for s in last.lastProgress["stateOperators"]) == 1  # windows that time has passed are no state


def test_merged_sketches_are_near_the_exact_quantiles(spark):
    n = 300_000
    values = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("rtt_ns"), (F.col("id") % 50).alias("hour"), F.lit("a").alias("leg"))
    kept = values.groupBy("hour", "leg").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("rtt_ns", windows.SKETCH).alias("sketch"))
    got = windows.quantiles(kept, ["leg"], {"p50": 0.5, "p99": 0.99}).first()
    exact = sorted(r[0] for r in values.select("rtt_ns").collect())
    import bisect

    assert got.n == n
    for rank, value in ((0.5, got.p50), (0.99, got.p99)):
        assert abs(bisect.bisect_right(exact, value) / n - rank) < 0.002


def test_exact_quantiles_from_sketches_that_are_not(spark):
    n = 30_000
    values = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("rtt_ns"), (F.col("id") % 50).alias("hour"), F.lit("a").alias("leg"), F.lit(1).alias("rtt_valid"))
    kept = values.groupBy("hour", "leg").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("rtt_ns", 64).alias("sketch"))
    exact = sorted(r[0] for r in values.select("rtt_ns").collect())
    want = (n, exact[n // 2 - 1], exact[n * 9 // 10 - 1], exact[n * 99 // 100 - 1])
    for near in (0.1, 0.0):  # the latter finds nothing between its edges
        got = windows.exact_quantiles(kept, values, ["leg"], {"p50": 0.5, "p90": 0.9, "p99": 0.99}, 64, near).first()
        assert (got.n, got.p50, got.p90, got.p99) == want
