"""Counters and round-trip quantiles of a stream of transactions by windows of event time, kept as they grow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wirelens.sources.tables import stored

#: Size of a quantile sketch: exact up to so many values, a rank error of about 0.0003 beyond (99 % of the time).
SKETCH = 4096
#: How far below and above a wanted rank the rows are looked through for it, some seven times a sketch's error.
NEAR = 0.002


def timed(transactions: DataFrame, lateness: str) -> DataFrame:
    """Transactions with their event time; a window is final once the latest one's time less ``lateness`` has passed it."""
    return transactions.withColumn("event_time", F.timestamp_micros(F.expr("observed_ns div 1000"))).withWatermark("event_time", lateness)


def _hour() -> Column:
    return (F.unix_seconds(F.col("window.start")) / 3600).cast("long").alias("hour")


def counters(transactions: DataFrame, width: str = "1 hour") -> DataFrame:
    """(hour, leg, outcome, n) of :func:`timed` transactions, the counts so far of each window that a micro-batch changes."""
    return transactions.groupBy(F.window("event_time", width), "leg", "outcome").agg(F.count(F.lit(1)).alias("n")).select(_hour(), "leg", "outcome", "n")


def sketches(transactions: DataFrame, width: str = "1 hour", size: int = SKETCH) -> DataFrame:
    """(hour, leg, n, sketch): valid round trips of each window as a KLL sketch, which merges with those of other windows.

    A sketch is a few kilobytes whatever it holds; tasks begin it, so a hot leg is pre-aggregated before the shuffle.
    """
    valid = transactions.where("rtt_valid = 1").groupBy(F.window("event_time", width), "leg")
    return valid.agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("rtt_ns", size).alias("sketch")).select(_hour(), "leg", "n", "sketch")


def kept(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Windows as each micro-batch changes them, into ``folder``/batch=<n>; a batch that runs again replaces its own."""
    write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/batch={n}")
    return rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """Each window as the last micro-batch left it."""
    rows = spark.read.parquet(folder)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return newest.select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


def quantiles(kept_: DataFrame, by: list[str], ranks: dict[str, float], size: int = SKETCH) -> DataFrame:
    """Quantiles over the merged sketches of each group, with the number of values."""
    merged = kept_.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", size).alias("_sketch"))
    return merged.select(*by, "n", *[F.kll_sketch_get_quantile_bigint("_sketch", F.lit(r)).alias(c) for c, r in ranks.items()])


def exact_quantiles(kept_: DataFrame, transactions: DataFrame, by: list[str], ranks: dict[str, float], size: int = SKETCH, near: float = NEAR) -> DataFrame:
    """The value of rank ceil(r * n) of each group's valid round trips, with their number n.

    Merged sketches give values a little below and above; a count of the rows up to them says which one in between it is, so only
    these are put in order. Where a sketch was further off than ``near``, all of the group's rows are.
    """
    edges = {f"{c}_{side}": min(max(r + way * near, 0.0), 1.0) for c, r in ranks.items() for side, way in (("low", -1), ("high", 1))}
    found = quantiles(kept_, by, edges, size)
    rank = {c: F.expr(f"cast(ceil({r:.6f} * n) AS bigint)") for c, r in ranks.items()}
    wanted = F.array(*[F.struct(F.lit(c).alias("name"), rank[c].alias("rank"), F.col(f"{c}_low").alias("low"), F.col(f"{c}_high").alias("high")) for c in ranks])
    bands = stored(found.select(*by, "n", F.explode(wanted).alias("w")).select(*by, "n", "w.*"), "bands")
    trips = transactions.where("rtt_valid = 1").select(*by, "rtt_ns")
    counted = trips.join(bands, by).groupBy(*by, "n", "name", "rank", "low", "high").agg(F.count_if(F.col("rtt_ns") < F.col("low")).alias("below"), F.count_if(F.col("rtt_ns") <= F.col("high")).alias("upto"))
    holds = (F.col("below") < F.col("rank")) & (F.col("rank") <= F.col("upto"))
    settled = counted.select(*by, "n", "name", "rank", *[F.when(holds, F.col(c)).alias(c) for c in ("low", "high")], F.when(holds, F.col("below")).otherwise(0).alias("below"))
    near_ = trips.join(stored(settled, "bands"), by).where("low IS NULL OR rtt_ns BETWEEN low AND high")
    nth = near_.withColumn("nth", F.row_number().over(Window.partitionBy(*by, "name").orderBy("rtt_ns"))).where("nth = rank - below")
    return nth.groupBy(*by, "n").agg(*[F.max(F.when(F.col("name") == c, F.col("rtt_ns"))).alias(c) for c in ranks])
