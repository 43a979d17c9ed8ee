"""What the events are kept for: counters, rates, percentiles, histories, deduplicated views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wirelens.sources.tables import stored

HOUR_NS = 3600 * 1_000_000_000


def newest(rows: DataFrame, key: list[str], version: str) -> DataFrame:
    """One row of each key, that of the largest ``version``: pre-aggregated in each task, no sort of a key's rows."""
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), version).alias("_row"))
    return best.select("_row.*")


def outcome_counts(tx: DataFrame) -> DataFrame:
    return tx.groupBy("leg", "outcome").agg(F.count(F.lit(1)).alias("n"))


def rtt_percentiles(tx: DataFrame, width_ns: int = 1_000_000_000) -> DataFrame:
    """Exact percentiles (interpolated) of valid round trips by leg, in seconds.

    Round trips are counted in bins of ``width_ns``, whose number the timeout bounds; the bins' running counts tell which
    of them hold the wanted ranks, and only their rows are ranked. So no task gets all round trips of a leg.
    """
    trips = stored(tx.where("rtt_valid = 1").select("leg", "rtt_ns", F.expr(f"rtt_ns div {width_ns}").alias("bin")), "trips")
    upto = Window.partitionBy("leg").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = trips.groupBy("leg", "bin").agg(F.count(F.lit(1)).alias("own")).withColumn("upto", F.sum("own").over(upto))
    bins = bins.withColumns({"n": F.max("upto").over(Window.partitionBy("leg")), "first": F.col("upto") - F.col("own")})
    names = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(p) * (F.col("n") - 1)).alias("at")) for name, p in names.items()])
    ends = F.explode(F.array(F.floor("w.at"), F.ceil("w.at"))).alias("rank")
    ranks = bins.select("leg", "bin", "n", "first", "upto", F.explode(wanted).alias("w")).select("leg", "bin", "n", "first", "upto", "w.name", "w.at", ends)
    ranks = stored(ranks.where("rank >= first AND rank < upto").distinct(), "ranks")
    local = Window.partitionBy("leg", "bin").orderBy("rtt_ns")
    held = trips.join(ranks.select("leg", "bin").distinct(), ["leg", "bin"], "left_semi").withColumn("nth", F.row_number().over(local) - 1)
    found = held.join(ranks, ["leg", "bin"]).where("nth = rank - first")
    low, high = F.min("rtt_ns"), F.max("rtt_ns")
    value = low + (high - low) * F.max(F.col("at") - F.floor("at"))
    each = found.groupBy("leg", "n", "name").agg(F.round(value / 1e9, 6).alias("value"))
    return each.groupBy("leg", "n").agg(*[F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in names])


def average_rtt(tx: DataFrame) -> DataFrame:
    """Whole nanoseconds of an average valid round trip by leg, 0 where there is none."""
    valid = F.when(F.col("rtt_valid") == 1, F.col("rtt_ns"))
    sums = tx.groupBy("leg").agg(F.count(valid).alias("n"), F.coalesce(F.sum(valid), F.lit(0)).alias("total"))
    return sums.select("leg", "n", F.coalesce(F.expr("total div nullif(n, 0)"), F.lit(0)).alias("average_ns"))


def lag(entries: DataFrame, cursors: list[tuple[str, str, int]]) -> DataFrame:
    """(group, streams, lag): of each consumer group the entries after its cursors, over all its streams.

    ``cursors`` (group, stream, last sequence number read) is the caller's small configuration. Entries are counted once
    by stream and cursor, not once for each group.
    """
    places = entries.sparkSession.createDataFrame(cursors, "`group` string, stream string, cursor long")
    ahead = entries.join(F.broadcast(places), "stream").groupBy("group", "stream").agg(F.count_if(F.col("seq") > F.col("cursor")).alias("lag"))
    return ahead.groupBy("group").agg(F.count(F.lit(1)).alias("streams"), F.sum("lag").alias("lag"))


def error_rate(tx: DataFrame) -> DataFrame:
    """Of the answered transactions of each service role, the share with an error code."""
    out = tx.where("outcome = 'OBSERVED'").groupBy("service_role").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("rcode") != 0).alias("errors"))
    return out.withColumn("error_rate", F.round(F.col("errors") / F.col("n"), 6))


def hourly(tx: DataFrame) -> DataFrame:
    return tx.withColumn("hour", F.expr(f"observed_ns div {HOUR_NS}"))


def unanswered_rate(tx: DataFrame) -> DataFrame:
    out = hourly(tx.where("outcome <> 'UNMATCHED'")).groupBy("hour").agg(F.count(F.lit(1)).alias("queries"), F.count_if(F.col("outcome") == "UNANSWERED").alias("unanswered"))
    return out.withColumn("rate", F.round(F.col("unanswered") / F.col("queries"), 6))


def interval_counters(tx: DataFrame) -> DataFrame:
    return hourly(tx).groupBy("hour", "outcome").agg(F.count(F.lit(1)).alias("n"))


def cumulative_counters(tx: DataFrame) -> DataFrame:
    """Counts since the start at the end of each hour; the running sum is over the hours, not over the rows."""
    running = Window.partitionBy("outcome").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    return interval_counters(tx).select("hour", "outcome", F.sum("n").over(running).alias("total"))


def pending_depth(tx: DataFrame, timeout_ns: int) -> DataFrame:
    """Queries waiting at the end of each hour: +1 when one comes, -1 when it is answered or its time is over."""
    gone = F.col("observed_ns") + F.coalesce("rtt_ns", F.lit(timeout_ns))
    steps = F.array(F.struct(F.col("observed_ns").alias("at"), F.lit(1).alias("d")), F.struct(gone.alias("at"), F.lit(-1).alias("d")))
    changes = tx.where("outcome <> 'UNMATCHED'").select(F.explode(steps).alias("s")).select(F.expr(f"s.at div {HOUR_NS}").alias("hour"), "s.d")
    each = changes.groupBy("hour").agg(F.sum("d").alias("d"))
    running = Window.partitionBy(F.lit(0)).orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    return each.select("hour", F.sum("d").over(running).alias("depth"))


def lease_history(messages: DataFrame) -> DataFrame:
    """Every assignment of each client in order, numbered, with whether the address is another than before."""
    order = Window.partitionBy("mac").orderBy("observed_ns", "seq")
    own = messages.where("assigned_address IS NOT NULL")
    before = F.lag("assigned_address").over(order)
    return own.select("mac", "observed_ns", "seq", "assigned_address", F.row_number().over(order).alias("nth"), (~before.eqNullSafe(F.col("assigned_address"))).alias("changed"))


def leg_join(tx: DataFrame, within_ns: int) -> DataFrame:
    """Failed client-facing transactions with the upstream ones for the same name that began within ``within_ns`` after.

    The time range is cut into buckets of that length, so that the join has an equal key and each side meets only its
    neighbours in time.
    """
    bucket = F.expr(f"observed_ns div {within_ns}")
    failed = tx.where("leg = 'client_facing' AND outcome = 'OBSERVED' AND rcode = 2").select(F.col("seq").alias("client_seq"), "qname", F.col("observed_ns").alias("client_ns"), F.explode(F.array(bucket, bucket + 1)).alias("bucket"))
    upstream = tx.where("leg = 'recursion_upstream' AND outcome <> 'UNMATCHED'").select(F.col("seq").alias("upstream_seq"), "qname", "observed_ns", F.col("outcome").alias("upstream_outcome"), bucket.alias("bucket"))
    pairs = failed.join(upstream, ["qname", "bucket"]).where(F.col("observed_ns").between(F.col("client_ns"), F.col("client_ns") + within_ns))
    return pairs.select("client_seq", "upstream_seq", "qname", (F.col("observed_ns") - F.col("client_ns")).alias("gap_ns"), "upstream_outcome")
