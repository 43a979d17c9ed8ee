"""What a stream's consumer does with entries: checks, dead letters, retention, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wirelens.functions.slots import slot

SCHEMA, ENCODING = "wire.v1.Event", "protobuf"


def entries(wire: DataFrame) -> DataFrame:
    """Packets as stream entries; some of them with a wrong schema, encoding or kind of payload."""
    seq = F.col("seq")
    return wire.select(
        F.when(F.col("kind") == "dhcp", "events.dhcpv4").otherwise("events.dns").alias("stream"),
        F.concat(F.expr("observed_ns div 1000000").cast("string"), F.lit("-"), seq.cast("string")).alias("entry_id"),
        F.when(seq % 97 == 0, "wire.v0.Event").otherwise(SCHEMA).alias("schema"),
        F.when(seq % 89 == 0, "json").otherwise(ENCODING).alias("encoding"),
        F.when(seq % 83 == 0, F.lit(None).cast("string")).when(seq % 79 == 0, "dhcpv4_lease").when(F.col("kind") == "dhcp", "dhcpv4_packet").otherwise("dns_transaction").alias("payload_kind"),
        "seq",
        "observed_ns",
    )


def rejection(lease_is_fine: bool = False) -> Column:
    """Why an entry can't be decoded, or null. Lease events are fine for metrics (they give no points), not for rows."""
    known = ["dhcpv4_packet", "dhcpv6_packet", "dns_transaction", *(["dhcpv4_lease"] if lease_is_fine else [])]
    return (
        F.when(F.col("encoding") != ENCODING, "encoding")
        .when(F.col("schema") != SCHEMA, "schema")
        .when(F.col("payload_kind").isNull() | ~F.col("payload_kind").isin(known), "payload")
    )


def dead_letters(rows: DataFrame) -> DataFrame:
    """reason, origin and error of the entries that can't be decoded; the others are left out."""
    return rows.withColumn("error", rejection()).where("error IS NOT NULL").select(
        F.lit("decode_error").alias("reason"), F.col("stream").alias("origin_stream"), F.col("entry_id").alias("origin_id"), "error"
    )


def retained(rows: DataFrame, most: int) -> DataFrame:
    """Each stream's newest ``most`` entries. The limit of a window is applied in each task before the shuffle."""
    newest = Window.partitionBy("stream").orderBy(F.desc("observed_ns"), F.desc("seq"))
    return rows.withColumn("nth", F.row_number().over(newest)).where(F.col("nth") <= most).drop("nth")


def recent(rows: DataFrame, most: int) -> DataFrame:
    """The newest entries over all streams, as a top-k report."""
    return rows.orderBy(F.desc("observed_ns"), F.desc("seq")).limit(most)


def bucket_of(entry_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(entry_id), F.lit(buckets))


def keep_by_id(rows: DataFrame, path: str, buckets: int = 1024) -> None:
    """Entries as a table to read single ones of: folders by a hash of the id, in each the order of ids, which gives row groups
    narrow ranges, and a Bloom filter for each row group."""
    dealt = rows.withColumn("bucket", bucket_of(F.col("entry_id"), buckets)).repartition("bucket").sortWithinPartitions("bucket", "entry_id")
    dealt.write.mode("overwrite").partitionBy("bucket").option("parquet.bloom.filter.enabled#entry_id", "true").option("parquet.enable.dictionary#entry_id", "false").parquet(path)


def read_by_id(spark: SparkSession, path: str, ids: list[str], buckets: int = 1024) -> DataFrame:
    """The entries of a few ids, from a table of :func:`keep_by_id`: only their buckets are listed and read, and of these the
    row groups that may hold them. Ids that there aren't give no row; an id that is held twice gives both."""
    if not ids:
        return spark.read.parquet(path).where("false").drop("bucket")
    numbers = spark.range(1).select(*[bucket_of(F.lit(i), buckets).alias(f"b{k}") for k, i in enumerate(ids)]).first()
    return spark.read.parquet(path).where(F.col("bucket").isin(*set(numbers)) & F.col("entry_id").isin(*ids)).drop("bucket")


def stream_keys(wire: DataFrame) -> DataFrame:
    """(seq, key) of the streams that packets go to: with the client as hash tag, with an empty or an open one, or with none."""
    seq, client = F.col("seq"), F.col("client_ip")
    forms = [F.concat(F.lit("events:{"), client, F.lit("}:"), seq.cast("string")), F.concat(F.lit("events:"), F.col("qname"), F.lit(":"), seq.cast("string")), F.concat(F.lit("{}events:{"), client, F.lit("}")), F.concat(F.lit("events:{"), client), F.concat(F.lit("é{ü"), F.col("qname"), F.lit("}{"), seq.cast("string"), F.lit("}"))]
    return wire.select("seq", F.element_at(F.array(*forms), (seq % len(forms) + 1).cast("int")).alias("key"))


def slotted(rows: DataFrame) -> DataFrame:
    """``rows`` with the ``slot`` of their ``key``."""
    return rows.withColumn("slot", slot(F.col("key")))
