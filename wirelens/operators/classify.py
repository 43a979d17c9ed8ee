"""Which leg of a resolution a transaction is on, and which service role its server has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DNS_PORT = 53


def leg(local: list[str], backend: list[str]) -> Column:
    """The leg by the server's address; ``unknown`` unless exactly one side has the DNS port.

    The address sets are the caller's configuration and become literals.
    """
    one = (F.col("client_port") == DNS_PORT) != (F.col("server_port") == DNS_PORT)
    server = F.when(F.col("server_port") == DNS_PORT, F.col("server_ip")).otherwise(F.col("client_ip"))
    known = F.when(server.isin(local), "client_facing").when(server.isin(backend), "backend").otherwise("recursion_upstream")
    return F.when(one, known).otherwise("unknown")


def with_service_role(df: DataFrame, roles: list[tuple[int, str, str]]) -> DataFrame:
    """``df`` with ``service_role`` by server_ip: the first entry of an address wins, none is ''. Only legs that are
    known have roles."""
    spark: SparkSession = df.sparkSession
    first: dict[str, str] = {}
    for _, ip, label in sorted(roles):
        first.setdefault(ip, label)
    table = spark.createDataFrame(sorted(first.items()), "server_ip string, _role string")
    joined = df.join(F.broadcast(table), "server_ip", "left")
    role = F.when(F.col("leg") != "unknown", F.coalesce("_role", F.lit(""))).otherwise("")
    return joined.withColumn("service_role", role).drop("_role")


def always_emitted() -> Column:
    """Transactions that sampling never drops: without an answer or a query, failed, or about unusual types."""
    return (F.col("outcome") != "OBSERVED") | (F.coalesce(F.col("rcode"), F.lit(0)) != 0) | ~F.col("qtype").isin(1, 28)
