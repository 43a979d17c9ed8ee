"""Queries matched with their responses: on each key a query is answered by the next packet if that is a response."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Key columns, as they identify a transaction on the wire.
KEY = ["transport", "ip_version", "client_ip", "client_port", "server_ip", "server_port", "dns_id", "qname", "qtype", "qclass"]


def _with_edges(packets: DataFrame, key: list[str], order: list[str], columns: list[str], width: int) -> DataFrame:
    """``packets`` cut into slices of ``width`` of the first column of ``order``, with what borders on each slice.

    Each (key, slice) is known by its first and last packet, found by an aggregation that each task begins by itself. A scan
    over these, in the order of slices, gives every slice two rows more: the last packet of the key's slice before
    (``_side`` -1) and the first one of the slice behind (1). So a slice can be worked on without the others.
    """
    cut = packets.withColumn("_slice", F.expr(f"`{order[0]}` div {width}"))
    own = [c for c in dict.fromkeys(["kind", "observed_ns", "seq", "rcode", *order, *columns]) if c not in key]
    ends = cut.groupBy(*key, "_slice").agg(*[f(F.struct(*own), F.struct(*order)).alias(n) for f, n in ((F.min_by, "_first"), (F.max_by, "_last"))])
    scan = Window.partitionBy(*key).orderBy("_slice")
    beside = ends.select(*key, "_slice", F.lag("_last").over(scan).alias("_before"), F.lead("_first").over(scan).alias("_behind"))
    sides = F.array(F.struct(F.lit(-1).alias("side"), F.col("_before").alias("p")), F.struct(F.lit(1).alias("side"), F.col("_behind").alias("p")))
    edges = beside.select(*key, "_slice", F.explode(F.filter(sides, lambda x: x["p"].isNotNull())).alias("_edge"))
    edges = edges.select(*key, "_slice", F.col("_edge.side").alias("_side"), *[F.col("_edge.p")[c].alias(c) for c in own])
    return cut.withColumn("_side", F.lit(0)).unionByName(edges, allowMissingColumns=True)


def transactions(
    packets: DataFrame,
    timeout_ns: int,
    lazy: bool = False,
    key: list[str] | None = None,
    order: list[str] | None = None,
    carry: list[str] | None = None,
    slice_width: int | None = None,
) -> DataFrame:
    """A row for each query (OBSERVED or UNANSWERED) and each response without one (UNMATCHED).

    ``packets`` holds kind (query or response), observed_ns, seq and the key. Eager: a query that its key's next packet
    finds older than the timeout is unanswered, and that packet, if a response, unmatched. Lazy: it is answered all the
    same, its round trip is marked invalid. The next packet being a query is a collision, none a drain. A gap of just
    the timeout is in time. Round trips are kept where invalid (negative or too long).

    ``carry`` names columns of which the response's value comes along too, as ``response_<name>``.

    One shuffle by key; a join would match a response to every query of its key. With ``slice_width``, in units of the first
    column of ``order``, a key's packets are worked on in slices of so many units, each with its neighbours' edges
    (:func:`_with_edges`): results are the same, and a key that has a large share of all packets runs in as many tasks as
    it has slices. ``packets`` is read twice then. Nulls in key or order are values like others, first in order.
    """
    key, order, carry = key or KEY, order or ["observed_ns", "seq"], carry or []
    rows = packets.where("kind IN ('query', 'response')")
    window = Window.partitionBy(*key).orderBy(*order)
    if slice_width is not None:
        rows = _with_edges(rows, key, order, carry, slice_width)
        window = Window.partitionBy(*key, "_slice").orderBy("_side", *order)
    near = rows.withColumns(
        {
            "next_kind": F.lead("kind").over(window),
            "next_ns": F.lead("observed_ns").over(window),
            "next_seq": F.lead("seq").over(window),
            "next_rcode": F.lead("rcode").over(window),
            **{f"next_{c}": F.lead(c).over(window) for c in carry},
            "last_kind": F.lag("kind").over(window),
            "last_ns": F.lag("observed_ns").over(window),
        }
    )
    if slice_width is not None:
        near = near.where("_side = 0").drop("_side", "_slice")
    in_time = F.lit(True) if lazy else F.col("next_ns") - F.col("observed_ns") <= timeout_ns
    was_live = (F.col("last_kind") == "query") & (F.lit(True) if lazy else F.col("observed_ns") - F.col("last_ns") <= timeout_ns)
    query = F.col("kind") == "query"
    observed = query & (F.col("next_kind") == "response") & in_time
    outcome = (
        F.when(F.coalesce(observed, F.lit(False)), "OBSERVED")
        .when(query, "UNANSWERED")
        .when(~F.coalesce(was_live, F.lit(False)), "UNMATCHED")
    )
    late = F.col("next_ns") - F.col("observed_ns") > timeout_ns
    cause = F.when(F.col("next_kind").isNull(), "drain").when((F.col("next_kind") == "query") & (~late | F.lit(lazy)), "collision").otherwise("timeout")
    rtt = F.col("next_ns") - F.col("observed_ns")
    is_observed = F.col("outcome") == "OBSERVED"
    return (
        near.withColumn("outcome", outcome)
        .where("outcome IS NOT NULL")
        .withColumns(
            {
                "cause": F.when(F.col("outcome") == "UNANSWERED", cause).otherwise(""),
                "rtt_ns": F.when(is_observed, rtt),
                "rtt_valid": F.when(is_observed & rtt.between(0, timeout_ns), 1).otherwise(0),
                "response_seq": F.when(is_observed, F.col("next_seq")).when(F.col("outcome") == "UNMATCHED", F.col("seq")),
                "rcode": F.when(is_observed, F.col("next_rcode")).when(F.col("outcome") == "UNMATCHED", F.col("rcode")),
                **{f"response_{c}": F.when(is_observed, F.col(f"next_{c}")).when(F.col("outcome") == "UNMATCHED", F.col(c)) for c in carry},
            }
        )
        .drop("next_kind", "next_ns", "next_seq", "next_rcode", "last_kind", "last_ns", *[f"next_{c}" for c in carry])
    )


#: What the oracle keeps of a packet besides its outcome.
KEPT = "seq, observed_ns, kind, user_id, transport, ip_version, client_ip, client_port, server_ip, server_port, dns_id, qname, qtype, qclass, message, mac"


def transactions_sql(timeout_ns: int, lazy: bool = False, table: str = "wire", key: list[str] = KEY, kept: str = KEPT) -> str:
    """The same over a table, for DuckDB."""
    in_time = "true" if lazy else f"next_ns - observed_ns <= {timeout_ns}"
    live = "true" if lazy else f"observed_ns - last_ns <= {timeout_ns}"
    late = "false" if lazy else f"next_ns - observed_ns > {timeout_ns}"
    key = ", ".join(key)
    return f"""
near AS (
  SELECT *, lead(kind) OVER k AS next_kind, lead(observed_ns) OVER k AS next_ns, lead(seq) OVER k AS next_seq,
    lead(rcode) OVER k AS next_rcode, lag(kind) OVER k AS last_kind, lag(observed_ns) OVER k AS last_ns
  FROM {table} WHERE kind <> 'dhcp' WINDOW k AS (PARTITION BY {key} ORDER BY observed_ns, seq)),
judged AS (
  SELECT *, CASE WHEN kind = 'query' AND next_kind = 'response' AND {in_time} THEN 'OBSERVED' WHEN kind = 'query' THEN 'UNANSWERED'
    WHEN NOT coalesce(last_kind = 'query' AND {live}, false) THEN 'UNMATCHED' END AS outcome FROM near),
tx AS (
  SELECT {kept}, outcome,
    CASE WHEN outcome <> 'UNANSWERED' THEN '' WHEN next_kind IS NULL THEN 'drain'
      WHEN next_kind = 'query' AND NOT ({late}) THEN 'collision' ELSE 'timeout' END AS cause,
    CASE WHEN outcome = 'OBSERVED' THEN next_ns - observed_ns END AS rtt_ns,
    CASE WHEN outcome = 'OBSERVED' AND next_ns - observed_ns BETWEEN 0 AND {timeout_ns} THEN 1 ELSE 0 END AS rtt_valid,
    CASE outcome WHEN 'OBSERVED' THEN next_seq WHEN 'UNMATCHED' THEN seq END AS response_seq,
    CASE outcome WHEN 'OBSERVED' THEN next_rcode WHEN 'UNMATCHED' THEN rcode END AS rcode
  FROM judged WHERE outcome IS NOT NULL)
"""
