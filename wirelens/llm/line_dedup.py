"""Line dedup: lines that many documents share stay in one of them only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelens.llm.common import TRIMMED, durable, lower_ascii, same_keys, unused

MIN_CHARS = 40
MIN_DOCUMENTS = 5


def line_key(line):
    """The line stripped of blanks at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(TRIMMED)))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``.

    Lines are split at ``\\n``, keyed by :func:`line_key` and hashed to 128 bits. A key of at least ``min_chars`` code
    points that at least ``min_documents`` distinct documents hold loses its lines everywhere but in the largest
    doc_id that holds it. The other lines keep their order.

    Texts are split and hashed once, into a stored table of (key, document, position). Counting goes through a partial
    count per task and one count per (key, document), so a line of a third of all documents meets no single task. Shared
    keys are stored too, so that both sides of the join back are plain tables, of which Spark splits a skewed partition.

    Cases: null or empty text is one empty line. Rows with one doc_id are one document when counting, and each is cut
    by itself. Rows with null doc_id count as one document, below all others. An empty table gives no rows. Other
    columns, of any name, pass unchanged; the three names added here replace columns of the same name.
    """
    docs = docs.drop("kept_text", "n_lines", "n_dropped")
    lines = (
        docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("text"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("doc", "text", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc", "text", "pos", F.unhex(F.md5(F.col("key").cast("binary"))).alias("hash"))
    )
    lines = durable(lines, "lines")
    holders = lines.select("hash", "doc").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("keeper"))
    shared = durable(holders.where(F.col("n") >= min_documents).select("hash", "keeper"), "shared")
    gone = lines.join(shared, "hash").where(~F.col("doc").eqNullSafe(F.col("keeper"))).groupBy("doc", "text").agg(F.collect_set("pos").alias("gone"))
    hash_, dropped = unused([*docs.columns, "kept_text", "n_lines", "n_dropped"], "hash", "dropped")
    gone = gone.select(F.col("doc").alias("doc_id"), F.col("text").alias(hash_), F.col("gone").alias(dropped))
    joined = same_keys(docs.withColumn(hash_, F.xxhash64("text")), gone, ["doc_id", hash_], "left")
    split = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    counted = joined.withColumns({"n_lines": F.size(split).cast("long"), "n_dropped": F.coalesce(F.size(dropped), F.lit(0)).cast("long")})
    left = F.element_at(
        F.transform(
            F.array(F.struct(split.alias("lines"), F.col(dropped).alias("gone"))),
            lambda x: F.array_join(
                F.transform(F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["gone"]), lambda p: F.get(x["lines"], p)), "\n"
            ),
        ),
        1,
    )
    kept = F.when(F.col("n_dropped") == 0, F.coalesce("text", F.lit(""))).otherwise(left)
    return counted.withColumn("kept_text", kept).select(*docs.columns, "kept_text", "n_lines", "n_dropped")


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT a.doc_id, a.pos, a.line, (s.k IS NOT NULL AND a.doc_id <> s.keeper) AS gone
  FROM keyed a LEFT JOIN shared s ON a.k = s.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
