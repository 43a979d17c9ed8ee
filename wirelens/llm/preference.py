"""Preference formatting: the turns that a chosen and a rejected conversation share, once, and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelens.llm.common import durable, let

TRAINED_ROLE = "assistant"


def rendered(turn: Column) -> Column:
    """A turn as text; a null role is ``unknown`` and a null text is empty."""
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("unknown")), F.lit("|>\n"), F.coalesce(turn["text"], F.lit("")), F.lit("\n"))


def _spans(turns: Column) -> Column:
    """Of the rendered turns, the characters [start, stop) that are trained on: texts of the assistant's turns, with
    the line break that ends them, in order."""

    def add(acc: Column, turn: Column) -> Column:
        stop = acc["at"] + F.char_length(rendered(turn))
        start = stop - F.char_length(F.coalesce(turn["text"], F.lit(""))) - 1
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct(stop.alias("at"), F.when(turn["role"] == TRAINED_ROLE, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))
    return F.aggregate(turns, none, add, lambda acc: acc["spans"])


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: rendered(t)), "")


def ordered(turns: Column) -> Column:
    """A conversation's turns (turn, role, text) in the order of these three, nulls first."""
    return F.sort_array(F.collect_list(turns))


def format_sides(pairs: DataFrame) -> DataFrame:
    """``pairs`` (pair_id, chosen, rejected: arrays of turns in order) as prompt, completions and their trained spans.

    The longest common prefix of turns (equal role and text; turn numbers don't matter) is rendered once as ``prompt``;
    ``chosen`` and ``rejected`` hold the rest of each side. The loss mask of a completion is the array of its spans: the
    assistant's texts, each with the line break that ends it; prompts are never trained. Native, without a shuffle.

    Cases: a null side is an empty one. Identical sides give two empty completions. A null role is rendered as
    ``unknown``, a null text as an empty one, and nulls equal each other. Other columns aren't read.
    """
    none = F.array().cast("array<struct<turn:long,role:string,text:string>>")
    sides = pairs.select("pair_id", F.coalesce("chosen", none).alias("a"), F.coalesce("rejected", none).alias("b"))
    same = F.zip_with("a", "b", lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    # zip_with fills the shorter side with nulls, which a turn of nulls would equal
    shorter = F.least(F.size("a"), F.size("b"))
    common = let(same, lambda s: F.when(F.array_contains(s, False), F.array_position(s, F.lit(False)).cast("int") - 1).otherwise(F.size(s)))
    cut = sides.withColumn("n_common", F.least(common, shorter))
    rest = [F.slice(side, F.col("n_common") + 1, F.size(side)) for side in ("a", "b")]
    return cut.select(
        "pair_id",
        F.size("a").alias("n_chosen"),
        F.size("b").alias("n_rejected"),
        "n_common",
        _text(F.slice("a", F.lit(1), F.col("n_common"))).alias("prompt"),
        _text(rest[0]).alias("chosen"),
        _spans(rest[0]).alias("chosen_spans"),
        _text(rest[1]).alias("rejected"),
        _spans(rest[1]).alias("rejected_spans"),
    )


def format_preferences(turns: DataFrame) -> DataFrame:
    """A row for each pair, as :func:`format_sides` makes it, from a row for each turn.

    ``turns`` holds pair_id, chosen (boolean), turn, role and text. A side's turns are taken in the order of turn, then
    role, then text, nulls first. One shuffle brings a pair's turns together; a conversation, like a document, is one
    row, and nothing larger is gathered.

    Cases: a pair of which one side is missing has no common turn and an empty completion on that side. Rows without
    pair_id or side belong to no pair and give nothing. Repeated turns stay repeated. Other columns of ``turns`` are not
    read. No rows give no rows.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), "role", "text")
    sides = [ordered(F.when(F.col("chosen") == side, turn)).alias(name) for name, side in (("chosen", True), ("rejected", False))]
    return format_sides(turns.where("pair_id IS NOT NULL AND chosen IS NOT NULL").groupBy("pair_id").agg(*sides))


def with_other_answer(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected) of each conversation: itself, and itself with its last answer taken from another one.

    ``turns`` holds conv_id, turn, role and text. The rejected side is the same conversation up to its last assistant
    turn, whose text is that of the last assistant turn of conversation conv_id + 1 (empty if there is none); what
    follows that turn stays on both sides. So pairs share all turns before that answer.

    Cases: a conversation without an assistant turn has two equal sides. Rows without conv_id give nothing. Repeated
    turns stay; only the last one is replaced.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), "role", "text")
    whole = durable(turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(ordered(turn).alias("chosen")), "conversations")
    at = F.array_position(F.reverse(F.transform("chosen", lambda t: F.coalesce(t["role"], F.lit("")))), F.lit(TRAINED_ROLE)).cast("int")
    placed = whole.withColumn("last", F.when(at > 0, F.size("chosen") - at))
    answer = placed.where("last IS NOT NULL").select((F.col("conv_id") - 1).alias("conv_id"), F.get("chosen", F.col("last"))["text"].alias("answer"))
    replaced = F.transform(
        "chosen",
        lambda t, i: F.when(i == F.col("last"), F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.coalesce("answer", F.lit("")).alias("text"))).otherwise(t),
    )
    return placed.join(answer, "conv_id", "left").select(F.col("conv_id").alias("pair_id"), "chosen", replaced.alias("rejected"))


def op3_chat_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with another one's last answer; spans as text, ``start-stop`` with commas."""
    out = format_sides(with_other_answer(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")))
    for side in ("chosen", "rejected"):
        spans = F.array_join(F.transform(f"{side}_spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ",")
        out = out.withColumn(f"{side}_spans", spans)
    return out


OP3_SQL = r"""
WITH c0 AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos, role, text
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, max(pos) AS last FROM c0 WHERE role = 'assistant' GROUP BY 1),
answer AS (SELECT c0.conv_id - 1 AS conv_id, text AS answer FROM c0 JOIN l ON c0.conv_id = l.conv_id AND c0.pos = l.last),
u AS (
  SELECT conv_id AS pair_id, 0 AS side, pos, role, text FROM c0
  UNION ALL
  SELECT c0.conv_id, 1, pos, role, CASE WHEN pos = l.last THEN coalesce(answer.answer, '') ELSE text END
  FROM c0 LEFT JOIN l ON c0.conv_id = l.conv_id LEFT JOIN answer ON c0.conv_id = answer.conv_id),
t AS (SELECT *, '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) AS r FROM u),
p AS (SELECT pair_id, (count(*) FILTER (WHERE side = 0))::INT AS n_chosen, (count(*) FILTER (WHERE side = 1))::INT AS n_rejected
      FROM t GROUP BY 1),
bad AS (
  SELECT a.pair_id, min(a.pos) AS pos FROM t a JOIN t b ON a.pair_id = b.pair_id AND a.pos = b.pos AND a.side = 0 AND b.side = 1
  WHERE a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text GROUP BY 1),
c AS (SELECT p.*, least(coalesce(bad.pos - 1, n_chosen), n_chosen, n_rejected)::INT AS n_common FROM p LEFT JOIN bad USING (pair_id)),
x AS (
  SELECT t.*, c.n_common,
         sum(length(r)) OVER (PARTITION BY t.pair_id, side, pos > n_common ORDER BY pos) AS stop
  FROM t JOIN c USING (pair_id)),
s AS (
  SELECT pair_id,
         string_agg(r, '' ORDER BY pos) FILTER (WHERE side = 0 AND pos <= n_common) AS prompt,
         string_agg(r, '' ORDER BY pos) FILTER (WHERE side = 0 AND pos > n_common) AS chosen,
         string_agg(r, '' ORDER BY pos) FILTER (WHERE side = 1 AND pos > n_common) AS rejected,
         string_agg((stop - length(coalesce(text, '')) - 1)::VARCHAR || '-' || stop::VARCHAR, ',' ORDER BY pos)
           FILTER (WHERE side = 0 AND pos > n_common AND role = 'assistant') AS chosen_spans,
         string_agg((stop - length(coalesce(text, '')) - 1)::VARCHAR || '-' || stop::VARCHAR, ',' ORDER BY pos)
           FILTER (WHERE side = 1 AND pos > n_common AND role = 'assistant') AS rejected_spans
  FROM x GROUP BY 1)
SELECT pair_id, n_chosen, n_rejected, n_common, coalesce(prompt, '') AS prompt, coalesce(chosen, '') AS chosen,
       coalesce(chosen_spans, '') AS chosen_spans, coalesce(rejected, '') AS rejected, coalesce(rejected_spans, '') AS rejected_spans
FROM c JOIN s USING (pair_id)
"""
