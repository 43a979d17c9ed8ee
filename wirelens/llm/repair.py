"""Repair of the structure of conversations by the cheapest edits, found by dynamic programming over rank-compressed layers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wirelens.llm.common import TRIMMED, durable, same_keys
from wirelens.llm.crc_sql import CRC_TABLE, crc32_of

ENDS = ".!?"
#: A row's first fault.
FINE, BLANK, DUPLICATE, TRUNCATED = "fine", "blank", "duplicate", "truncated"
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: What stands at the end of the repaired conversation so far: nothing, a system, a user or an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: What an inserted or re-roled turn becomes after each of these, so what stands at the end then.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Macro edits, a run of inserts and what happens to the row behind them. No code begins another one, and they are in ASCII
#: order, so of two rows of codes the first difference decides, by its place here.
CODES = sorted("I" * run + edit for run in range(3) for edit in "DKR")
LEAST_HASH = hashlib.sha256(b"").hexdigest()


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): turns with the faults that CRC-32 of ``conv_id:turn`` deals out, for tests of repair.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 removes the marks that end sentences, 3 repeats it, 4 makes it a
    user's. A null counts as one space, in the hash and as role or text.
    """
    space = F.lit(" ")
    drawn = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    copies = F.when(drawn == 0, 0).when(drawn == 3, 2).otherwise(1)
    made = turns.select(
        "conv_id",
        "turn",
        F.when(drawn == 4, NAMES[USER]).otherwise(role).alias("role"),
        F.when(drawn == 1, "").when(drawn == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), copies)),
    )
    return made.drop("col")


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def examined(turns: DataFrame) -> DataFrame:
    """A stored row for each turn: conv_id, turn, role, text, idx (from 1), fault and whether it may not follow the one before.

    Rows of a conversation are in the order of turn (nulls first), then role, then text. They stream through a sort of
    their partition; none is gathered.
    """
    space = F.lit(" ")
    whole = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    by_conv = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    by_text = Window.partitionBy("conv_id", "role", "text").orderBy("idx")
    placed = whole.withColumn("idx", F.row_number().over(by_conv)).withColumn("before", F.lag("role").over(by_conv))
    placed = placed.withColumn("nth", F.row_number().over(by_text))
    core = F.btrim("text", F.lit(TRIMMED))
    last = F.substring(core, -1, 1)
    fault = F.when(core == "", BLANK).when(F.col("nth") > 1, DUPLICATE).when(~last.isin(*ENDS), TRUNCATED).otherwise(FINE)
    follows = F.concat(_initial(F.col("before")), _initial(F.col("role"))).isin("su", "ua", "au")
    return durable(placed.select("conv_id", "turn", "role", "text", "idx", fault.alias("fault"), (F.col("before").isNotNull() & ~follows).alias("illegal")), "examined")


class Plans:
    """Layers of the cheapest repairs of a conversation's first rows, one for each thing that may stand at the end.

    A layer is what the next one needs: costs above the layer's least, and the ranks of the four audit strings among each
    other in place of the strings. As every row adds one code and no code begins another, the strings of a layer compare
    as (rank before, place of the code). Layers and the pointers from one to the next are worked out once each.
    """

    def __init__(self):
        self.first = ((0, None, None, None), (0, None, None, None))
        self.known: dict[tuple, tuple] = {}

    def step(self, layer: tuple, initial: str, fault: str) -> tuple:
        """(next layer, its least cost above this one's, pointers): a pointer is the end before and the code."""
        if initial not in "sua":
            initial = ""
        found = self.known.get((layer, initial, fault))
        if found is None:
            found = self.known[layer, initial, fault] = self._step(*layer, initial, fault)
        return found

    def _step(self, costs: tuple, ranks: tuple, initial: str, fault: str) -> tuple:
        best: list[tuple | None] = [None] * 4
        for end in range(4):
            if costs[end] is None:
                continue
            for code, name in enumerate(CODES):
                at, cost = end, costs[end] + INSERT * name.count("I")
                for _ in range(name.count("I")):
                    at = NEXT[at]
                edit = name[-1]
                if edit == "D":
                    to, cost = at, cost + DELETE
                elif fault in (BLANK, DUPLICATE):
                    continue
                elif edit == "R":
                    to, cost = NEXT[at], cost + REROLE
                elif initial == "s" and at == NOTHING:
                    to = SYSTEM
                elif initial == NAMES[NEXT[at]][0]:
                    to = NEXT[at]
                else:
                    continue
                way = (cost + CUT * (fault == TRUNCATED and edit != "D"), ranks[end], code, end)
                if best[to] is None or way < best[to]:
                    best[to] = way
        least = min(w[0] for w in best if w)
        order = sorted((w[1:3], to) for to, w in enumerate(best) if w)
        rank = {to: k for k, (_, to) in enumerate(order)}
        layer = (tuple(w and w[0] - least for w in best), tuple(rank.get(to) for to in range(4)))
        return layer, least, bytes((w[3] << 4 | w[2]) if w else 255 for w in best)

    def finish(self, layer: tuple) -> tuple[int, int, int]:
        """(cost above the layer's least, end, inserts behind the last row) of the cheapest whole repair, ties ASCII-least."""
        costs, ranks = layer
        ways = []
        for end in range(4):
            at = end
            for run in range(3):
                if costs[end] is not None and at in (NOTHING, ASSISTANT):
                    ways.append((costs[end] + INSERT * run, ranks[end], run, end))
                at = NEXT[at]
        cost, _, run, end = min(ways)
        return cost, end, run


PLAN = "idx int, inserted array<string>, role string, place long, audit string, cost long"


def _plan(width: pa.DataType):
    """Rows (conv_id, idx, initial, fault) in order to rows of ``PLAN``."""
    kinds = [width, pa.int32(), pa.list_(pa.string()), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", *[c.split()[0] for c in PLAN.split(", ")]]

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = Plans()

        def repaired(conv, layer: tuple, cost: int, pointers: bytearray) -> Iterator[tuple]:
            more, end, run = plans.finish(layer)
            codes = bytearray()
            for at in range(len(pointers) - 4, -4, -4):
                codes.append(pointers[at + end] & 15)
                end = pointers[at + end] >> 4
            codes.reverse()
            audit = "".join(map(CODES.__getitem__, codes)) + "I" * run
            at, place = NOTHING, 0
            for k, code in enumerate(codes):
                name, inserted, role = CODES[code], [], None
                for _ in name[:-1]:
                    at = NEXT[at]
                    inserted.append(NAMES[at])
                if name[-1] == "R":
                    at = NEXT[at]
                    role = NAMES[at]
                elif name[-1] == "K":
                    # the only turn kept at the beginning that isn't a user's is a system's
                    at, role = (SYSTEM if at == NOTHING and initials[k] == "s" else NEXT[at]), ""
                yield conv, k + 1, inserted, role, place, None, None
                place += len(inserted) + (role is not None)
            inserted = []
            for _ in range(run):
                at = NEXT[at]
                inserted.append(NAMES[at])
            yield conv, len(codes) + 1, inserted, None, place, audit, cost + more

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        out: list[tuple] = []
        now, layer, cost, pointers, initials = None, None, 0, bytearray(), []
        for batch in batches:
            for conv, idx, initial, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if idx == 1:
                    if layer is not None:
                        for row in repaired(now, layer, cost, pointers):
                            out.append(row)
                            if len(out) == 10_000:
                                yield packed(out)
                                out = []
                    now, layer, cost, pointers, initials = conv, plans.first, 0, bytearray(), []
                layer, least, ways = plans.step(layer, initial, fault)
                cost += least
                pointers += ways
                initials.append(initial)
        if layer is not None:
            out += repaired(now, layer, cost, pointers)
        for at in range(0, len(out), 10_000):
            yield packed(out[at : at + 10_000])

    return plan


def planned(rows: DataFrame) -> DataFrame:
    """The edits of each row of :func:`examined`: roles of turns inserted before it, its new role (empty: its own, null: it is
    deleted), and its place; a last row for what is inserted at the end, with the conversation's audit and cost.

    Only numbers and faults of rows are read, not texts. A conversation's rows stream through one task, which holds four
    bytes a row for the way back.
    """
    facts = rows.select("conv_id", "idx", _initial(F.col("role")).alias("initial"), "fault")
    kind = pa.int64() if rows.schema["conv_id"].dataType.simpleString() == "bigint" else pa.string()
    name = "long" if kind == pa.int64() else "string"
    dealt = facts.withColumn("conv_id", F.col("conv_id").cast(name)).repartition("conv_id").sortWithinPartitions("conv_id", "idx")
    return durable(dealt.mapInArrow(_plan(kind), f"conv_id {name}, {PLAN}").withColumn("conv_id", F.col("conv_id").cast(rows.schema["conv_id"].dataType)), "plan")


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the turns of the repaired conversations in order, places from 0."""
    texts = rows.select("conv_id", "idx", F.col("role").alias("own"), "text")
    both = same_keys(plan.where("role IS NOT NULL OR size(inserted) > 0"), texts, ["conv_id", "idx"], "left")
    new = F.transform("inserted", lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
    kept = F.when(F.col("role").isNotNull(), F.array(F.struct(F.when(F.col("role") == "", F.col("own")).otherwise(F.col("role")).alias("role"), F.col("text").alias("text"))))
    made = both.select("conv_id", "place", F.posexplode(F.concat(new, F.coalesce(kept, F.array().cast("array<struct<role:string,text:string>>")))).alias("more", "turn"))
    return made.select("conv_id", (F.col("place") + F.col("more")).alias("place"), "turn.role", "turn.text")


def _hashes(kind: pa.DataType):
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hash_ = None, None
        for batch in batches:
            done: list[tuple] = []
            for conv, place, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place == 0:
                    if hash_:
                        done.append((now, hash_.hexdigest()))
                    now, hash_ = conv, hashlib.sha256(line.encode())
                else:
                    hash_.update(b"\n" + line.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], names=["conv_id", "sha256"])
        if hash_:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([hash_.hexdigest()], pa.string())], names=["conv_id", "sha256"])

    return hashes


def hashed(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of each conversation's ``role:text`` joined by line breaks in order of place, read as a stream."""
    kind, name = (pa.int64(), "long") if turns.schema["conv_id"].dataType.simpleString() == "bigint" else (pa.string(), "string")
    lines = turns.select(F.col("conv_id").cast(name).alias("conv_id"), "place", F.concat("role", F.lit(":"), "text").alias("line"))
    out = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_hashes(kind), f"conv_id {name}, sha256 string")
    return out.withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))


def summary(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each row of ``convs`` (conv_id, each once): what was wrong with its ``turns``, and how they are repaired.

    ``turns`` holds conv_id, turn, role and text. gaps, blank, duplicate, truncated and illegal count faults; ``cost`` and
    ``audit`` are those of the cheapest edits that give role initials ``(s?(ua)+)?``: Keep 0, Rerole (to user or assistant) 2,
    Delete 3, Insert (an empty user or assistant turn) 2, and 1 for a truncated turn that stays. Blank turns and duplicates
    have to go. Of the cheapest audits the ASCII-least counts.

    Cases: conversations without turns have zeros, an empty audit and the hash of nothing. Null roles and texts count as one
    space; a null conv_id is a conversation like others; null turns come first and make no gap. Rows equal in turn are in
    the order of role and text; repeated rows are duplicates. A conversation of any length streams through its tasks: its
    rows' order, and the hash of its text, need one. Other columns aren't read. No rows give no rows.
    """
    rows = examined(turns)
    plan = planned(rows)
    tally = [F.count_if(F.col("fault") == f).alias(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    counts = rows.groupBy("conv_id").agg(gaps.cast("long").alias("gaps"), *tally, F.count_if("illegal").alias("illegal"))
    out = same_keys(convs.select("conv_id"), counts, ["conv_id"], "left")
    out = same_keys(out, plan.where("audit IS NOT NULL").select("conv_id", "cost", "audit"), ["conv_id"], "left")
    out = same_keys(out, hashed(repaired(rows, plan)), ["conv_id"], "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(LEAST_HASH)).alias("repaired_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return summary(turns.select("conv_id").distinct(), damaged(turns))


_FAULT_SQL = """
  SELECT *, CASE WHEN core = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault"""
OP13_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
convs AS MATERIALIZED (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
drawn AS (
  SELECT convs.c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_of("coalesce(t.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS f
  FROM conversations t JOIN convs ON t.conv_id IS NOT DISTINCT FROM convs.conv_id, crc),
damaged AS (
  SELECT c, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN f = 0 THEN 0 WHEN f = 3 THEN 2 ELSE 1 END))
  FROM drawn),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS idx,
         left(lag(role) OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text), 1) AS before,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core, left(role, 1) AS initial
  FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY idx) AS nth FROM placed),
faulty AS MATERIALIZED ({_FAULT_SQL} FROM seen),
runs(k) AS (VALUES (0), (1), (2)),
ends(stands, onward) AS (VALUES ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
moves AS MATERIALIZED (  -- the end, a run of inserts, the end then and what would come next
  SELECT e0.stands, k, CASE k WHEN 0 THEN e0.stands WHEN 1 THEN e0.onward ELSE e1.onward END AS mid, CASE k WHEN 0 THEN e0.onward WHEN 1 THEN e1.onward ELSE e0.onward END AS onward
  FROM ends e0 JOIN ends e1 ON e1.stands = e0.onward, runs),
layers AS (
  SELECT c, 0::BIGINT AS idx, '' AS stands, struct_pack(cost := 0, audit := '') AS best FROM convs
  UNION ALL
  SELECT c, idx, stands, min(best) FROM (
    SELECT l.c, f.idx, CASE edit WHEN 'D' THEN mid WHEN 'R' THEN onward ELSE initial END AS stands,
           struct_pack(cost := l.best.cost + 2 * k + CASE edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + (fault = 'truncated' AND edit <> 'D')::INT,
                       audit := l.best.audit || repeat('I', k) || edit) AS best
    FROM layers l JOIN faulty f ON l.c = f.c AND f.idx = l.idx + 1 JOIN moves m ON m.stands = l.stands, (VALUES ('D'), ('K'), ('R')) e(edit)
    WHERE edit = 'D' OR fault NOT IN ('blank', 'duplicate') AND (edit = 'R' OR initial = onward OR (initial = 's' AND mid = '')))
  GROUP BY c, idx, stands),
lengths AS (SELECT c, max(idx) AS n FROM layers GROUP BY 1),
final AS MATERIALIZED (
  SELECT l.c, min(struct_pack(cost := best.cost + 2 * k, audit := best.audit || repeat('I', k))) AS best
  FROM layers l JOIN lengths ON l.c = lengths.c AND l.idx = n JOIN moves m ON m.stands = l.stands AND (mid = 'a' OR mid = '') GROUP BY 1),
edits AS (SELECT c, unnest(string_split(best.audit, '')) AS e, generate_subscripts(string_split(best.audit, ''), 1) AS i FROM final WHERE best.audit <> ''),
walked AS (SELECT *, count(*) FILTER (WHERE e <> 'I') OVER (PARTITION BY c ORDER BY i) AS idx FROM edits),
turned AS (
  SELECT w.c, i, e, f.role, f.initial, f.text, row_number() OVER (PARTITION BY w.c ORDER BY i) AS p
  FROM walked w LEFT JOIN faulty f ON w.c = f.c AND w.idx = f.idx AND e <> 'I' WHERE e <> 'D'),
named AS (
  SELECT *, max((p = 1 AND e = 'K' AND initial = 's')::INT) OVER (PARTITION BY c) AS led FROM turned),
digest AS (
  SELECT c, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (p - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY i)) AS sha FROM named GROUP BY 1),
tally AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY 1)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, final.best.cost::BIGINT AS cost, final.best.audit AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM convs JOIN final USING (c) LEFT JOIN tally USING (c) LEFT JOIN digest USING (c)
"""
