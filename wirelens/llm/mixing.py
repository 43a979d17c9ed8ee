"""Mixing sources to target weights: Pfair windows and earliest deadline first."""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelens.llm.common import MOST_GROUPS, durable, ranked, same_keys, unused

#: Default weights are whole numbers of slots of a period of about so many for each source, at least 1024 in all.
SLOTS_A_SOURCE, LEAST_PERIOD = 64, 1024
#: The most slots that the driver plans: a whole period of the weights, or the first slots of a longer one.
MOST_SLOTS = 1 << 20
MOST_SOURCES = MOST_GROUPS
#: Slots between two blocks of the rarest sources, so that slots stay whole numbers of 64 bits.
MOST_APART = 1 << 40
#: Rows of a block, the unit that is scheduled.
BLOCK = 16
#: The exponent that draws the sources' shares together.
TEMPERATURE = 0.7


def whole_weights(shares: dict[str, float | int | str | Fraction]) -> dict[str, int]:
    """The given weights as whole numbers in the same proportion, exactly; their sum is the period, of any length.

    A float counts as the decimal number that it is written as. Weights that aren't positive are an error.
    """
    exact = {n: Fraction(str(w)) for n, w in shares.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights must be positive")
    if not exact:
        return {}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    whole = {n: int(w * scale) for n, w in exact.items()}
    common = math.gcd(*whole.values())
    return {n: w // common for n, w in whole.items()}


def pfair_schedule(slots: dict[str, int], upto: int | None = None) -> list[tuple[str, int, int]]:
    """(source, which of its blocks in a period, slot) for each slot of a period, or for its first ``upto`` slots.

    Block k (from 0) of a source with weight w, its slots over the period, is released at floor(k / w) and due at
    ceil((k + 1) / w). Each slot goes to the released block with the earliest deadline; ties go to the earlier release,
    then to the source that sorts first. The weights sum to one, so every block runs inside its window, and at any time
    a source is less than one block away from its share. Windows repeat with the period, so one period is all.
    """
    period = sum(slots.values())
    waiting = [(0, -(-period // n), source, 0) for source, n in slots.items()]  # release, deadline, source, k
    heapq.heapify(waiting)
    ready: list[tuple[int, int, str, int]] = []
    out = []
    for slot in range(period if upto is None else min(upto, period)):
        while waiting and waiting[0][0] <= slot:
            release, due, source, k = heapq.heappop(waiting)
            heapq.heappush(ready, (due, release, source, k))
        due, _, source, k = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a block missed its deadline")
        out.append((source, k, slot))
        n = slots[source]
        heapq.heappush(waiting, ((k + 1) * period // n, -(-(k + 2) * period // n), source, k + 1))
    return out


def tempered(counts: dict[str, int], temperature: float = TEMPERATURE) -> dict[str, int]:
    """Default weights: each source's rows to the power ``temperature``, which raises small sources, as whole slots of a
    period that grows with the number of sources; at least one slot each."""
    period = max(LEAST_PERIOD, SLOTS_A_SOURCE * len(counts))
    whole = sum(n**temperature for n in counts.values())
    return {source: max(1, round(n**temperature / whole * period)) for source, n in counts.items()}


def mix(docs: DataFrame, shares: dict[str, float] | None = None, order: list[str | Column] | None = None, block: int = BLOCK) -> DataFrame:
    """``docs`` with ``block`` (of its source, from 0), ``place`` (in the block) and ``slot`` (of the mixture).

    ``shares`` names the target weight of each source, any positive numbers in a table that the caller keeps small; by
    default the sources' tempered row counts. Sources that it doesn't name get the least weight. In its source a row's rank
    is that of a hash of ``order`` (doc_id by default); ``block`` rows make a block, and a source's k-th block gets the
    slot of the Pfair schedule. So the order needs no sequential pass over the data, and a hot source is ranked in many
    tasks. All rows are kept: once a source is used up, the others go on in their slots.

    The driver plans a period of the weights, and a block's slot is whole periods passed plus the place in one: in any
    prefix of slots, however long, each source that isn't used up is less than one block from its share by exactly the
    given weights. Of a period above ``MOST_SLOTS`` the first ``MOST_SLOTS`` slots are planned, by the exact windows, and
    said again after them: the distance is below one block there and grows by less than one block with each such span, a
    millionth of its slots. Sources that get no block in a span are so rare that their blocks take no slot of their own:
    block k begins with the slot k * ceil(1 / w), beside the block that has it.

    The driver holds the sources, at most ``MOST_SOURCES``, more are an error, and the planned slots.

    ``docs`` should be a stored table, as it is read several times. Cases: a null source is mixed as the source ''.
    Repeated rows have a place each. Columns named block, place or slot are replaced; other names are free. No rows give
    no rows.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.drop("block", "place", "slot")
    source, rank, many, slots_of, apart = unused([*docs.columns, "block", "place", "slot"], "source", "rank", "many", "slots", "apart")
    named = docs.withColumn(source, F.coalesce("source", F.lit("")))
    counts = {r[0]: r[1] for r in named.groupBy(source).count().limit(MOST_SOURCES + 1).collect()}
    if len(counts) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: group them first")
    if shares is None:
        slots = whole_weights(tempered(counts))
    else:
        least = min(shares.values(), default=1)
        slots = whole_weights({s: shares.get(s, least) for s in {*counts, *shares}})
    period, at = sum(slots.values()), {s: [] for s in slots}
    span = min(period, MOST_SLOTS)
    for name, _, slot in pfair_schedule(slots, span):
        at[name].append(slot)
    rows = [(s, len(at[s]), at[s], min(-(-period // n), MOST_APART)) for s, n in sorted(slots.items())]
    schedule = spark.createDataFrame(rows, f"{source} string, {many} long, {slots_of} array<long>, {apart} long")
    numbered = ranked(named, source, order or ["doc_id"], rank).withColumn("block", F.floor(F.col(rank) / block))
    # one row for each source, MOST_SLOTS numbers in all
    placed = same_keys(numbered, F.broadcast(schedule), [source])
    k, each = F.col("block"), F.col(many)
    planned = F.floor(k / each) * span + F.get(slots_of, F.pmod(k, each).cast("int"))
    slot = F.when(each > 0, planned).otherwise(k * F.col(apart))
    return placed.select(*docs.columns, "block", F.pmod(rank, F.lit(block)).alias("place"), slot.alias("slot"))


def places(docs: DataFrame, shares: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, source, text_hash, at): where the mixture puts each document, ``at`` being its slot and place.

    Only ids, sources and hashes of texts are ranked, stored once. Rows that agree in all three share the first one's
    place. Nulls are values like others; no rows give no rows.
    """
    narrow = durable(docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash")), "narrow")
    mixed = mix(narrow, shares, ["doc_id", "text_hash"])
    return mixed.groupBy("doc_id", "source", "text_hash").agg(F.min(F.struct("slot", "place")).alias("at"))


def interleaved(docs: DataFrame, shares: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` in the order of the mixture within each part; parts are shares of the rows by a hash.

    So each part by itself follows the mixture, and the parts together do when they are read side by side. Ranks are
    found without the texts, which move once, to the join with their places.

    Cases: those of :func:`places`. Columns of any name pass unchanged.
    """
    hash_, at = unused(docs.columns, "text", "at")
    found = places(docs, shares).withColumnsRenamed({"text_hash": hash_, "at": at})
    joined = same_keys(docs.withColumn(hash_, F.xxhash64("text")), found.hint("shuffle_hash"), ["doc_id", "source", hash_])
    return joined.sortWithinPartitions(at).select(*docs.columns)


def op9_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source"))
