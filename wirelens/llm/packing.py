"""Best-fit packing: documents' tokens into as few fixed-length sequences as best-fit decreasing finds."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelens.llm.common import durable, ranked, same_keys, unused
from wirelens.llm.tokens import pieces

MOST_TOKENS = 1024
#: Sequences that begin within so many numbers of an order are numbered in one task.
NUMBERS = 256
END_ID = 2
#: Columns of a piece.
PIECE = ["piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]


class OpenBins:
    """Segment tree over remaining capacities: a node knows whether any open bin lies below it."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.runs: list[deque[tuple[int, int]]] = [deque() for _ in range(capacity + 1)]

    def _mark(self, room: int) -> None:
        at = room + self.leaves
        self.open[at] = int(bool(self.runs[room]))
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] | self.open[2 * at + 1]

    def add(self, room: int, first: int, bins: int) -> None:
        if room and bins:
            self.runs[room].append((first, bins))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].popleft()
        self._mark(room)
        return run

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of an open bin that holds ``length``, in logarithmic time."""
        at = length + self.leaves
        while not self.open[at]:
            while at & 1:  # a right child: nothing larger below its parent
                at //= 2
            if at == 0:
                return None
            at += 1
            if at & (at - 1) == 0:  # past the last leaf of this level
                return None
        while at < self.leaves:
            at = 2 * at + (not self.open[2 * at])
        return at - self.leaves


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over the number of pieces of each length.

    Pieces of one length are alike, so a run of them fills a run of equal bins in one step; the bins are those that
    placing piece by piece gives. Rows: length, first and last rank (of the pieces of that length, the last not
    included), pieces in each bin, first bin, offset of the first piece in its bin.
    """
    tree, made, plan = OpenBins(capacity), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, bins = capacity, made, -(-left // (capacity // length))
                made += bins
            else:
                first, bins = tree.take(room)
            each = room // length
            full = min(bins, left // each)
            if full:
                plan.append((length, rank, rank + full * each, each, first, capacity - room))
                tree.add(room - each * length, first, full)
            rank, left, first, bins = rank + full * each, left - full * each, first + full, bins - full
            if left and bins:  # fewer pieces than one more bin takes
                plan.append((length, rank, rank + left, left, first, capacity - room))
                tree.add(room - left * length, first, 1)
                rank, left, first, bins = rank + left, 0, first + 1, bins - 1
            if room < capacity:
                tree.add(room, first, bins)
    return plan


def pack(rows: DataFrame, length: str, order: list[str], capacity: int, by: str | None = None) -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset``: each row's place in a sequence of at most ``capacity``.

    Only the count of each length (``capacity`` numbers at most) reaches the driver, which plans runs of equal pieces
    over runs of equal bins; each row finds its place by its rank among the rows of its length. So the packing is best
    fit decreasing over all rows, and no task holds more than a bucket of them. ``rows`` should be a stored table.

    With ``by``, a column of whole numbers from 0, rows of one length are taken in the order of ``by`` and then of
    ``order`` (else of a hash), and sequences are numbered by the first of their rows in that order.

    Cases: a length below 1 or above ``capacity`` is an error. Repeated rows are packed once each. Columns named
    ``sequence_id`` or ``offset`` are replaced; other names are free. No rows give no rows.
    """
    spark: SparkSession = rows.sparkSession
    rows = rows.drop("sequence_id", "offset")
    counts = {r[0]: r[1] for r in rows.groupBy(length).count().limit(capacity + 1).collect()}
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    rank, p_length, p_from, p_to, p_each, p_first, p_offset, first, all_, number = unused(
        [*rows.columns, "sequence_id", "offset"], "rank", "length", "from", "to", "each", "first", "offset", "start", "all", "number"
    )
    columns = ", ".join(f"{c} long" for c in (p_length, p_from, p_to, p_each, p_first, p_offset))
    plan = spark.createDataFrame(best_fit_plan(counts, capacity), columns)
    placed = ranked(rows, length, order, rank, by=by).join(
        # runs of lengths: their number follows from the capacity, not from the rows
        F.broadcast(plan), (F.col(length) == F.col(p_length)) & (F.col(rank) >= F.col(p_from)) & (F.col(rank) < F.col(p_to))
    )
    nth = F.col(rank) - F.col(p_from)
    placed = placed.select(
        *rows.columns,
        (F.col(p_first) + F.floor(nth / F.col(p_each))).alias("sequence_id"),
        (F.col(p_offset) + F.pmod(nth, F.col(p_each)) * F.col(length)).alias("offset"),
    )
    if by is None:
        return placed
    placed = durable(placed, "placed")
    begins = placed.groupBy("sequence_id").agg(F.min(F.struct(by, *order)).alias(first))
    begins = durable(begins.select("sequence_id", f"{first}.*", F.lit(0).alias(all_)), "sequences")
    numbers = ranked(begins, all_, order, number, by=by, step=NUMBERS).select("sequence_id", number)
    return placed.join(numbers, "sequence_id").select(*rows.columns, F.col(number).alias("sequence_id"), "offset")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = MOST_TOKENS, end_id: int = END_ID, carry: list[str] | None = None, with_ids: bool = True, follow: DataFrame | None = None
) -> DataFrame:
    """The documents' tokens in packed sequences: a row for each piece, with its place and (if asked for) its ids.

    Ids are made once and stored; places are found without them, and ids move once, to the join with their places.
    ``follow`` (doc_id, source, text_hash and ``at``, a struct of whole numbers from 0 that begins with the main one), if
    given, is an order of the documents that the packing follows where lengths leave it a choice; documents that it
    doesn't name come first. ``carry`` then begins with doc_id.

    Cases: null or empty text gives one piece, the end id. Texts longer than ``capacity`` are cut, the first piece
    being the shorter one; other texts stay whole. Repeated rows are packed once each. ``carry`` names the document
    columns to keep (doc_id by default); among them the names of the columns added here are an error, and other columns
    aren't read. No rows give no rows.
    """
    carry = carry or ["doc_id"]
    if clash := {c.lower() for c in carry} & {"piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"}:
        raise ValueError(f"columns can't be carried: {sorted(clash)}")
    uid, hash_, source, by, at = unused([*docs.columns, *PIECE], "uid", "hash", "source", "by", "at")
    more = [] if follow is None else [source, hash_]
    keyed = docs if follow is None else docs.withColumns({source: F.col("source"), hash_: F.xxhash64("text")})
    made = pieces(keyed, tokenizer, end_id, capacity, [*carry, *more], with_ids).withColumn(uid, F.monotonically_increasing_id())
    cut = durable(made, "pieces")
    order = [carry[0], "start", "ids_crc32", uid]
    if follow is None and not with_ids:
        return pack(cut, "length", order, capacity).drop(uid)
    if follow is None:
        narrow = cut.select(*order, "length")
    else:
        known = follow.select(F.col("doc_id").alias(order[0]), F.col("source").alias(source), F.col("text_hash").alias(hash_), F.col("at").alias(at))
        first = known.schema[at].dataType.names[0]
        narrow = same_keys(cut.select(*order, source, hash_, "length"), known, [order[0], source, hash_], "left")
        narrow = durable(narrow.select(*order, "length", F.coalesce(f"{at}.{first}", F.lit(0)).alias(by), at), "followed")
        order = [at, *order]
    placed = pack(narrow, "length", order, capacity, by if follow is not None else None).select(uid, "sequence_id", "offset")
    return cut.join(placed, uid).drop(uid, *more)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
