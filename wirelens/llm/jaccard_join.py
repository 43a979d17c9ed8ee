"""N-gram Jaccard join: prefix filters under several token orders, then exact verification."""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelens.llm.common import TRIMMED, durable, unused
from wirelens.llm.components import components
from wirelens.llm.shingles import fingerprint, mixed, shingle_sets

#: Two sets are linked if NUMERATOR / DENOMINATOR of their union is common to both.
NUMERATOR, DENOMINATOR = 3, 4
#: Token hashes are dealt to at least so many ranges, more for larger input: about RANGE_TOKENS to a range.
LEAST_RANGES, RANGE_TOKENS, CHARS_PER_TOKEN = 256, 500_000, 6
#: Texts are shingled in slices of about this many characters, of at most 2^16 texts.
SLICE_CHARS, SLICE_TEXTS = 1_500_000, 60_000
#: Sets of one cluster that are linked in one task.
BLOCK = 4096
#: Candidates of one set that are verified at a time.
CHUNK = 64
#: Number of token orders.
ORDERS = 3


def prefix(n: int) -> int:
    """Of a set of ``n`` tokens in any order, so many first ones hold a token of each set that it is linked with."""
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def own_prefix(n: int) -> int:
    """The same where the other set is at least as large: both have 2t / (1 + t) of ``n`` in common."""
    return n - -(-2 * NUMERATOR * n // (NUMERATOR + DENOMINATOR)) + 1


def order_keys(tokens: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Ranks of a set's shared tokens under each order, ties by a different hash in each.

    Rare tokens first, common tokens first, and by a hash of the number of holders. Tokens of one passage have about the same
    number of holders, so each order puts another of a text's passages first: texts that have one passage in common share
    a prefix under one order, hardly ever under all. Tokens of one set alone come first in all of them.
    """
    wide = counts.astype(np.int64)
    with np.errstate(over="ignore"):
        classes = [wide, -wide, mixed(counts.astype(np.uint64) + np.uint64(ORDERS + 1))]
        return [np.lexsort((mixed(tokens + np.uint64(k + 1)), classes[k])) for k in range(ORDERS)]


def part_of(slices: np.ndarray, parts: int) -> np.ndarray:
    """The part of each slice of texts."""
    with np.errstate(over="ignore"):
        return (mixed(np.asarray(slices).astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


_compressor, _decompressor = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _packed(x: np.ndarray) -> bytes:
    return _compressor.compress(np.ascontiguousarray(x).tobytes())


def _unpacked(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(_decompressor.decompress(data), dtype=dtype)


DEALT = pa.schema([("range", pa.int32()), ("slice", pa.int64()), ("tokens", pa.binary()), ("tops", pa.binary()), ("owners", pa.binary()), ("owner_tops", pa.binary()), ("doc_id", pa.list_(pa.int64())), ("text", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("fp", pa.list_(pa.binary()))])
DEALT_SQL = "range int, slice long, tokens binary, tops binary, owners binary, owner_tops binary, doc_id array<long>, text array<long>, n array<long>, fp array<binary>"


def _deal(ranges: int):
    """Texts to rows (range of token hashes, tokens, which texts hold them), and a row with the slice's texts.

    A token keeps 7 of its 8 bytes; the first one is the range's. The highest of the 7, which hardly varies among sorted
    tokens, and the owners' high bytes are compressed. Of texts that agree in their set only the first of a
    task sends its tokens.
    """
    shift = np.uint64(64 - int(math.log2(ranges)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        slice_ = TaskContext.get().partitionId() << 24
        sent: set[bytes] = set()
        for batch in batches:
            ids, texts, hashes = batch.column(0), batch.column(1), batch.column(2)
            at = 0
            while at < batch.num_rows:
                held, chars, first = [], 0, at
                while at < batch.num_rows and chars < SLICE_CHARS and len(held) < SLICE_TEXTS:
                    held.append(texts[at].as_py())
                    chars += len(held[-1] or "")
                    at += 1
                sets = shingle_sets(held)
                names = [fingerprint(s) for s in sets]
                new = []
                for k, (s, name) in enumerate(zip(sets, names, strict=True)):
                    if len(s) and name not in sent:
                        sent.add(name)
                        new.append(k)
                if len(sent) > 200_000:  # forgetting only sends some sets again
                    sent.clear()
                out: list[list] = [[-1 - int(part_of(slice_, ranges))], [slice_], [None], [None], [None], [None], [ids.slice(first, at - first).to_pylist()], [hashes.slice(first, at - first).to_pylist()], [[len(s) for s in sets]], [names]]
                if new:
                    tokens = np.concatenate([sets[k] for k in new])
                    owners = np.repeat(np.array(new, dtype=np.uint16), [len(sets[k]) for k in new])
                    order = np.argsort(tokens, kind="stable")
                    tokens, owners = tokens[order], owners[order]
                    cut = np.searchsorted(tokens >> shift, np.arange(ranges + 1, dtype=np.uint64))
                    low = tokens.astype("<u8").view(np.uint8).reshape(-1, 8)
                    owner = owners.astype("<u2").view(np.uint8).reshape(-1, 2)
                    for r in np.flatnonzero(np.diff(cut)):
                        a, b = cut[r], cut[r + 1]
                        values = (int(r), slice_, low[a:b, :6].tobytes(), _packed(low[a:b, 6]), owner[a:b, 0].tobytes(), _packed(owner[a:b, 1]), None, None, None, None)
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, DEALT.types, strict=True)], names=DEALT.names)
                slice_ += 1

    return deal


SHARED = pa.schema([("part", pa.int64()), ("owner", pa.binary()), ("tokens", pa.binary()), ("counts", pa.binary()), ("doc_id", pa.list_(pa.int64())), ("text", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("fp", pa.list_(pa.binary()))])
SHARED_SQL = "part long, owner binary, tokens binary, counts binary, doc_id array<long>, text array<long>, n array<long>, fp array<binary>"


def _count(ranges: int, parts: int):
    """Of each range, the tokens that several texts hold go back to the texts' parts with the number of their holders."""
    bits = int(math.log2(ranges))

    def shared(number: int, rows: list) -> Iterator[pa.RecordBatch]:
        low = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.uint8).reshape(-1, 6)
        owners = np.concatenate([np.frombuffer(r[3], dtype=np.uint8) + (_unpacked(r[4], "u1").astype(np.int64) << 8) + (r[0] << 16) for r in rows])
        tokens = np.zeros((len(low), 8), dtype=np.uint8)
        tokens[:, :6] = low
        tokens[:, 6] = np.concatenate([_unpacked(r[2], "u1") for r in rows])
        tokens[:, 7] = number >> (bits - 8)
        tokens = tokens.view("<u8").ravel()
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        new = np.concatenate([[True], tokens[1:] != tokens[:-1]])
        count = np.diff(np.append(np.flatnonzero(new), len(tokens)))
        count = np.repeat(count, count)
        keep = count > 1
        tokens, owners, count = tokens[keep], owners[keep], np.minimum(count[keep], 65535).astype(np.uint16)
        part = part_of(owners >> 16, parts)
        order = np.lexsort((owners, part))
        tokens, owners, count, part = tokens[order], owners[order], count[order], part[order]
        edge = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
        columns: list[list] = [[] for _ in SHARED]
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            values = (int(part[a]), _packed(np.diff(owners[a:b], prepend=0)), tokens[a:b].tobytes(), _packed(count[a:b]), None, None, None, None)
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        if columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, SHARED.types, strict=True)], names=SHARED.names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, []
        for batch in batches:
            columns = [batch.column(k) for k in range(len(DEALT))]
            for k in range(batch.num_rows):
                r = columns[0][k].as_py()
                if r < 0:
                    slice_ = columns[1][k].as_py()
                    # the slice stands where other rows have the owners of shared tokens
                    values = ([int(part_of(slice_, parts))], [slice_.to_bytes(8, "little")], [None], [None], *([columns[c][k].as_py()] for c in (6, 7, 8, 9)))
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, SHARED.types, strict=True)], names=SHARED.names)
                    continue
                if r != number and held:
                    yield from shared(number, held)
                    held = []
                number = r
                held.append(tuple(columns[c][k].as_py() for c in range(1, 6)))
        if held:
            yield from shared(number, held)

    return count


SETS = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("text", pa.int64()), ("n", pa.int64()), ("fp", pa.binary()), ("tokens", pa.binary()), ("counts", pa.binary()), ("prefix", pa.list_(pa.int64())), ("own", pa.int32())])
SETS_SQL = "uid long, doc_id long, text long, n long, fp binary, tokens binary, counts binary, prefix array<long>, own int"


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text. One that may have a partner has its shared tokens, and those of its prefix in the first order.

    A text whose prefix holds only tokens of its own has no partner.
    """

    def texts(slices: dict, rows: list) -> Iterator[pa.RecordBatch]:
        owners = np.concatenate([np.cumsum(_unpacked(r[0], "<i8")) for r in rows] or [np.zeros(0, np.int64)])
        tokens = np.concatenate([np.frombuffer(r[1], dtype="<u8") for r in rows] or [np.zeros(0, np.uint64)])
        counts = np.concatenate([_unpacked(r[2], "<u2") for r in rows] or [np.zeros(0, np.uint16)])
        order = np.lexsort((tokens, owners))
        owners, tokens, counts = owners[order], tokens[order], counts[order]
        for slice_, (ids, hashes, sizes, names) in sorted(slices.items()):
            columns: list[list] = [[] for _ in SETS]
            uids = (slice_ << 16) + np.arange(len(ids))
            begin, end = np.searchsorted(owners, uids), np.searchsorted(owners, uids, "right")
            for uid, doc, hash_, n, name, a, b in zip(uids.tolist(), ids, hashes, sizes, names, begin, end, strict=True):
                alone = n - int(b - a)
                reach = prefix(n) - alone
                row = [uid, doc, hash_, n, name, None, None, None, None]
                if n and reach > 0 and b > a:
                    first = order_keys(tokens[a:b], counts[a:b])[0][:reach]
                    row[5:] = [tokens[a:b].tobytes(), counts[a:b].tobytes(), tokens[a:b][first].view(np.int64).tolist(), max(0, own_prefix(n) - alone)]
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, SETS.types, strict=True)], names=SETS.names)

    part, slices, rows = None, {}, []
    for batch in batches:
        columns = [batch.column(k) for k in range(len(SHARED))]
        for k in range(batch.num_rows):
            own = columns[0][k].as_py()
            if own != part and part is not None:
                yield from texts(slices, rows)
                slices, rows = {}, []
            part = own
            if columns[4][k].is_valid:
                slices[int.from_bytes(columns[1][k].as_py(), "little")] = tuple(columns[c][k].as_py() for c in (4, 5, 6, 7))
            else:
                rows.append(tuple(columns[c][k].as_py() for c in (1, 2, 3)))
    if part is not None:
        yield from texts(slices, rows)


class Linker:
    """Links among the sets of one task, found through their prefixes; sets that are connected already aren't compared."""

    def __init__(self, rows: list[tuple[int, int, bytes, bytes, int]]):
        """rows: uid, n, tokens, counts, component so far."""
        rows = sorted(rows, key=lambda r: (r[1], r[0]))
        self.uid = [r[0] for r in rows]
        self.n = np.array([r[1] for r in rows], dtype=np.int64)
        tokens = [np.frombuffer(r[2], dtype="<u8") for r in rows]
        counts = [np.frombuffer(r[3], dtype="<u2") for r in rows]
        self.cut = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        self.ranks = [order_keys(t, c) for t, c in zip(tokens, counts, strict=True)]
        known, self.token = np.unique(np.concatenate(tokens), return_inverse=True)
        self.reach = [(max(0, prefix(n) - (n - len(t))), max(0, own_prefix(n) - (n - len(t)))) for n, t in zip(self.n.tolist(), tokens, strict=True)]
        # of each order after the first, the tokens of each set's own prefix, one set after another
        self.starts = np.concatenate([[0], np.cumsum([mine for _, mine in self.reach])])
        self.fronts = [np.concatenate([self.token[self.cut[i] : self.cut[i + 1]][r[k][: self.reach[i][1]]] for i, r in enumerate(self.ranks)]) for k in range(1, ORDERS)]
        self.mark = np.zeros(len(known), dtype=bool)
        self.verified = 0  # candidates left by the filters
        roots: dict[int, int] = {}
        self.label = np.array([roots.setdefault(r[4], i) for i, r in enumerate(rows)], dtype=np.int64)
        self.members = {int(k): [] for k in set(self.label.tolist())}
        for i, k in enumerate(self.label.tolist()):
            self.members[k].append(i)

    def join(self, a: int, b: int) -> None:
        keep, gone = sorted((int(self.label[a]), int(self.label[b])), key=lambda k: -len(self.members[k]))
        moved = self.members.pop(gone)
        self.label[moved] = keep
        self.members[keep] += moved

    def _marked(self, own: np.ndarray, values: np.ndarray, cut: np.ndarray, others: np.ndarray) -> np.ndarray:
        """How many of the tokens ``own`` are among the ``values`` of each of the others, none of which is empty."""
        self.mark[own] = True
        lengths = cut[others + 1] - cut[others]
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        at = np.repeat(cut[others] - first, lengths) + np.arange(lengths.sum())
        sizes = np.add.reduceat(self.mark[values[at]].astype(np.int64), first)
        self.mark[own] = False
        return sizes

    def common(self, x: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of x with the others."""
        return self._marked(self.token[self.cut[x] : self.cut[x + 1]], self.token, self.cut, others)

    def links(self) -> list[tuple[int, int]]:
        """uid pairs that, with the components so far, connect whatever links connect."""
        out = []
        index: dict[int, list[int]] = {}
        for x in range(len(self.uid)):
            n = int(self.n[x])
            own = self.token[self.cut[x] : self.cut[x + 1]]
            reach, mine = self.reach[x]
            met = [index[t] for t in own[self.ranks[x][0][:reach]].tolist() if t in index]
            found, shared = np.unique(np.array([y for ys in met for y in ys], dtype=np.int64), return_counts=True)
            fits = (DENOMINATOR * self.n[found] >= NUMERATOR * n) & (self.label[found] != self.label[x])
            found, shared = found[fits], shared[fits]
            found = found[np.argsort(-shared, kind="stable")]
            for k in range(1, ORDERS):
                if len(found):
                    found = found[self._marked(own[self.ranks[x][k][:reach]], self.fronts[k - 1], self.starts, found) > 0]
            self.verified += len(found)
            while len(found):
                some, found = found[:CHUNK], found[CHUNK:]
                both = self.common(x, some)
                linked = some[(NUMERATOR + DENOMINATOR) * both >= NUMERATOR * (n + self.n[some])]
                for y in linked.tolist():
                    if self.label[x] != self.label[y]:
                        out.append((self.uid[y], self.uid[x]))
                        self.join(x, y)
                found = found[self.label[found] != self.label[x]]
            for t in own[self.ranks[x][0][:mine]].tolist():
                index.setdefault(t, []).append(x)
        return out


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each (cluster, block) of rows sorted by them."""
    key, held = None, []

    def linked() -> pa.RecordBatch:
        pairs = Linker(held).links() if len(held) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for cluster, block, *row in zip(*columns, strict=True):
            if key != (cluster, block):
                if held:
                    yield linked()
                key, held = (cluster, block), []
            held.append(tuple(row))
    if held:
        yield linked()


def _linked(rows: DataFrame) -> DataFrame:
    """Links among rows (cluster, block, uid, n, tokens, counts, component) of a cluster and block."""
    dealt = rows.select("cluster", "block", "uid", "n", "tokens", "counts", "component").repartition("cluster", "block")
    return dealt.sortWithinPartitions("cluster", "block").mapInArrow(_link, "a long, b long")


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared tokens of sets as numbers, and their prefixes under the orders after the first."""
    for batch in batches:
        columns: list[list] = [[], [], [], [], []]
        for uid, n, tokens, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own, held = np.frombuffer(tokens, dtype="<u8"), np.frombuffer(counts, dtype="<u2")
            reach, keys = max(0, prefix(n) - (n - len(own))), order_keys(own, held)
            values = own.view(np.int64)
            for column, value in zip(columns, (uid, n, values, *(values[k[:reach]] for k in keys[1:])), strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * ORDERS]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["uid", "n", "t", *[f"p{k}" for k in range(1, ORDERS)]])


def _across(known: DataFrame, able: DataFrame) -> DataFrame:
    """Links (a, b) between sets of large clusters that aren't connected yet, without bringing a cluster together.

    Under the first order the holders of a prefix token meet, but only across components: those outside the component
    that most of the token's holders belong to meet the holders of other components. Pairs are numbers until they share
    a prefix token under each of the other orders too; what is left is verified by its sets. Both sides of each join are
    stored tables, so Spark splits a token that many hold.
    """
    posts = able.join(known.select("uid", "component"), "uid")
    sets = durable(posts.select("uid", "n", "tokens", "counts").mapInArrow(_orders, f"uid long, n long, t array<long>, {', '.join(f'p{k} array<long>' for k in range(1, ORDERS))}"), "orders")
    posts = posts.select("uid", "n", "component", "own", F.posexplode("prefix").alias("pos", "token"))
    posts = durable(posts.select("token", "uid", "n", "component", (F.col("pos") < F.col("own")).alias("own")), "posts")
    parts = posts.groupBy("token", "component").agg(F.count(F.lit(1)).alias("held"))
    main = parts.groupBy("token").agg(F.max_by("component", F.struct("held", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
    main = durable(main.where("parts > 1").select("token", "main"), "main")
    outside = posts.join(main, "token").where("component <> main").select("token", *[F.col(c).alias(f"o_{c}") for c in ("uid", "n", "component", "own")])
    smaller = (F.col("o_n") < F.col("n")) | ((F.col("o_n") == F.col("n")) & (F.col("o_uid") < F.col("uid")))
    fits = (DENOMINATOR * F.least("o_n", "n") >= NUMERATOR * F.greatest("o_n", "n")) & F.when(smaller, F.col("o_own")).otherwise(F.col("own"))
    met = durable(outside, "outside").join(posts, "token").where((F.col("o_component") != F.col("component")) & fits)
    pairs = durable(met.select(F.least("o_uid", "uid").alias("a"), F.greatest("o_uid", "uid").alias("b")).distinct(), "pairs")

    def beside(rows: DataFrame, columns: list[str]) -> DataFrame:
        for side in ("a", "b"):
            rows = rows.join(sets.select(F.col("uid").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
        return rows

    filters = [f"p{k}" for k in range(1, ORDERS)]
    shared = beside(pairs, filters)
    for name in filters:
        shared = shared.where(F.arrays_overlap(f"{name}_a", f"{name}_b"))
    whole = beside(durable(shared.select("a", "b"), "candidates"), ["n", "t"])
    both = F.size(F.array_intersect("t_a", "t_b"))
    return whole.where((NUMERATOR + DENOMINATOR) * both >= NUMERATOR * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def shared_sets(docs: DataFrame) -> DataFrame:
    """A stored row for each document: uid, doc_id, text (its hash), n (size of its set), fp (its set's name) and, if it may
    have a partner, its shared tokens and its prefix."""
    chars = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    ranges = max(LEAST_RANGES, 1 << math.ceil(math.log2(max(1, chars / CHARS_PER_TOKEN / RANGE_TOKENS))))
    dealt = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("hash")).mapInArrow(_deal(ranges), DEALT_SQL)
    counted = dealt.repartition("range").sortWithinPartitions("range").mapInArrow(_count(ranges, ranges), SHARED_SQL)
    sets = counted.repartition("part").sortWithinPartitions("part").mapInArrow(_gather, SETS_SQL)
    return durable(sets, "sets")


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`shared_sets`, and each set's (fp, root, least): its component, and its least document as
    (null id?, doc_id, hash of the text)."""
    spark = docs.sparkSession
    sets = shared_sets(docs)
    gc.collect()
    spark._jvm.System.gc()  # the postings' shuffle files are the largest; they go now, not when the driver's heap is full
    classes = sets.where("n > 0").groupBy("fp").agg(F.min("uid").alias("rep"), F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text")).alias("least"))
    first = sets.where("prefix IS NOT NULL").groupBy("fp").agg(F.min("uid").alias("uid")).select("uid")
    able = sets.where("prefix IS NOT NULL").join(first, "uid")
    postings = able.select("uid", F.posexplode("prefix").alias("pos", "token"), "own").select("uid", "token", (F.col("pos") < F.col("own")).alias("own"))
    hubs = postings.groupBy("token").agg(F.min("uid").alias("hub"), F.count(F.lit(1)).alias("n"), F.max("own").alias("own")).where("own AND n > 1")
    ties = postings.join(hubs.select("token", "hub"), "token").select(F.col("hub").alias("a"), F.col("uid").alias("b"))
    member = components(ties)  # a: uid, b: the cluster's least uid
    clustered = member.unionByName(member.select(F.col("b").alias("a"), "b").distinct()).select(F.col("a").alias("uid"), F.col("b").alias("cluster"))
    sizes = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    rows = able.select("uid", "n", "tokens", "counts").join(clustered, "uid").join(sizes, "cluster")
    rows = durable(rows, "clustered")
    blocks = F.ceil(F.col("size") / BLOCK)

    def dealt(seed: int, frame: DataFrame) -> DataFrame:
        return frame.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(seed)), blocks))

    found = components(_linked(dealt(0, rows.withColumn("component", F.col("uid")))))
    large = rows.where(F.col("size") > BLOCK)
    if large.limit(1).count():

        def known() -> DataFrame:
            return large.join(found.withColumnsRenamed({"a": "uid", "b": "component"}), "uid", "left").withColumn("component", F.coalesce("component", "uid"))

        # what is connected already is a star for each component, so each call has little left to do
        found = components(found.unionByName(_linked(dealt(1, known()))))
        found = components(found.unionByName(_across(known(), able)))
    joined = found.withColumnsRenamed({"a": "uid", "b": "root"})
    # a class is known by the first of its texts that kept its shared tokens
    named = able.select("fp", "uid").join(joined, "uid", "left").select("fp", F.coalesce("root", "uid").alias("root"))
    return sets, classes.join(named, "fp", "left").select("fp", "least", F.coalesce("root", "rep").alias("root"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document; ``component_id`` is the least doc_id that links reach.

    1. Every distinct 5-word shingle is hashed and dealt by its hash; the ranges count each one's holders, and only
       shingles that several texts hold go back to these texts. 2. Under an order that puts rare shingles first, two
       linked sets share a token of their prefixes (of which those of one text alone are a part), so most texts have no
       candidate at all. 3. Texts that share prefix tokens form clusters; a task gets a cluster's sets once. There a
       candidate has to share a prefix token under each of several orders (:func:`order_keys`), and is then verified by its
       whole set. Sets that are connected already aren't compared, so copies are never expanded into pairs. 4. Clusters
       of more than ``BLOCK`` sets are linked in blocks, dealt in two ways, which connects nearly all that links connect;
       then the holders of each prefix token meet across components (:func:`_across`), so that no link is left out.

    Texts with the same set are one set from step 3 on. ``docs`` should be a stored table, whose tasks read the same rows
    again if they are lost. Cases: null texts and those without words have an empty set and
    link with nothing. Repeated rows and rows with one doc_id are documents of their own, which link if their sets do.
    A component of rows with null doc_id only has a null id. Other columns aren't read. No rows give no rows.
    """
    sets, grouped = _grouped(docs)
    ids = grouped.groupBy("root").agg(F.min("least").alias("least"))
    by_class = grouped.select("fp", "root").join(ids, "root").select("fp", F.col("least.doc_id").alias("component_id"))
    out = sets.select("doc_id", "n", "fp").join(by_class, "fp", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component of :func:`jaccard_components`, all columns, of any name, kept: the one with the least doc_id
    (nulls last), then with the least hash of its text.

    Cases: rows are documents of their own whatever their ids, so unrelated texts of one doc_id, or without one, all stay.
    Of rows equal in doc_id and text any one stays. A text without words links with nothing, so each such row stays. No
    rows give no rows.
    """
    none, row, own = unused(docs.columns, "none", "row", "own")
    _, grouped = _grouped(docs)
    # a row is known by the hash of its id and of its text's hash, so that the join deals rows out evenly, whatever they share
    known = lambda id_, text: F.xxhash64(F.coalesce(id_.cast("string"), F.lit("")), text)
    best = grouped.groupBy("root").agg(F.min("least").alias("least")).select(known(F.col("least.doc_id"), F.col("least.text")).alias(row)).distinct()
    wordless = F.coalesce(F.btrim("text", F.lit(TRIMMED)), F.lit("")) == ""
    marked = docs.withColumns({own: known(F.col("doc_id").cast("long"), F.xxhash64("text")), none: wordless})
    found = marked.where(~F.col(none)).join(best, F.col(own) == F.col(row))
    # rows are where the join has brought them, so repeated ones are dropped there
    return found.dropDuplicates([own]).drop(row).unionByName(marked.where(none)).select(*docs.columns)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
