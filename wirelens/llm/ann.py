"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wirelens.llm.common import durable

NEAREST = 20
#: The tree is fitted on at most so many vectors, those with the least hashes.
SAMPLE = 50_000
#: Children of a node, and the most sampled vectors of a leaf.
BRANCHES, LEAF = 32, 8
#: Recall to be reached on at most so many calibration queries, against all vectors.
RECALL, CALIBRATION = 0.95, 200
#: Vectors, and queries, that meet in one task.
BLOCK, QUERY_BLOCK = 20_000, 20_000
#: Numbers of a matrix of scores, and scores held beside each query's nearest.
CELLS, HELD = 2_000_000, 500_000


def directions(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors as points of the unit sphere of one more dimension, which makes up for what they are shorter than the
    longest. There the nearest points to a query's direction are those of the largest inner products."""
    scaled = x / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(axis=1, keepdims=True)))
    return np.hstack([scaled, rest])


def asked_for(q: np.ndarray) -> np.ndarray:
    """Queries as points of that sphere."""
    return np.hstack([q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300), np.zeros((len(q), 1))])


def k_means(x: np.ndarray, k: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centres and assignments; the first centres are rows at equal steps (rows come in the order of a hash)."""
    centre = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = ((centre**2).sum(1) - 2 * x @ centre.T).argmin(1)
        for j in range(len(centre)):
            if (own == j).any():
                centre[j] = x[own == j].mean(0)
    return centre, ((centre**2).sum(1) - 2 * x @ centre.T).argmin(1)


class Tree:
    """Nodes with their children's centres; leaves are numbered. Its size is bounded by that of the sample."""

    def __init__(self, x: np.ndarray):
        self.children: list[list[int]] = []
        self.centres: list[np.ndarray] = []
        self.leaf: list[int] = []
        self.leaves = 0
        self._grow(x)
        self.squares = [(c**2).sum(1) for c in self.centres]

    def _grow(self, x: np.ndarray) -> int:
        node = len(self.children)
        self.children.append([])
        self.centres.append(np.zeros((0, x.shape[1] if x.ndim > 1 else 0)))
        self.leaf.append(-1)
        if len(x) > LEAF:
            centres, own = k_means(x, BRANCHES)
            kept = [j for j in range(len(centres)) if (own == j).any()]
            if len(kept) > 1:
                self.centres[node] = centres[kept]
                self.children[node] = [self._grow(x[own == j]) for j in kept]
                return node
        self.leaf[node] = self.leaves
        self.leaves += 1
        return node

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, by the nearest centre at every node."""
        out = np.zeros(len(x), dtype=np.int64)
        open_ = [(0, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            c = self.centres[node]
            near = ((c**2).sum(1) - 2 * x[rows] @ c.T).argmin(1)
            open_ += [(child, rows[near == j]) for j, child in enumerate(self.children[node])]
        return out

    def visits(self, q: np.ndarray, most: int, sizes: np.ndarray, least: int) -> list[int]:
        """The first ``most`` leaves of a best-bin-first traversal, and more until they hold ``least`` rows.

        From a priority queue of open branches, always the one whose centre is nearest to the query goes on down to a
        leaf, its siblings joining the queue. Leaves without rows aren't counted.
        """
        out: list[int] = []
        queue: list[tuple] = []
        rows = tick = node = 0
        while len(out) < most or rows < least:
            while self.leaf[node] < 0:
                far = self.squares[node] - 2 * (self.centres[node] @ q)
                order = np.argsort(far, kind="stable")
                if len(order) > 1:  # of the siblings the nearest stands for all
                    tick += 1
                    heapq.heappush(queue, (far[order[1]], tick, node, far, order, 1))
                node = self.children[node][order[0]]
            if sizes[self.leaf[node]]:
                out.append(self.leaf[node])
                rows += sizes[self.leaf[node]]
            if not queue:
                break
            _, _, parent, far, order, at = heapq.heappop(queue)
            node = self.children[parent][order[at]]
            if at + 1 < len(order):
                tick += 1
                heapq.heappush(queue, (far[order[at + 1]], tick, parent, far, order, at + 1))
        return out


def usable(rows: DataFrame, size: int | None = None) -> DataFrame:
    """Rows that take part: an id, and a vector of finite numbers that aren't all zero, of the given or most usual length."""
    fine = ~F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists("vec", lambda v: v != 0)
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(fine)
    if size is None:
        usual = kept.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
        size = usual[0] if usual else 0
    return kept.where(F.size("vec") == size)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


class Nearest:
    """The ``most`` nearest vectors of each of some queries, among those met so far; ties go to the smaller id."""

    def __init__(self, queries: np.ndarray, most: int):
        self.queries, self.most = queries, most
        self.norms = np.linalg.norm(queries, axis=1)
        self.least = np.full(len(queries), -np.inf)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def meet(self, rows: np.ndarray, x: np.ndarray, ids: np.ndarray) -> None:
        """Queries ``rows`` meet vectors ``x``. Matrix products choose; what may be among the nearest is scored again,
        each product summed by itself, so that scores don't depend on what else is in the matrix."""
        if not len(x):
            return
        slack, step = 1e-12 * np.linalg.norm(x, axis=1).max(), max(1, CELLS // len(x))
        for k in range(0, len(rows), step):
            some = rows[k : k + step]
            rough = self.queries[some] @ x.T
            edge = self.least[some]
            if len(x) > self.most:
                edge = np.maximum(edge, np.partition(rough, len(x) - self.most, axis=1)[:, len(x) - self.most])
            r, c = np.nonzero(rough >= (edge - slack * self.norms[some])[:, None])
            self.parts.append((some[r], ids[c], np.einsum("ij,ij->i", self.queries[some[r]], x[c])))
            self.held += len(r)
            if self.held > HELD + 2 * self.most * len(self.queries):
                self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score), by query, nearest first."""
        q, v, s = (np.concatenate(p) for p in zip(*self.parts, strict=True)) if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order = np.lexsort((v, -s, q))
        q, v, s = q[order], v[order], s[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        last = nth == self.most - 1
        self.least[q[last]] = s[last]
        keep = nth < self.most
        self.parts, self.held = [(q[keep], v[keep], s[keep])], int(keep.sum())
        return self.parts[0]


FOUND = ["q", "vec_id", "score"]


def _found(q: np.ndarray, near: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q[near[0]], pa.int64()), pa.array(near[1], pa.int64()), pa.array(near[2], pa.float64())], names=FOUND)


def exact(vectors: DataFrame, ids: np.ndarray, queries: np.ndarray, most: int) -> DataFrame:
    """(q, vec_id, score): candidates for the nearest of a bounded number of queries, by brute force in each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, every = Nearest(queries, most), np.arange(len(ids))
        for batch in batches:
            near.meet(every, _matrix(batch.column(1)), batch.column(0).to_numpy())
        yield _found(ids, near.settle())

    return vectors.select("vec_id", "vec").mapInArrow(task, "q long, vec_id long, score double")


def _ranked(found: DataFrame, most: int, query: str = "query_id") -> DataFrame:
    order = Window.partitionBy(query).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def calibrated(tree: Tree, indexed: DataFrame, sizes: np.ndarray, most: int, recall: float) -> int:
    """The least number of leaf visits that reaches ``recall`` over the calibration queries, against all vectors."""
    held = indexed.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(CALIBRATION).select("vec_id", "vec").toArrow()
    if not held.num_rows:
        return tree.leaves
    ids, queries = held["vec_id"].to_numpy(), _matrix(held["vec"].combine_chunks())
    found = _ranked(exact(indexed, ids, queries, most + 1).where("q <> vec_id"), most, "q")
    near = found.join(indexed.select("vec_id", "leaf"), "vec_id").select("q", "leaf").toPandas()
    leaves_of, place = near.groupby("q")["leaf"].apply(list).to_dict(), []
    for own, q in zip(ids.tolist(), asked_for(queries), strict=True):
        order = {leaf: i for i, leaf in enumerate(tree.visits(q, tree.leaves, sizes, 0))}
        place += [order[leaf] for leaf in leaves_of.get(own, [])]
    place.sort()
    return place[max(0, math.ceil(recall * len(place)) - 1)] + 1 if place else tree.leaves


def pages_of(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The page of each leaf, and the blocks of each page: neighbouring leaves share a page of up to ``most`` vectors, a
    larger leaf is a page by itself, of several blocks."""
    page, blocks, filled = np.zeros(len(counts), dtype=np.int64), [], most + 1
    for leaf, n in enumerate(counts.tolist()):
        if filled + n > most:
            blocks.append(1)
            filled = 0
        page[leaf] = len(blocks) - 1
        filled += n
        blocks[-1] = max(blocks[-1], -(-filled // most))
    return page, np.array(blocks or [1], dtype=np.int64)


def nearest(vectors: DataFrame, queries: DataFrame, most: int = NEAREST, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for each of ``queries`` its nearest ``vectors`` by inner product, itself left out.

    Both hold vec_id and vec. The tree is fitted on a bounded sample of vectors, shorter ones lifted to one length so that
    near in the tree means a large inner product, and broadcast; every vector is indexed under its leaf. A query visits
    leaves best bin first, as many as reach ``recall`` on calibration queries measured against all vectors, and more if
    they hold too few vectors. Neighbouring leaves lie on one page; a page meets the queries that visit it once, in blocks
    of about ``BLOCK`` vectors and ``QUERY_BLOCK`` queries, so a leaf of any size is many tasks. Visited vectors are
    scored exactly, in double precision, on the original vectors. Equal vectors are one vector with its ``most`` + 1 least
    ids: no query needs more of them, and copies never meet in pairs.

    The tree has at most ``SAMPLE`` leaves, so with more vectors leaves hold more of them. How many leaves a recall asks
    for depends on the data: without clusters, in many dimensions, it is a share of all (see the README's figures).

    Cases: rows whose id or vector is null, and vectors that are zero, hold a null or non-finite component or have an
    unusual length take no part. Of rows with the same id and vector one counts; rows with one id and several vectors
    are one candidate each. Queries with fewer candidates return all. Other columns aren't read. No rows give no rows.
    """
    spark = vectors.sparkSession
    all_ = usable(vectors.select("vec_id", F.col("vec").cast("array<double>")))
    equal = Window.partitionBy("vec").orderBy("vec_id")
    # the same vectors' least ids, found in each task before the shuffle
    ids = all_.distinct().withColumn("nth", F.row_number().over(equal)).where(F.col("nth") <= most + 1)
    listed = ids.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.xxhash64("vec").alias("h"), "vec", "ids")
    # an id of its own for each distinct vector, as one vec_id may have several vectors
    classes = durable(listed.select(F.monotonically_increasing_id().alias("vec_id"), "h", "vec", "ids"), "classes")
    sample = classes.orderBy("h", "vec").limit(SAMPLE).select("vec").toArrow()
    x = _matrix(sample["vec"].combine_chunks()) if sample.num_rows else np.zeros((0, 1))
    square = F.aggregate("vec", F.lit(0.0), lambda acc, v: acc + v * v)
    longest = math.sqrt(classes.agg(F.max(square)).first()[0] or 1.0)
    tree = Tree(directions(x, longest))
    shared = spark.sparkContext.broadcast(tree)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.assign(directions(_matrix(batch.column(1)), longest)) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], names=["vec_id", "vec", "ids", "leaf"])

    indexed = durable(classes.select("vec_id", "vec", "ids").mapInArrow(index, "vec_id long, vec array<double>, ids array<long>, leaf long"), "indexed")
    # a row for each leaf, at most SAMPLE of them
    found = indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("ids")).toPandas()
    counts, held = np.zeros(tree.leaves, dtype=np.int64), np.zeros(tree.leaves, dtype=np.int64)
    counts[found["leaf"]], held[found["leaf"]] = found["n"], found["ids"]
    visits = calibrated(tree, indexed, held, most, recall)
    page, blocks = pages_of(counts, BLOCK)
    asked = usable(queries.select("vec_id", F.col("vec").cast("array<double>")), x.shape[1]).distinct()
    # equal query vectors are searched once
    wanted = durable(asked.groupBy("vec").agg(F.min("vec_id")).select(F.monotonically_increasing_id().alias("q"), "vec"), "wanted")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each page that a query visits, with the leaves it visits there."""
        tree = shared.value
        for batch in batches:
            rows, pages, leaves = [], [], []
            for i, q in enumerate(asked_for(_matrix(batch.column(1)))) if batch.num_rows else ():
                seen = np.sort(np.array(tree.visits(q, visits, held, most + 1), dtype=np.int64))
                for own in np.split(seen, np.flatnonzero(np.diff(page[seen])) + 1):
                    if len(own):
                        rows.append(i)
                        pages.append(page[own[0]])
                        leaves.append(own)
            some = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(pages, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))], names=["q", "vec", "page", "leaves"])

    # queries are few beside their visits, and walking the tree is what takes the time
    spread = wanted.repartition(2 * spark.sparkContext.defaultParallelism)
    routed = durable(spread.mapInArrow(visit, "q long, vec array<double>, page long, leaves array<long>"), "routed")
    place = spark.createDataFrame([(i, int(p), int(blocks[p])) for i, p in enumerate(page)], "leaf long, page long, blocks long")
    asks = routed.groupBy("page").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("asks"))
    # a row for each leaf and for each page
    sizes = F.broadcast(durable(place.select("page", "blocks").distinct().join(asks, "page"), "sizes"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = indexed.join(F.broadcast(place.select("leaf", "page")), "leaf").join(sizes, "page")
    left = left.select("page", F.pmod(F.xxhash64("vec_id"), "blocks").alias("block"), each("asks").alias("ask"), "leaf", "vec_id", "vec", "ids")
    right = routed.join(sizes, "page").select("page", F.pmod(F.xxhash64("q"), "asks").alias("ask"), each("blocks").alias("block"), "q", "vec", "leaves")

    def score(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        x, q = (_matrix(t["vec"].combine_chunks()) for t in (vectors, queries))
        leaf, seen = vectors["leaf"].to_numpy(), queries["leaves"].combine_chunks()
        near, at = Nearest(q, most + 1), np.arange(len(x))
        visitor = np.repeat(np.arange(len(q)), np.diff(seen.offsets.to_numpy()))
        visited = seen.flatten().to_numpy()
        own, theirs = np.argsort(leaf, kind="stable"), np.argsort(visited, kind="stable")
        leaf, visited = leaf[own], visited[theirs]
        for k in np.unique(leaf) if len(q) else ():
            cols, rows = own[slice(*np.searchsorted(leaf, [k, k + 1]))], theirs[slice(*np.searchsorted(visited, [k, k + 1]))]
            if len(rows):
                near.meet(visitor[rows], x[cols], at[cols])
        found = near.settle()
        ids = vectors["ids"].take(pa.array(found[1], pa.int64()))
        return pa.table([pa.array(queries["q"].to_numpy()[found[0]], pa.int64()), vectors["vec_id"].take(pa.array(found[1], pa.int64())), pa.array(found[2], pa.float64()), ids], names=["q", "vec_id", "score", "ids"])

    keys = ["page", "block", "ask"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, "q long, vec_id long, score double, ids array<long>")
    lists = _ranked(pairs, most + 1, "q").groupBy("q").agg(F.collect_list(F.struct("score", "ids")).alias("found")).join(wanted, "q").select("vec", "found")
    # a query's list holds at most most + 1 vectors of at most most + 1 ids each
    hits = asked.withColumnRenamed("vec_id", "query_id").join(lists, "vec").select("query_id", F.explode("found").alias("f"))
    hits = hits.select("query_id", F.col("f.score").alias("score"), F.explode("f.ids").alias("vec_id")).where("vec_id <> query_id")
    return _ranked(hits, most).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vec"))
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))
