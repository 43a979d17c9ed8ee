"""Spelling variants of a corpus's words: neighbours at distance one by single deletions, and the forms they lead to."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelens.llm.common import durable, lower_ascii
from wirelens.llm.crc_sql import CRC_TABLE, crc32_of
from wirelens.llm.shingles import mixed

RUN = "[a-zÀ-ÿ]+"
#: Words of at least so many code points and occurrences; a form has at least so many times the occurrences of its word.
LEAST_CHARS, LEAST_COUNT, RATIO = 6, 5, 5
#: One run of a document in so many loses a code point.
MISPRINT = 199
#: Code points whose deletions are hashed at a time.
SLICE_CHARS = 1_000_000
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 2**64)

KEYS = "key long, pos int, wid long, first boolean, whole boolean"


def misprinted(docs: DataFrame) -> DataFrame:
    """(word) for each run of Latin letters of the whole texts, A-Z lower-cased, of which CRC-32 makes one in ``MISPRINT``
    lose a code point: the run's hash with the document's id tells which. A null doc_id counts as an empty one."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(RUN), F.lit(0))).alias("run"))
    hash_ = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (hash_ % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return runs.select(F.when(hash_ % MISPRINT == 0, cut).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; counted in each task before the shuffle."""
    long_ = words.where(F.char_length("word") >= LEAST_CHARS)
    return long_.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def _hashed(words: list[str]) -> list[np.ndarray]:
    """Columns of ``KEYS`` but for the id, where ``wid`` is the word's place: each word, and it without each code point.

    A word's hash is the sum of its code points' random numbers times powers of a base, so deletions follow from sums of
    prefixes: a word takes time and memory in proportion to its length, however long it is.
    """
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    length = np.array([len(w) for w in words], np.int64)
    owner, size = np.repeat(np.arange(len(words)), length), len(codes)
    begin = np.repeat(np.cumsum(length) - length, length)
    end = begin + length[owner]
    with np.errstate(over="ignore"):
        power, inverse = (np.cumprod(np.append(np.ones(1, np.uint64), np.full(size, b, np.uint64)), dtype=np.uint64) for b in (_BASE, _INVERSE))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(codes + np.uint64(1)) * power[:size], dtype=np.uint64)])
        at = np.arange(size)
        kept = (total[at] - total[begin]) * inverse[begin] + (total[end] - total[at + 1]) * inverse[begin + 1]
        heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if size else np.zeros(0, np.int64)
        whole = (total[end[heads]] - total[begin[heads]]) * inverse[begin[heads]]
        keys = mixed(np.concatenate([kept, whole]))
    again = np.append(False, (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1]))[:size]
    ones = np.ones(len(heads), bool)
    return [keys.view(np.int64), np.concatenate([at - begin, 0 * heads]).astype(np.int32), np.concatenate([owner, owner[heads]]), np.concatenate([~again, ones]), np.concatenate([np.zeros(size, bool), ones])]


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in KEYS.split(", ")]
    for batch in batches:
        ids, words = np.asarray(batch.column(0)), batch.column(1)
        at = 0
        while at < batch.num_rows:
            held, chars, first = [], 0, at
            while at < batch.num_rows and chars < SLICE_CHARS:
                held.append(words[at].as_py())
                chars += len(held[-1])
                at += 1
            columns = _hashed(held)
            columns[2] = ids[first + columns[2]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def neighbours(words: DataFrame) -> DataFrame:
    """(a, b) for each two words that differ by exactly one inserted, deleted or replaced code point, once.

    ``words`` is a stored table of (wid, word, ...), each word once. Every word emits the hash of itself and of each of
    its deletions. Words that differ in one place agree in the deletion at that place, and a word that lacks a code point of
    another is a deletion of it (of its distinct ones, so a pair meets once); so two equi-joins find all, and what shares a
    key at one place is a neighbour but for collisions of the hash: at most the alphabet's letters meet at a key, pairs
    grow with the neighbours there are. The words themselves then tell whether their distance is one.
    """
    keys = durable(words.select("wid", "word").mapInArrow(_emit, KEYS), "deletions")
    cut, whole = keys.where("NOT whole"), keys.where("whole")
    mine, other = (cut.select("key", "pos", F.col("wid").alias(w)) for w in ("a", "b"))
    replaced = mine.join(other, ["key", "pos"]).where("a < b").select("a", "b", "pos", F.lit(0).alias("more"))
    inserted = whole.select("key", F.col("wid").alias("a")).join(cut.where("first").select("key", "pos", F.col("wid").alias("b")), "key").select("a", "b", "pos", F.lit(1).alias("more"))
    met = replaced.unionByName(inserted)
    for side in ("a", "b"):
        met = met.join(words.select(F.col("wid").alias(side), F.col("word").alias(f"w{side}")), side)
    a, b, pos, rest = F.col("wa"), F.col("wb"), F.col("pos"), F.char_length("wb")
    behind = a.substr(pos + 2 - F.col("more"), rest)
    one = (a != b) & (rest - F.char_length("wa") == F.col("more")) & (a.substr(F.lit(1), pos) == b.substr(F.lit(1), pos)) & (behind == b.substr(pos + 2, rest))
    return met.where(one).select("a", "b")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where following forms ends. Forms never come back to a word.

    Each round replaces a root by that root's own, so rounds grow with the logarithm of the longest way.
    """
    now = durable(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        stepped = durable(now.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "roots")
        if not stepped.where("moved").limit(1).count():
            return stepped.select("word", "root")
        now = stepped.select("word", "root")


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each row of ``words`` (word, n: each word once).

    A word's form is its neighbour (:func:`neighbours`) of largest n, of equal ones the smallest in the order of code points,
    if that n is at least ``RATIO`` times its own; ``root`` is where forms end, the word itself without a form.

    Cases: no rows give no rows. Null words take no part. Words of any length. Other columns aren't read.
    """
    own = durable(words.where("word IS NOT NULL").select(F.monotonically_increasing_id().alias("wid"), "word", "n"), "words")
    near = neighbours(own)
    ways = near.select("a", "b").unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    facts = own.select(F.col("wid").alias("b"), F.struct((-F.col("n")).alias("less"), F.col("word").alias("word")).alias("other"))
    best = ways.join(facts, "b").groupBy(F.col("a").alias("wid")).agg(F.count(F.lit(1)).alias("n_near"), F.min("other").alias("best"))
    top = -F.col("best.less")
    large = top >= RATIO * F.col("n")
    found = own.join(best, "wid", "left").select(
        "word", F.when(large, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(large, top).alias("form_n")
    )
    found = durable(found, "forms")
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(counted(misprinted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))))


OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY ALL),
hashed AS (SELECT run, k, {crc32_of("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc),
printed AS (
  SELECT CASE WHEN h % {MISPRINT} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, k FROM hashed),
words AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM printed WHERE length(word) >= {LEAST_CHARS} GROUP BY 1 HAVING sum(k) >= {LEAST_COUNT}),
cuts AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS cut FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word AS word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT w.word, c.word, c.n FROM words w JOIN cuts c ON w.word = c.cut
  UNION SELECT c.word, w.word, w.n FROM words w JOIN cuts c ON w.word = c.cut),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(less := -m, other := other)) AS b FROM near GROUP BY 1),
forms AS MATERIALIZED (
  SELECT w.word, CASE WHEN -b.less >= {RATIO} * n THEN b.other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= {RATIO} * n THEN -b.less END AS form_n
  FROM words w LEFT JOIN best USING (word)),
way AS (
  SELECT word, coalesce(form, word) AS at FROM forms
  UNION SELECT way.word, f.form FROM way JOIN forms f ON way.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN way USING (word) JOIN forms e ON way.at = e.word WHERE e.form IS NULL
"""
