"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelens.llm.common import durable

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
#: Languages that the driver and all tasks hold a column of ``BUCKETS`` numbers for: 128 MB at most.
MOST_LANGUAGES = 256
SMOOTHING = 0.5
UNKNOWN = "und"
#: Texts are counted in slices of about this many characters, so that memory doesn't follow a batch's texts.
SLICE_CHARS = 1_000_000


def grams(codes: np.ndarray, starts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """A bucket for each n-gram of ``order`` code points, at its first position, and whether it lies in one text."""
    if len(codes) < order:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    with np.errstate(over="ignore"):
        mixed = np.full(len(codes) - order + 1, order, dtype=np.uint64)
        for k in range(order):
            mixed = (mixed ^ codes[k : len(codes) - order + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    inside = np.ones(len(mixed), dtype=bool)
    for back in range(1, order):
        across = starts[1:] - back
        inside[across[across < len(mixed)]] = False
    return (mixed % np.uint64(BUCKETS)).astype(np.int64), inside


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, lower-cased and with a space at both ends of each, and where each text begins."""
    spaced = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    return codes, np.concatenate([[0], np.cumsum([len(t) for t in spaced])]).astype(np.int64)


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    at, held, chars = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.as_py())
        chars += len(held[-1] or "")
        if chars >= SLICE_CHARS:
            yield at, held
            at, held, chars = i + 1, [], 0
    if held:
        yield at, held


def counted(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n): how often each n-gram bucket occurs in each language's texts; bucket -1 counts documents.

    Each task adds up what it has read, so the shuffle carries at most languages x buckets rows from a task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for at, texts in _slices(batch.column(0)):
                by_lang: dict[str, list[str]] = {}
                for lang, text in zip(langs[at : at + len(texts)], texts, strict=True):
                    by_lang.setdefault(lang, []).append(text)
                for lang, own in by_lang.items():
                    total = totals.setdefault(lang, np.zeros(BUCKETS + 1, dtype=np.int64))
                    codes, starts = folded(own)
                    for order in ORDERS:
                        bucket, inside = grams(codes, starts, order)
                        total[:-1] += np.bincount(bucket[inside], minlength=BUCKETS)
                    total[-1] += len(own)
        for lang, total in totals.items():
            bucket = np.flatnonzero(total)
            n = total[bucket]
            bucket[bucket == BUCKETS] = -1
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(bucket), pa.array(n)], names=["lang", "bucket", "n"])

    each = labelled.select("text", "lang").mapInArrow(count, "lang string, bucket long, n long")
    return each.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fitted(labelled: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors and log probabilities (buckets x languages) of the texts of ``labelled``.

    The driver receives languages x buckets counts, however many texts there are; more than ``MOST_LANGUAGES`` languages
    are an error, as neither the counts nor the matrix that is sent to all tasks would have a bound.
    """
    counts_ = durable(counted(labelled), "counts")
    if counts_.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: join them to groups first")
    rows = counts_.toPandas()
    langs = sorted(rows["lang"].unique())
    column = {lang: i for i, lang in enumerate(langs)}
    counts, documents = np.zeros((BUCKETS, len(langs))), np.zeros(len(langs))
    grams_of = rows[rows["bucket"] >= 0]
    counts[grams_of["bucket"], grams_of["lang"].map(column)] = grams_of["n"]
    counts += SMOOTHING
    for row in rows[rows["bucket"] < 0].itertuples():
        documents[column[row.lang]] = row.n
    return langs, np.log(documents / documents.sum()) if langs else documents, np.log(counts / counts.sum(axis=0, keepdims=True))


def identify(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, learned from the texts and non-null languages of ``labelled``.

    Every n-gram of a text counts, whatever its length. The score is the posterior probability of the predicted
    language. The matrix of log probabilities (2^16 buckets x languages) is broadcast; tasks add it up sparsely, over
    the n-grams that a text has.

    At most ``MOST_LANGUAGES`` languages, more are an error.

    Cases: a null text or one without a letter is ``und`` with score 0, and so is every text if nothing is learned.
    Ties go to the language that sorts first. Columns named ``lang_pred`` or ``score`` are replaced; the others pass
    unchanged, the language column too, which is no input of a prediction.
    """
    spark = docs.sparkSession
    docs = docs.drop("lang_pred", "score")
    langs, prior, matrix = fitted(labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang"))
    shared = spark.sparkContext.broadcast((langs, prior, np.ascontiguousarray(matrix.T)))
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    at_text = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, prior, by_lang = shared.value
        for batch in batches:
            guesses, scores = [], []
            for _, texts in _slices(batch.column(at_text)):
                known = [t is not None and bool(langs) and any(map(str.isalpha, t)) for t in texts]
                own = [t for t, yes in zip(texts, known, strict=True) if yes]
                if own:
                    codes, starts = folded(own)
                    sums = np.tile(prior, (len(own), 1))
                    for order in ORDERS:
                        bucket, inside = grams(codes, starts, order)
                        for j, row in enumerate(by_lang):
                            sums[:, j] += np.add.reduceat(row[bucket] * inside, starts[:-1])
                    sums -= sums.max(axis=1, keepdims=True)
                    sums = np.exp(sums)
                    sums /= sums.sum(axis=1, keepdims=True)
                    best = sums.argmax(axis=1)
                found = iter(zip(best, sums[np.arange(len(own)), best], strict=True)) if own else iter(())
                for yes in known:
                    guess, p = next(found) if yes else (None, 0.0)
                    guesses.append(langs[guess] if yes else UNKNOWN)
                    scores.append(float(p))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(guesses, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(score, schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    learn = docs.where(~held_out & F.col("doc_id").isNotNull())
    return identify(docs.select("doc_id", "text"), learn).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
