"""Quality rules: base limits, then robust multivariate outliers per language and source."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wirelens.llm.common import TRIMMED, durable, let, unused, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: The share of a group's documents that the estimate rests on.
SUBSET = 0.75
#: A group's estimate is drawn towards that of its language, and a language's towards that of all documents, as if so
#: many documents of the larger group belonged to it.
PRIOR = 50
#: Starts besides the two deterministic ones, each from about so many documents.
SEEDS, PICKED = 10, 10
#: All starts take so many concentration steps, then the best few go on until no determinant falls, at most so many.
FIRST_STEPS, BEST, MOST_STEPS = 2, 3, 30
#: Bins of the squared distance's logarithm, in which a step finds its subset: so many to a factor of e.
PER_E, LEAST_LOG, BINS = 64, -14.0, 1920
#: Probability that a document of a normal population passes.
PASS = 0.999
#: Of each statistic, the least standard deviation that counts: without it a statistic that is zero in most documents would
#: make any other value an outlier. 3 % of the mean word length; on the scale log(1 + percent) 0.4 for symbols and 0.7 for
#: repeated lines and words. With the cutoff, 5.2 of them: a statistic alone rejects a document whose word length is 17 %
#: off, or of 7 % symbols, or with 38 % of its lines or words repeated, where the group has nothing like it.
FLOORS = {"x0": 0.03, "x1": 0.4, "x2": 0.7, "x3": 0.7}
#: Estimates of up to so many groups (with starts) are sent to all tasks, about 300 bytes each; more are joined, each in
#: so many copies that share out the group's documents.
SENT, SALTS = 20_000, 64
DIMS = list(FLOORS)
PAIRS = [(i, j) for i in range(len(DIMS)) for j in range(i + 1)]
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeated(found: Column) -> Column:
    """How many of the words lie in a 3-word window that occurs twice or more (windows compared by 64-bit hash)."""

    def covered(starts: Column) -> Column:
        none = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            starts, none, lambda a, s: F.struct(s.alias("last"), (a["n"] + F.least(s - a["last"], F.lit(3))).alias("n")), lambda a: a["n"]
        )

    def twice(windows: Column) -> Column:
        def same(j: Column) -> Column:
            own = F.get(windows, j)["h"]
            return F.coalesce(F.get(windows, j - 1)["h"] == own, F.lit(False)) | F.coalesce(F.get(windows, j + 1)["h"] == own, F.lit(False))

        at = F.filter(F.sequence(F.lit(0), F.size(windows) - 1), lambda j: same(j))
        return covered(F.sort_array(F.transform(at, lambda j: F.get(windows, j)["i"])))

    def counted(hashes: Column) -> Column:
        """Most texts repeat no window, which the set of hashes tells; only the others are sorted."""
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(F.sort_array(placed), twice))

    def windows(w: Column) -> Column:
        hashed = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) >= 4, let(hashed, counted)).otherwise(F.lit(0).cast("long"))

    return let(found, windows)


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the five counts, ``n_lines`` (lines with a word) and ``base_failed``, in place of columns of these names."""
    docs = docs.drop(*STATISTICS, "n_lines", "base_failed")
    (found,) = unused(docs.columns, "words")
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(TRIMMED)) != "")
    counts = {
        "n_words": F.size(found),
        "word_chars": F.char_length(F.array_join(found, "")),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _repeated(F.col(found)),
        "n_lines": F.size(lines),
    }
    counted = docs.withColumn(found, words(F.col("text"))).select(*docs.columns, *[c.cast("long").alias(n) for n, c in counts.items()])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def transformed() -> dict[str, Column]:
    """The statistic vector: word length, symbols, repeated lines and repeated words, on logarithmic scales."""

    def percent(part: str, of: str) -> Column:
        return F.log1p(100.0 * F.col(part) / F.greatest(F.col(of), F.lit(1)))

    return {
        "x0": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        "x1": percent("n_symbols", "n_words"),
        "x2": percent("n_dup_lines", "n_lines"),
        "x3": percent("n_repeat_words", "n_words"),
    }


def chi_square(x: float, dims: int) -> float:
    """Distribution function of chi square for an even number of dimensions."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dims // 2))


def chi_square_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dims) < p else (low, mid)
    return low


def consistency() -> float:
    """What a covariance of the nearest ``SUBSET`` of a normal population is multiplied by to estimate the whole's."""
    return SUBSET / chi_square(chi_square_quantile(SUBSET, len(DIMS)), len(DIMS) + 2)


def cutoff() -> float:
    return chi_square_quantile(PASS, len(DIMS))


MEANS, COVS = [f"m{i}" for i in range(len(DIMS))], [f"c_{i}_{j}" for i, j in PAIRS]
LOWER = [f"l_{i}_{j}" for i, j in PAIRS]


def _with_triangle(estimates: DataFrame) -> DataFrame:
    """Estimates (m{i}, c_{i}_{j}) with l_{i}_{j}, the lower triangle whose square is the covariance plus the floors, and
    ``d``, the logarithm of that matrix's determinant."""
    for i, j in PAIRS:
        rest = F.col(f"c_{i}_{j}") + (FLOORS[DIMS[i]] ** 2 if i == j else 0.0)
        for k in range(j):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
        estimates = estimates.withColumn(f"l_{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"l_{j}_{j}"))
    return estimates.withColumn("d", 2 * sum((F.log(f"l_{i}_{i}") for i in range(1, len(DIMS))), F.log("l_0_0")))


def _distance() -> Column:
    """Squared Mahalanobis distance of x0.. from m0.., by forward substitution in l_i_j."""
    z: list[Column] = []
    for i, x in enumerate(DIMS):
        rest = F.col(x) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * z[k]
        z.append(rest / F.col(f"l_{i}_{i}"))
    return sum((c * c for c in z[1:]), z[0] * z[0])


def _sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.sum(x).alias(f"s{i}") for i, x in enumerate(DIMS)],
        *[F.sum(F.col(DIMS[i]) * F.col(DIMS[j])).alias(f"q_{i}_{j}") for i, j in PAIRS],
    ]


def _moments() -> list[Column]:
    """Means and covariances of the sums n, s{i}, q_{i}_{j}."""
    mean = [F.col(f"s{i}") / F.col("n") for i in range(len(DIMS))]
    return [*[m.alias(f"m{i}") for i, m in enumerate(mean)], *[(F.col(f"q_{i}_{j}") / F.col("n") - mean[i] * mean[j]).alias(f"c_{i}_{j}") for i, j in PAIRS]]


KEY = ["level", "g_lang", "g_source"]


def attached(rows: DataFrame, facts: DataFrame, keys: list[str], few: bool, how: str = "inner") -> DataFrame:
    """``rows`` with the ``facts`` of their group, without bringing a group's rows together.

    ``few`` facts (at most ``SENT`` have been counted) are sent to all tasks. More are joined in ``SALTS`` copies each, of
    which a row meets the one that a hash of its column ``pick`` names.
    """
    if few:
        return rows.join(F.broadcast(facts), keys, how)
    (salt,) = unused([*rows.columns, *facts.columns], "salt")
    copies = facts.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn(salt, F.pmod(F.xxhash64("pick"), F.lit(SALTS)).cast("int")).join(copies, [*keys, salt], how).drop(salt)


def _starts(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Estimates that concentration begins with: all documents, median and quartiles, and ``SEEDS`` picks of documents; and
    whether they are few enough to be sent."""
    # percentiles of rounded values need no more memory than there are such values
    at = [F.percentile(F.round(x, 2), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(x) for x in DIMS]
    groups = durable(rows.groupBy(*KEY).agg(*_sums(), *at), "groups")
    few = groups.count() * (SEEDS + 2) <= SENT
    classic = groups.select(*KEY, F.col("n").alias("total"), F.lit(0).alias("start"), *_moments())
    spread = [(F.get(x, F.lit(2)) - F.get(x, F.lit(0))) / 1.349 for x in DIMS]
    middle = groups.select(
        *KEY,
        F.col("n").alias("total"),
        F.lit(1).alias("start"),
        *[F.get(x, F.lit(1)).alias(f"m{i}") for i, x in enumerate(DIMS)],
        *[(spread[i] * spread[i] if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, j in PAIRS],
    )
    sized = attached(rows, groups.select(*KEY, F.col("n").alias("total")), KEY, few)
    mine = lambda seed: F.pmod(F.xxhash64("pick", seed), F.ceil(F.col("total") / PICKED)) == 0
    seeds = F.filter(F.array(*[F.lit(2 + k) for k in range(SEEDS)]), mine)
    picked = sized.withColumn("start", F.explode(seeds)).groupBy(*KEY, "total", "start").agg(*_sums())
    return classic.unionByName(middle).unionByName(picked.select(*KEY, "total", "start", *_moments())), few


def _concentrated(rows: DataFrame, now: DataFrame, few: bool) -> DataFrame:
    """Each estimate after a step: distances, the nearest ``SUBSET`` of the group, its mean and covariance.

    One aggregation by (group, start, bin of the distance); the subset's sums are those of the bins up to the one in which
    it is full. An estimate whose determinant wouldn't fall stays as it is; ``better`` tells.
    """
    keys = [*KEY, "start"]
    bin_of = F.least(F.greatest(F.floor((F.log(_distance() + 1e-300) - LEAST_LOG) * PER_E), F.lit(0)), F.lit(BINS - 1))
    met = attached(rows, now.select(*keys, "total", *MEANS, *LOWER), KEY, few)
    binned = met.withColumn("bin", bin_of).groupBy(*keys, "total", "bin").agg(*_sums())
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    names = ["n", *[f"s{i}" for i in range(len(DIMS))], *[f"q_{i}_{j}" for i, j in PAIRS]]
    cumulated = binned.select(*keys, "total", F.col("n").alias("own"), *[F.sum(c).over(upto).alias(c) for c in names])
    enough = F.ceil(F.col("total") * SUBSET)
    subset = cumulated.where((F.col("n") >= enough) & (F.col("n") - F.col("own") < enough))
    values = [*MEANS, *COVS, *LOWER, "d"]
    new = _with_triangle(subset.select(*keys, *_moments())).select(*keys, F.struct(*values).alias("new"))
    both = now.select(*keys, "total", "better", F.struct(*values).alias("old")).join(new, keys)
    # a start's own determinant counts for nothing, as it needn't belong to a subset
    better = F.col("better").isNull() | (F.col("new.d") < F.col("old.d") - 1e-9)
    return both.select(*keys, "total", F.when(better, F.col("new")).otherwise(F.col("old")).alias("e"), better.alias("better")).select(*keys, "total", "e.*", "better")


def estimates(vectors: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimates of each (language, source), each language and all documents.

    ``vectors`` holds g_lang, g_source, x0... and ``pick``, a hash of the row. Several starts take two concentration steps,
    and of each group the ``BEST`` ones with the least determinants go on until no determinant falls. No group is sorted
    or gathered, and a hot group is pre-aggregated in its tasks. Columns: level, g_lang, g_source, total (documents of the
    group), m{i}, c_{i}_{j}, and d, the determinant's logarithm.
    """
    levels = F.array(
        F.struct(F.lit(0).alias("level"), F.lit("").alias("g_lang"), F.lit("").alias("g_source")),
        F.struct(F.lit(1).alias("level"), F.col("g_lang"), F.lit("").alias("g_source")),
        F.struct(F.lit(2).alias("level"), F.col("g_lang"), F.col("g_source")),
    )
    rows = vectors.select(F.explode(levels).alias("k"), *DIMS, "pick").select("k.*", *DIMS, "pick")
    begun, few = _starts(rows)
    now = durable(_with_triangle(begun).withColumn("better", F.lit(None).cast("boolean")), "starts")
    rank = Window.partitionBy(*KEY).orderBy("d", "start")
    for step in range(MOST_STEPS):
        now = durable(_concentrated(rows, now, few), f"step{step}")
        if step + 1 == FIRST_STEPS:
            now = now.withColumn("nth", F.row_number().over(rank)).where(F.col("nth") <= BEST).drop("nth")
            now = durable(now, "best")
        if not now.where("better").limit(1).count():
            break
    first = now.withColumn("nth", F.row_number().over(rank)).where("nth = 1")
    return first.select(*KEY, "total", *MEANS, *COVS, "d")


def _drawn(own: DataFrame, larger: DataFrame, keys: list[str]) -> DataFrame:
    """Estimates drawn towards those of the larger group that they share ``keys`` with: of the mixture of both, in which
    the larger one has the weight of ``PRIOR`` documents."""
    theirs = larger.select(*keys, *[F.col(c).alias(f"p_{c}") for c in [*MEANS, *COVS]])
    share = F.col("total") / (F.col("total") + PRIOR)
    apart = [F.col(m) - F.col(f"p_{m}") for m in MEANS]
    mean = [(F.col(m) * share + F.col(f"p_{m}") * (1 - share)).alias(m) for m in MEANS]
    cov = [
        (F.col(f"c_{i}_{j}") * share + F.col(f"p_c_{i}_{j}") * (1 - share) + apart[i] * apart[j] * share * (1 - share)).alias(f"c_{i}_{j}") for i, j in PAIRS
    ]
    return own.join(theirs, keys).select(*[c for c in own.columns if c not in {*MEANS, *COVS}], *mean, *cov)


def shrunken(found: DataFrame) -> DataFrame:
    """(g_lang, g_source, m{i}, l_{i}_{j}) of each language and source: its estimate, drawn towards that of its language,
    which is drawn towards that of all documents. So groups of any size, of one document even, have one."""
    level = lambda k: found.where(F.col("level") == k).drop("level", "d").withColumn("whole", F.length("g_lang") * 0)
    langs = _drawn(level(1), level(0), ["whole"])
    return _with_triangle(_drawn(level(2), langs, ["g_lang"])).select("g_lang", "g_source", *MEANS, *LOWER)


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, text_hash, counts, base_failed, kept, distance) of each row of ``docs``; the texts are left out.

    A document is kept if it passes the base limits and its squared Mahalanobis distance, under the estimate of its
    language and source, is within the cutoff. The estimates rest on all documents that pass the base limits.

    Cases: a null text has no words and fails. Null languages and sources are groups of their own. A document that fails
    the base limits in a group where all do has no distance. Repeated rows count and are judged each. Only doc_id, text,
    lang and source are read, so other columns may have any name. An empty table gives no rows.
    """
    narrow = docs.select("doc_id", "text", "lang", "source", F.coalesce("lang", F.lit("\x00")).alias("g_lang"), F.coalesce("source", F.lit("\x00")).alias("g_source"))
    counted = with_statistics(narrow.withColumn("text_hash", F.xxhash64("text"))).drop("text")
    stored = durable(counted.withColumns(transformed()).withColumn("pick", F.xxhash64("doc_id", "text_hash")), "statistics")
    found = durable(estimates(stored.where(~F.col("base_failed"))), "estimates")
    chosen = durable(shrunken(found), "chosen")
    few = chosen.limit(SENT + 1).count() <= SENT
    out = attached(stored, chosen, ["g_lang", "g_source"], few, "left").withColumn("distance", _distance() / consistency())
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff())
    return out.select("doc_id", "lang", "source", "text_hash", *STATISTICS, "base_failed", kept.alias("kept"), "distance")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`judged` keeps, with all their columns, of any name.

    Cases: those of :func:`judged`; each row is judged by itself, by its own text, language and source. No rows give no rows.
    """
    facts = ["doc_id", "lang", "source", "text_hash"]
    named = dict(zip(facts, unused(docs.columns, "id", "lang", "source", "hash"), strict=True))
    gone = judged(docs).where(~F.col("kept")).select(*facts).distinct().withColumnsRenamed(named)
    same = [(F.xxhash64("text") if c == "text_hash" else F.col(c)).eqNullSafe(F.col(n)) for c, n in named.items()]
    return docs.join(gone, same, "left_anti")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return judged(docs).select("doc_id", *STATISTICS, "base_failed", "kept", F.round("distance", 4).alias("distance"))
