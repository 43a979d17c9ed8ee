"""URL filters: rules by host and path, and for other URLs a logistic regression on hashed character n-grams."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelens.llm.common import UPPER, let

#: (verdict, rule); a rule is a host and the beginning of a path.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
BUCKETS = 4096
ORDERS = (3, 4)
#: At most so many distinct labelled URLs of each label are learned from, those with the least hashes.
LABELLED = 1000
STEPS, RATE, RIDGE = 200, 2.0, 1e-4


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; then up to ``?``, ``#`` or the end.

    Both are empty for null and for URLs without ``://``. A-Z in hosts is lower-cased.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does. A rule fits its host and all subdomains."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, _, start = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(f"/{start}"))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def gram_buckets(host: Column, path: Column) -> Column:
    """The distinct buckets of the URL's n-grams; host and path are marked, so that they don't mix. Linear in its length."""
    texts = [F.concat(F.lit("^"), host, F.lit("$")), F.concat(F.lit(">"), path, F.lit("<"))]

    def grams(letters: Column) -> Column:
        def of(order: int) -> Column:
            starts = F.sequence(F.lit(0), F.greatest(F.size(letters) - order, F.lit(0)))
            return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(order), *[F.get(letters, i + k) for k in range(order)]), F.lit(BUCKETS)).cast("int"))

        return F.concat(*map(of, ORDERS))

    return F.array_distinct(F.concat(*[let(F.split(text, ""), grams) for text in texts]))


def weights_column(weights: list[float]) -> Column:
    """The weights as one constant array."""
    return F.from_json(F.lit(json.dumps(weights)), "array<double>")


def logit(buckets: Column, weights: list[float]) -> Column:
    """Sum of the buckets' weights, scaled by the root of their number, plus the bias that stands last."""
    w = weights_column(weights)
    total = F.aggregate(buckets, F.lit(0.0), lambda acc, b: acc + F.get(w, b))
    return total / F.sqrt(F.greatest(F.size(buckets), F.lit(1)).cast("double")) + F.lit(weights[BUCKETS])


def fit(labelled: DataFrame, steps: int = STEPS) -> list[float]:
    """Weights of a logistic regression of ``blocked`` (0/1) on the URLs' n-gram buckets, by gradient descent.

    ``labelled`` (host, path, blocked) is the small labelled table: at most ``LABELLED`` distinct URLs of a label, those
    with the least hashes, whose buckets (at most ``BUCKETS`` numbers each) the driver reads once and descends on. Both
    labels weigh the same in sum.
    """
    rows = labelled.where("host <> '' AND blocked IS NOT NULL").select("host", "path", "blocked").distinct()
    chosen = [rows.where(F.col("blocked") == y).orderBy(F.xxhash64("host", "path"), "host", "path").limit(LABELLED) for y in (0, 1)]
    table = [(r[0], r[1]) for r in chosen[0].unionByName(chosen[1]).select("blocked", gram_buckets(F.col("host"), F.col("path"))).collect()]
    weights = np.zeros(BUCKETS + 1)
    if not table:
        return weights.tolist()
    y, sizes = np.array([r[0] for r in table], dtype=float), np.array([len(r[1]) for r in table])
    bucket, row = np.concatenate([r[1] for r in table]), np.repeat(np.arange(len(table)), sizes)
    labels = len(set(y.tolist()))
    share, root = np.where(y == 1, 1 / max(1, (y == 1).sum()), 1 / max(1, (y == 0).sum())) / labels, np.sqrt(sizes)
    for _ in range(steps):
        z = np.bincount(row, weights[bucket], len(table)) / root + weights[BUCKETS]
        error = (1 / (1 + np.exp(-z)) - y) * share
        slopes = np.append(np.bincount(bucket, (error / root)[row], BUCKETS), error.sum())
        weights = weights * (1 - RATE * RIDGE) - RATE * slopes
    return [round(w, 9) for w in weights.tolist()]


def accuracy(labelled: DataFrame, steps: int = STEPS) -> tuple[float, float, int]:
    """Share of right verdicts, share blocked, and number of the labelled URLs of held-out hosts (crc32 mod 4 is 2), by a
    model of the other hosts' URLs."""
    held = F.crc32("host") % 4 == 2
    weights = fit(labelled.where(~held), steps)
    scored = labelled.where(held & F.col("blocked").isNotNull() & (F.col("host") != "")).select("blocked", (logit(gram_buckets(F.col("host"), F.col("path")), weights) > 0).cast("int").alias("said"))
    right, blocked, n = scored.agg(F.avg((F.col("blocked") == F.col("said")).cast("int")), F.avg("said"), F.count(F.lit(1))).first()
    return right, blocked, n


def ruled(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(host, path, blocked) of the URLs of ``pages``; blocked is null where no rule decides."""
    host, path = url_parts(F.col("url"))
    parts = pages.select(F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    return parts.withColumn("blocked", (rule_of(F.col("host"), F.col("path"), rules)[1] == "block").cast("int"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (the model's probability of block).

    The longest fitting rule decides; other URLs are blocked where the model finds block likelier than not. Without
    ``labelled`` (host, path, blocked), the model learns from URLs that rules decide.

    Cases: null URLs and those without ``://`` have empty host and path, fit no rule and go by the model, like all
    others. With no labelled URL the score is 0.5 and the verdict allow. Repeated rows are judged alike. Columns with
    the five names added here are replaced; other columns, of any name, pass unchanged. An empty table gives no rows.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "score")
    host, path = url_parts(F.col("url"))
    parts = pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    rule, decided = rule_of(F.col("host"), F.col("path"), rules)
    weights = fit(ruled(pages, rules) if labelled is None else labelled)
    score = 1 / (1 + F.exp(-logit(gram_buckets(F.col("host"), F.col("path")), weights)))
    judged = parts.withColumns({"rule": rule, "score": score})
    verdict = F.coalesce(decided, F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return judged.select(*pages.columns, "host", "path", "rule", verdict.alias("verdict"), "score")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))
