import math
import random

import numpy as np
import pytest

from wirelens.llm import language_id
from wirelens.llm.language_id import BUCKETS, ORDERS, SMOOTHING


def buckets(text):
    """The buckets of one text, n-gram by n-gram."""
    spaced, out = f" {text.lower()} ", []
    for order in ORDERS:
        for i in range(len(spaced) - order + 1):
            codes = np.array([ord(c) for c in spaced[i : i + order]], dtype=np.uint64)
            out.append(int(language_id.grams(codes, np.array([0, order]), order)[0][0]))
    return out


def brute_force(texts, labelled):
    langs = sorted({lang for _, lang in labelled})
    counts = {lang: {} for lang in langs}
    for text, lang in labelled:
        for b in buckets(text):
            counts[lang][b] = counts[lang].get(b, 0) + 1
    out = []
    for text in texts:
        logs = []
        for lang in langs:
            total = sum(counts[lang].values()) + SMOOTHING * BUCKETS
            log = math.log(sum(own == lang for _, own in labelled) / len(labelled))
            logs.append(log + sum(math.log((counts[lang].get(b, 0) + SMOOTHING) / total) for b in buckets(text)))
        top = max(logs)
        odds = [math.exp(x - top) for x in logs]
        best = odds.index(max(odds))
        out.append((langs[best], odds[best] / sum(odds)))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(1)
    words = {"aa": ["the", "of", "and", "x"], "bb": ["der", "und", "ß", "Öl"], "cc": ["le", "était", "çà"]}
    labelled = [(" ".join(rng.choices(words[lang], k=rng.randint(1, 6))), lang) for lang in words for _ in range(15)]
    texts = [" ".join(rng.choices(sum(words.values(), []), k=rng.randint(1, 4))) for _ in range(40)]
    model = spark.createDataFrame([*labelled, (None, "aa"), ("dropped", None)], "text string, lang string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()}
    for i, (lang, score) in enumerate(brute_force(texts, labelled)):
        assert got[i][0] == lang
        assert got[i][1] == pytest.approx(score, abs=1e-9)


def test_cases(spark):
    rows = [(1, None, "a", "q"), (2, "", "a", None), (3, "123 !", None, "q"), (None, "the end", "a", "q"), (5, "und " * 300_000, "b", "q"), (5, "und " * 300_000, "b", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = sorted((r.doc_id or 0, r.lang, r.lang_pred) for r in language_id.identify(docs, docs).collect() if r.lang)
    assert got == [(0, "a", "a"), (1, "a", "und"), (2, "a", "und"), (5, "b", "b"), (5, "b", "b")]
    assert language_id.identify(docs, docs).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    none = language_id.identify(docs, docs.where("false")).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert language_id.identify(docs.where("false"), docs).count() == 0


def test_held_out_accuracy(spark):
    out = language_id.op6_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = out.where("held_out AND lang_pred <> 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 0.95 * len(rows)


def test_languages_have_a_bound(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "some words here", f"l{k}") for k in range(4)], "doc_id long, text string, lang string")
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 4)
    assert len(language_id.fitted(docs)[0]) == 4
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 3)
    with pytest.raises(ValueError, match="more than 3 languages"):
        language_id.fitted(docs)
