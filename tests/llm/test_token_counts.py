import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wirelens.llm import token_counts as t

PATH = public_tokenizers.path(t.TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = t.Counter(PATH)


def library(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_whole_table_against_the_library(spark):
    out = t.op11_token_counts(spark, "/root/testdata/sf0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    want = dict(zip(texts, library([x or "" for x in texts.values()]), strict=True))
    for r in rows:
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), want[r.doc_id], want[r.doc_id] > 512)


PARTS = st.sampled_from([*"abcdeilmrstv'  \n\t\r\x0b\x85\xa0 　123.,!-_éߊ中的ñ٠Ⅷ́\U0001f600", "'s", "'re", "'ll", " the", "<|endoftext|>", "<|endof", "ing"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=40).map("".join), max_size=6))
def test_any_text_against_the_library(texts):
    assert COUNTER.counts(texts).tolist() == library(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_any_character_against_the_library(texts):
    assert COUNTER.counts(texts).tolist() == library(texts)


def test_chunks_cut_anywhere(monkeypatch):
    texts = ["".join(np.random.default_rng(k).choice(list("abrest''  \n1.é"), 3000)) for k in range(5)] + ["'s" * 900, "''" * 700 + "s", " " * 2000 + "a", "'re'll" * 300]
    want = library(texts)
    for chunk, tail in ((1, 1), (2, 1), (7, 2), (64, 3), (4096, 16)):
        monkeypatch.setattr(t, "CHUNK", chunk)
        monkeypatch.setattr(t, "TAIL", tail)
        assert COUNTER.counts(texts).tolist() == want


def test_long_words_and_forgotten_transitions(monkeypatch):
    texts = ["a" * 3_001, "ab" * 900 + "'s", "".join(np.random.default_rng(3).choice(list("abcdefghij"), 3_000)), *("".join(np.random.default_rng(k).choice(list("etaoin shrdlu"), 400)) for k in range(30))]
    monkeypatch.setattr(t, "MOST_TRANSITIONS", 300)
    monkeypatch.setattr(t, "BLOCK_BYTES", 1_000)
    monkeypatch.setattr(t, "LOOK", 500)
    assert t.Counter(PATH).counts(texts).tolist() == library(texts)


def test_cases(spark):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "<|endoftext|> x<|endoftext|>"), (2, "word " * 600), (2, "word " * 600)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, N_TOKENS string, n_bytes int")
    out = t.token_counts(docs, PATH)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(d, len((x or "").encode()), n, n > 512) for (d, x), n in zip(rows, library([x or "" for _, x in rows]), strict=True)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert t.token_counts(docs.where("false"), PATH).collect() == []


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        t.Counter(public_tokenizers.path("word_bpe_49k.json"))
