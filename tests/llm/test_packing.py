import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wirelens.llm import packing
from wirelens.llm.tokens import Encoder, cuts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def piece_by_piece(lengths, capacity):
    """Best-fit decreasing, one piece at a time over a plain list of bins."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(bins) if room >= n]
        if fitting:
            bins[min(fitting, key=lambda i: (bins[i], i))] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(20))
def test_plan_equals_piece_by_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 100, 1024])
    lengths = [rng.randint(1, capacity) if rng.random() < 0.7 else max(1, capacity // 3) for _ in range(400)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    rooms, seen = {}, {n: 0 for n in counts}
    for n, start, end, each, first, offset in packing.best_fit_plan(counts, capacity):
        assert start == seen[n]
        seen[n] = end
        for i in range(end - start):
            used = rooms.setdefault(first + i // each, 0)
            assert used == offset + (i % each) * n
            rooms[first + i // each] = used + n
    assert seen == counts
    assert sorted(capacity - used for used in rooms.values()) == piece_by_piece(lengths, capacity)


def test_cuts():
    assert cuts(1, 4) == [(0, 1)]
    assert cuts(4, 4) == [(0, 4)]
    assert cuts(8, 4) == [(0, 4), (4, 4)]
    assert cuts(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_ids_equal_the_tokenizers():
    """Against the tokenizer as its file gives it, with the strings of added tokens anywhere."""
    whole, ours, rng = Tokenizer.from_file(PATH), Encoder(PATH), random.Random(4)
    end = "<|endoftext|>"
    texts = ["", "Hello  world, it's 12½ x²", "a\x1cb\x85  c \n\n d ", "日本 α", "ǅa 's'll\t\t", end, end * 2, f"hello {end} world", f"in{end}side", f"{end} α", "<|endof text|>", f" {end}\n"]
    parts = ["hello", " ", "  ", "\n", "it's", "été", "12", "<|", "|>", end, "endoftext", "#", "日本", "\t", "Ab"]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(ours.packed(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert 50256 in np.frombuffer(ours.packed(f"hello {end} world"), "<u4")


def test_documents(spark):
    rows = [(1, "word " * 5000, "a"), (2, None, None), (2, None, None), (3, "", "b"), (None, "some text", "c"), (4, "x", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank_ string")
    out = packing.pack_documents(docs, PATH, carry=["doc_id", "rank_"]).collect()
    assert sum(r.doc_id == 2 for r in out) == 2
    by = {}
    for r in out:
        assert len(r.ids) == r.length
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    whole = Tokenizer.from_file(PATH)
    long = [r for r in sorted((r for r in out if r.doc_id == 1), key=lambda r: r.piece)]
    assert [i for r in long for i in r.ids] == whole.encode(rows[0][1], add_special_tokens=False).ids + [2]
    empty = packing.pack_documents(docs.where("false"), PATH)
    assert empty.count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(docs.withColumnRenamed("rank_", "length"), PATH, carry=["doc_id", "length"])
