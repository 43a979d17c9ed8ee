import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as p
from tests.llm.test_jaccard_join import brute
from tests.llm.test_packing import piece_by_piece
from tests.llm.test_quality import counts
from wirelens.llm import quality
from wirelens.llm.tokens import cuts


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = docs.columns
    out.append(docs)
    for k, (_, stage) in enumerate(p.STAGES):
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k + 1 < len(p.STAGES):
            assert docs.columns == columns
        out.append(docs)
    return out


def table(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_against_brute_force(spark, stages):
    docs, good, lines, single, mixed, packed = stages
    before, kept = table(docs), table(good)
    verdict = {r.doc_id: r for r in quality.judged(docs).collect()}
    for i, r in before.items():
        n, _, _, _, repeated = counts(r.text)
        assert verdict[i].base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert (i in kept) == verdict[i].kept
        assert i not in kept or kept[i] == r

    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip("\x20\x09\x0a\x0b\x0c\x0d"))
    holders = {}
    for i, r in kept.items():
        for line in (r.text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    after = table(lines)
    for i, r in kept.items():
        left = [x for x in (r.text or "").split("\n") if len(key(x)) < 40 or len(holders[key(x)]) < 5 or max(holders[key(x)]) == i]
        text = "\n".join(left)
        if left == (r.text or "").split("\n"):
            assert after[i] == r
        elif text.strip("\x20\x09\x0a\x0b\x0c\x0d"):
            assert (after[i].text, after[i].n_chars, after[i].source) == (text, len(text), r.source)
        else:
            assert i not in after

    groups = brute([(i, r.text) for i, r in after.items()])
    ones = table(single)
    assert set(ones) == {i for i, _, c in groups if i == c}
    assert all(ones[i] == after[i] for i in ones)
    assert table(mixed) == ones and mixed.count() == len(ones)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows, rooms, lengths = packed.collect(), {}, []
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        rooms[r.sequence_id] = rooms.get(r.sequence_id, 1024) - r.length
    for i, r in ones.items():
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids + [2]
        own = sorted(pieces[i], key=lambda x: x.piece)
        assert [t for x in own for t in x.ids] == ids
        assert [(x.start, x.length) for x in own] == cuts(len(ids), 1024)
        lengths += [x.length for x in own]
    assert sorted(rooms.values()) == piece_by_piece(lengths, 1024)


def test_run(spark, stages):
    out = p.run(spark, "/root/testdata/sf0.001")
    assert sorted((r.doc_id, r.start, r.length) for r in out.collect()) == sorted((r.doc_id, r.start, r.length) for r in stages[-1].collect())


def test_repeated_and_missing_ids(spark, tmp_path):
    """Rows are judged, kept and packed each by itself, whatever their ids; other columns of any name pass unchanged."""
    prose = lambda k: " ".join(f"word{(k * 7919 + i * i) % 4001}" for i in range(90))
    junk = "buy now " * 60
    rows = [(k // 2, prose(k), "en", "web", 1, "n") for k in range(40)]  # two unlike texts for each id
    rows += [(None, prose(100 + k), "en", "web", 1, "n") for k in range(3)] + [(None, prose(100), "en", "web", 1, "n")]
    rows += [(7, junk, "en", "web", 1, "n"), (7, None, None, None, None, "n"), (None, "", "en", "web", 0, "n"), (50, prose(0), "en", "web", 1, "n")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _hash string"
    now = spark.createDataFrame(rows, schema)
    for k, (name, stage) in enumerate(p.STAGES[:-1]):
        stage(spark, now, "").write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars", "_hash"], name
    kept = sorted(((r.doc_id, r.text) for r in now.collect()), key=str)
    assert kept == sorted([r[:2] for r in rows[:43]], key=str)  # all but junk, blank rows and what repeats a text
    packed = p.pack_sequences(spark, now, "").collect()
    assert sorted((str(r.doc_id) for r in packed if r.piece == 0), key=str) == sorted((str(r[0]) for r in rows[:43]), key=str)


def test_empty_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "a b", "x", None, 3), (2, "", None, "s", 0), (2, "", None, "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    for rows, left in ((docs, [None, 1, 2, 2]), (docs.where("false"), [])):
        now = rows
        for _, stage in p.STAGES[1:]:
            now = stage(spark, now, "")
        packed = now.collect()
        assert sorted((r.doc_id for r in packed), key=str) == sorted(left, key=str) and all(r.sequence_id is not None for r in packed)
        assert sum(r.length for r in packed) == (6 if left else 0)
        assert p.STAGES[0][1](spark, rows, "").count() == 0


def test_weights_reach_the_sequences(spark, monkeypatch, tmp_path):
    rows = [(i, "some words " * 100, "en", "ab"[i % 2], 1100) for i in range(600)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/docs")
    docs, found = spark.read.parquet(f"{tmp_path}/docs"), []
    for shares in ({"a": 9.0, "b": 1.0}, {"a": 1.0, "b": 9.0}):
        monkeypatch.setattr(p, "SHARES", shares)
        out = p.pack_sequences(spark, p.mix_sources(spark, docs, ""), "").collect()
        assert sorted({r.sequence_id for r in out}) == list(range(1 + max(r.sequence_id for r in out)))
        early = [r.source for r in sorted(out, key=lambda r: (r.sequence_id, r.offset))][:200]
        found.append((sorted(r.doc_id for r in out), early.count("a") / 200))
    assert found[0][0] == found[1][0] == list(range(600))
    assert found[0][1] > 0.8 and found[1][1] < 0.2
