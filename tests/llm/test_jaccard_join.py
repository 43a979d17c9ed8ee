import random
import re

import numpy as np
import pytest

from wirelens.llm import jaccard_join as j
from wirelens.llm.components import components
from wirelens.llm.shingles import shingle_sets


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for k in range(i):
            both = len(sets[i] & sets[k])
            if both and 100 * both >= 75 * len(sets[i] | sets[k]):
                root[find(i)] = find(k)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for _ in range(60):
        words = rng.choices(vocabulary, k=rng.choice([1, 3, 5, 8, 30, 120]))
        if rng.random() < 0.3:
            words = words[:20] + passage + words[20:]
        for _ in range(rng.choice([1, 1, 1, 2, 12])):
            rows.append(" ".join(words))
            words = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                words = words[: max(1, int(len(words) * rng.uniform(0.7, 1)))]
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted((tuple(r) for r in j.jaccard_components(df).collect()), key=str)


def test_shingles():
    rng = random.Random(0)
    texts = [None, "", " \n", "One two", "one TWO", "a b c d e", "A  b\tc\nd\x0be f", "É é ß 日本 x y z", "x " * 3000] + [" ".join(rng.choices("abAB", k=rng.randint(0, 30))) for _ in range(200)]
    sets = shingle_sets(texts)
    names = {}
    for text, got in zip(texts, sets, strict=True):
        want = shingles(text)
        assert len(got) == len(want)
        names.setdefault(frozenset(want), set()).add(got.tobytes())
    assert all(len(v) == 1 for v in names.values())
    assert len({next(iter(v)) for v in names.values()}) == len(names)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_large_clusters(spark, monkeypatch):
    monkeypatch.setattr(j, "BLOCK", 7)
    rows = corpus(3)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", [5, 6])
def test_links_across_components_are_all_found(spark, monkeypatch, seed):
    """Large clusters of which the blocks find nothing: all links come from the holders of prefix tokens."""
    monkeypatch.setattr(j, "BLOCK", 7)
    monkeypatch.setattr(j, "_linked", lambda rows: rows.sparkSession.createDataFrame([], "a long, b long"))
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(6):  # chains and stars of near copies that share a passage
        base = words[:30] + rng.choices(words, k=60)
        for _ in range(15):
            texts.append(" ".join(base))
            base = list(base)
            base[rng.randrange(30, 90)] = rng.choice(words)
    rows = [(i, t) for i, t in enumerate(texts)]
    got, want = run(spark, rows), brute(rows)
    # clusters too small for blocks stay unlinked here; these have no set above the bound
    assert got == want


def test_a_cluster_without_a_main_component(spark, monkeypatch):
    """Many small groups in one cluster: the pairs that meet are those of a token, not those of the cluster."""
    monkeypatch.setattr(j, "BLOCK", 50)
    met = []
    real = j.durable
    monkeypatch.setattr(j, "durable", lambda df, label: (lambda t: (met.append(t.count()) if label == "pairs" else None, t)[1])(real(df, label)))
    rows = []
    phrase = lambda g: [f"p{g}.{i}" for i in range(6)]
    for g in range(150):  # groups of three near copies; two texts of neighbouring groups share a phrase, so all are one cluster
        base = [f"g{g}.{i}" for i in range(60)]
        for more in (phrase(g), phrase(g - 1), []):
            rows.append((len(rows), " ".join([*base, *more])))
    assert run(spark, rows) == brute(rows)
    assert met and max(met) < 3 * len(rows)


def test_linker_equals_brute_force(monkeypatch):
    monkeypatch.setattr(j, "CHUNK", 2)
    rows = corpus(4)
    sets = shingle_sets([t for _, t in rows])
    tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
    held = []
    for (doc, _), s in zip(rows, sets, strict=True):
        n = counts[np.searchsorted(tokens, s)]
        if len(s):
            held.append((doc, len(s), s[n > 1].tobytes(), n[n > 1].astype("<u2").tobytes(), doc))
    root = {doc: doc for doc, _ in rows}
    for a, b in j.Linker(held).links():
        old, new = max(root[a], root[b]), min(root[a], root[b])
        root = {k: new if v == old else v for k, v in root.items()}
    assert sorted(((d, len(s), root[d]) for (d, _), s in zip(rows, sets, strict=True)), key=str) == brute(rows)


def test_cases(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "same words"), (4, "same words"), (5, "SAME words"), (None, "same  words"), (None, "alone here"), (7, long), (6, long + " end"), (8, None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(None, None)][:0]) == []
    docs = spark.createDataFrame([(*r, "k", "a", "b") for r in rows], "doc_id long, text string, n string, _kept string, _nth string")
    kept = j.keep_first(docs).collect()
    assert kept[0].__fields__ == ["doc_id", "text", "n", "_kept", "_nth"] and {(r._kept, r._nth) for r in kept} == {("a", "b")}
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id is not None) == [(1, None), (2, ""), (3, " \n"), (4, "same words"), (6, long + " end"), (8, None)]
    assert [r.text for r in kept if r.doc_id is None] == ["alone here"]


def test_rows_are_kept_each_by_itself(spark):
    rows = [(1, "one text of its own here"), (1, "another one that is unlike it"), (None, "twice the same words stand here"), (None, "Twice the same words stand here"), (None, "and once these others that differ"), (2, ""), (2, ""), (None, None), (5, "a b c d e f g h i j k"), (5, "a b c d e f g h i j k"), (3, "A b c d e f g h i j k l")]
    kept = j.keep_first(spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, _hash string")).collect()
    got = sorted(((r.doc_id, r.text) for r in kept), key=str)
    same = [r for r in got if r[1] and r[1].lower().startswith("twice")]
    assert len(same) == 1 and same[0][0] is None
    assert [r for r in got if r not in same] == sorted([rows[0], rows[1], rows[4], rows[5], rows[6], rows[7], rows[10]], key=str)
    assert j.keep_first(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def passages(n, seed=1):
    """Texts of 6 out of 40 passages each: many share some, hardly any are linked."""
    rng = random.Random(seed)
    known = [" ".join(f"p{i}.{k}" for k in range(30)) for i in range(40)]
    return [" ".join(rng.sample(known, 6)) for _ in range(n)]


def held_sets(texts):
    sets = shingle_sets(texts)
    tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
    out = []
    for i, s in enumerate(sets):
        n = counts[np.searchsorted(tokens, s)]
        out.append((i, len(s), s[n > 1].tobytes(), n[n > 1].astype("<u2").tobytes(), i))
    return out


def test_orders_differ():
    """What the later orders leave of the candidates of the first: texts that share one passage of six aren't verified."""
    held = held_sets(passages(600))
    linker = j.Linker(held)
    first, verified = 0, 0
    index = {}
    for x in range(len(linker.uid)):
        reach, mine = linker.reach[x]
        own = linker.token[linker.cut[x] : linker.cut[x + 1]]
        first += len({y for t in own[linker.ranks[x][0][:reach]].tolist() for y in index.get(t, [])})
        for t in own[linker.ranks[x][0][:mine]].tolist():
            index.setdefault(t, []).append(x)
    assert linker.links() == []
    verified = linker.verified
    assert first > 1000 and verified < first / 10


def test_a_shingle_in_half_of_all_texts(spark):
    rng = random.Random(3)
    notice = "all rights of this notice are reserved by its owner"
    rows = []
    for i in range(400):
        words = [f"v{rng.randrange(2000)}" for _ in range(40)]
        rows.append((i, " ".join(words) + (f" {notice}" if i % 2 else "")))
    rows += [(1000 + i, t) for i, t in rows[:40]]
    assert run(spark, rows) == brute(rows)


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(500, 500 + i) for i in range(1, 50)]
    root = {n: n for e in edges for n in e}
    for a, b in edges:
        old, new = max(root[a], root[b]), min(root[a], root[b])
        root = {k: new if v == old else v for k, v in root.items()}
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(k, v) for k, v in root.items() if k != v}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
