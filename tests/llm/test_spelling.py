import zlib
from collections import Counter

import duckdb
import pytest

from wirelens.llm import spelling as t


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute(counts):
    near = {w: [x for x in counts if one_apart(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def table(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def words(spark, counts):
    return spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, WID string")


def test_against_brute_force(spark):
    import random

    draw = random.Random(5)
    counts = {"".join(draw.choices("abé", k=draw.randint(6, 8))): draw.choice([5, 6, 25, 30, 125, 150, 700, 4000]) for _ in range(600)}
    found = table(t.variants(words(spark, counts)))
    assert found == brute(counts)
    assert max(x[3] for x in found.values()) > 8 and sum(f is not None and r != f for f, r, *_ in found.values()) > 20


def test_chains_ties_and_repeated_letters(spark):
    counts = {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "aaaaaaab": 625, "aaaaabab": 3125, "zzzzzz": 5, "zzzzzx": 25, "zzzzxz": 25, "zzzzzy": 24, "éééééé": 24, "ééééée": 5, "abcdef": 9, "abdcef": 900}
    found = table(t.variants(words(spark, counts)))
    assert found == brute(counts)
    assert found["aaaaaa"][1] == "aaaaabab" and found["zzzzzz"][0] == "zzzzxz" and found["ééééée"][0] is None and found["abcdef"][3] == 0


def test_very_long_words(spark):
    long_ = "ab" * 150_000
    counts = {long_: 500, long_[:777] + "x" + long_[777:]: 5, long_[:-1] + "y": 6, long_[1:]: 7, "short-": 5}
    found = table(t.variants(words(spark, counts)))
    assert [found[w][3] for w in counts] == [3, 1, 1, 1, 0]
    assert all(found[w][0] == long_ for w in list(counts)[1:4])


def test_misprints_and_counts(spark):
    rows = [(k, f"Grüße,größer_grö\nGRÖSSER {'naïvetés' * (k % 3)} aÿbcdef×g x") for k in range(800)] + [(None, "Straßen " * 6), (7, None), (8, ""), (9, "Éclair éclairs" * 3), (9, "Éclair éclairs" * 3)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, RUN int")
    want = Counter()
    for i, text in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        run = ""
        for c in low + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
            run = ""
    counts = {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    assert {r.word: r.n for r in t.counted(t.misprinted(docs)).collect()} == counts
    assert len(counts) > 3 and min(want.values()) < 5
    assert table(t.variants(t.counted(t.misprinted(docs)))) == brute(counts)


def test_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b c")], "doc_id long, text string")
    for rows in (docs, docs.where("false")):
        out = t.variants(t.counted(t.misprinted(rows)))
        assert out.collect() == [] and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert t.variants(words(spark, {"abcdef": 5}).selectExpr("cast(null as string) AS word", "n")).collect() == []


@pytest.mark.parametrize("sf", ["0.001"])
def test_query_against_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
        want = {r[0]: r[1:] for r in con.execute(f"SELECT word, form, root, n, n_near, form_n FROM ({t.OP12_SQL})").fetchall()}
    assert table(t.op12_spelling_variants(spark, folder)) == want
