import duckdb

from wirelens.llm.preference import OP3_SQL, format_preferences, format_sides, op3_chat_preference, with_other_answer

LINE = "pair_id long, chosen boolean, turn long, role string, text string, prompt string"


def render(turns):
    return "".join(f"<|{r or 'unknown'}|>\n{t or ''}\n" for r, t in turns)


def brute(rows):
    out = {}
    for pair in {r[0] for r in rows if r[0] is not None and r[1] is not None}:
        a, b = ([(r[3], r[4]) for r in sorted((r for r in rows if r[0] == pair and r[1] is side), key=lambda r: tuple((x is not None, x) for x in r[2:5]))] for side in (True, False))
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        out[pair] = (n, render(a[:n]), render(a[n:]), render(b[n:]), a[n:], b[n:])
    return out


def test_pairs(spark):
    rows = [
        (1, True, 0, "user", "hi"), (1, True, 1, "assistant", "good"), (1, False, 0, "user", "hi"), (1, False, 1, "assistant", "bad"), (1, False, 2, "user", "ü?"), (1, False, 3, "assistant", ""),
        (2, True, 5, "system", "s"), (2, True, 6, "user", "u"), (2, False, 0, "system", "s"), (2, False, 1, "user", "u"),
        (3, True, 0, "user", "alone"), (4, False, 0, "assistant", "alone"),
        (5, True, 0, None, None), (5, False, 0, None, None), (5, False, 1, None, None),
        (6, True, None, "user", "x"), (6, True, None, "user", "x"), (6, False, None, "user", "x"), (6, True, 1, "assistant", "long " * 100_000),
        (None, True, 0, "user", "lost"), (7, None, 0, "user", "lost"),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], LINE)
    want = brute(rows)
    got = format_preferences(df).collect()
    assert {r.pair_id for r in got} == set(want)
    for r in got:
        n, prompt, chosen, rejected, a, b = want[r.pair_id]
        assert (r.n_common, r.prompt, r.chosen, r.rejected) == (n, prompt, chosen, rejected)
        for text, spans, turns in ((r.chosen, r.chosen_spans, a), (r.rejected, r.rejected_spans, b)):
            assert [text[s.start : s.stop] for s in spans] == [(t or "") + "\n" for role, t in turns if role == "assistant"]
    assert format_preferences(df.where("false")).count() == 0


def test_other_answers(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "one"), (1, 2, "user", "more"), (1, 3, "assistant", "two"), (1, 4, "user", "end"), (2, 0, "assistant", "other"), (3, 0, "user", None), (4, None, None, None), (4, None, None, None), (None, 0, "assistant", "lost"), (5, 0, "assistant", "same"), (6, 1, "assistant", "same")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, chosen int")
    got = {r.pair_id: ([(t.role, t.text) for t in r.chosen], [(t.role, t.text) for t in r.rejected]) for r in with_other_answer(df).collect()}
    first = [("user", "q"), ("assistant", "one"), ("user", "more"), ("assistant", "two"), ("user", "end")]
    assert got == {
        1: (first, [*first[:3], ("assistant", "other"), ("user", "end")]),
        2: ([("assistant", "other")], [("assistant", "")]),
        3: ([("user", None)], [("user", None)]),
        4: ([(None, None)] * 2, [(None, None)] * 2),
        5: ([("assistant", "same")], [("assistant", "same")]),
        6: ([("assistant", "same")], [("assistant", "")]),
    }
    shared = {r.pair_id: (r.n_common, r.prompt, r.rejected) for r in format_sides(with_other_answer(df)).collect()}
    assert shared[1] == (3, render(first[:3]), "<|assistant|>\nother\n<|user|>\nend\n") and shared[5] == (1, "<|assistant|>\nsame\n", "")
    assert with_other_answer(df.where("false")).count() == 0


def test_query_equals_sql_and_shares_prompts(spark):
    db = duckdb.connect()
    db.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.01/conversations.parquet'")
    want = db.execute(OP3_SQL)
    names = [c[0] for c in want.description]
    rows = op3_chat_preference(spark, "/root/testdata/sf0.01").select(*names).collect()
    assert sorted(map(tuple, rows)) == sorted(want.fetchall())
    assert sum(r.n_common > 0 for r in rows) > 0.9 * len(rows)
