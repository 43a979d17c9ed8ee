import hashlib

import duckdb
import pytest

from wirelens.llm import queries
from wirelens.llm.line_dedup import dedup_lines

SF = "/root/testdata/sf0.001"
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def brute(rows):
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(BLANK))
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 40 or len(holders[key(x)]) < 5 or max(holders[key(x)]) == (-1 if doc is None else doc)]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_cases(spark):
    line = "Shared line of more than forty characters, ü and Ä too."
    rows = [(i, f"own {i}\n  {line.upper() if i % 2 else line}\t\nend") for i in range(7)]
    rows += [(6, f"{line}\n\n{line}"), (6, f"{line}\n\n{line}"), (None, line), (None, line), (8, None), (9, ""), (10, "\n\n"), (11, ("x" * 50 + "\n") * 20_000), (12, "short\nshort")]
    rows += [(20 + i, "y" * 39 + ("z" if i < 5 else "")) for i in range(10)]
    others = "_d string, _hash string, _dropped string, _t string, hash string, keeper string, gone string"
    df = spark.createDataFrame([(*r, "c", *"abcdefg") for r in rows], f"doc_id long, text string, n_lines string, {others}")
    out = dedup_lines(df)
    assert {tuple(r[c.split()[0]] for c in others.split(", ")) for r in out.collect()} == {tuple("abcdefg")}
    assert sorted(((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in out.collect()), key=str) == brute(rows)
    assert dedup_lines(df.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_oracle(spark, name):
    db = duckdb.connect()
    for t in ("documents", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in df.select(*columns).collect()) == sorted(map(str, want.fetchall()))


def test_digest(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {d: hashlib.sha256(t.encode()).hexdigest() for d, t, _, _ in brute(list(rows.items()))}
    assert {r.doc_id: r.kept_sha256 for r in queries.queries()["op2_line_dedup"](spark, SF).collect()} == want
