import numpy as np
import pytest

from wirelens.llm import ann


def brute(rows, queries, most):
    fine = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for i, q in fine:
        if i in queries:
            out[i] = sorted(((-float(v @ q), k) for k, v in fine if k != i))[:most]
    return out


def check(got, want, recall):
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(want)
    hit = total = 0
    for i, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(want[i]) + 1))
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        hit += len({r.vec_id for r in rows} & {k for _, k in want[i]})
        total += len(want[i])
    assert hit >= recall * total


def test_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 24)) * 2
    x = (centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 24))) * rng.uniform(0.5, 1.5, (3000, 1))
    x[1000:1400] = x[1000]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<double>")
    got = ann.nearest(df, df.where("vec_id % 20 = 0")).collect()
    check(got, brute(rows, set(range(0, 3000, 20)), 20), 0.9)
    for r in got[:200]:
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id]), rel=1e-12)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 30)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 3)
    rows = [(i, [float(i % 17), float(i % 5), 1.0]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<double>")
    check(ann.nearest(df, df.where("vec_id % 20 = 0")).collect(), brute(rows, set(range(0, 400, 20)), 20), 0.9)


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, [nan, 1.0]), (60, [inf, 1.0]), (80, None), (None, [1.0, 1.0]), (100, [None, 1.0]), (1, [2.0, 1.0]), (2, [2.0, 1.0]), (3, [-1.0, 5.0]), (3, [-1.0, 5.0]), (120, [2.0, 1.0]), (140, [1.0, 2.0, 3.0]), (160, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, vec array<double>, score string")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(df, df.where("vec_id % 20 = 0")).collect())
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 120, 2.0), (0, 4, 3, -1.0), (120, 1, 1, 5.0), (120, 2, 2, 5.0), (120, 3, 3, 3.0), (120, 4, 0, 2.0)]
    assert ann.nearest(df.where("false"), df).count() == 0 == ann.nearest(df, df.where("false")).count()


def test_best_bin_first():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 8))
    tree = ann.Tree(x)
    sizes = np.bincount(tree.assign(x), minlength=tree.leaves)
    order = tree.visits(x[5], tree.leaves, sizes, 0)
    assert sorted(order) == np.flatnonzero(sizes).tolist() and order[0] == tree.assign(x[5:6])[0]
    assert order[:3] == tree.visits(x[5], 3, sizes, 0)
    assert (tree.assign(x)[:50] == [tree.visits(v, 1, sizes, 0)[0] for v in x[:50]]).all()
    assert sizes[tree.visits(x[5], 1, sizes, 300)].sum() >= 300 > sizes[tree.visits(x[5], 1, sizes, 300)[:-1]].sum()


@pytest.mark.parametrize("seed", range(5))
def test_nearest_of_parts(seed):
    """Met in parts of any size, the nearest are those of all, ties by id."""
    rng = np.random.default_rng(seed)
    x, q = rng.integers(-2, 3, (700, 3)).astype(float), rng.integers(-2, 3, (9, 3)).astype(float)
    near, at = ann.Nearest(q, 20), 0
    while at < len(x):
        n = int(rng.integers(1, 90))
        near.meet(np.arange(9), x[at : at + n], np.arange(at, min(at + n, len(x))))
        at += n
        if rng.random() < 0.5:
            near.settle()
    rows, ids, scores = near.settle()
    for k in range(9):
        want = sorted((-float(v @ q[k]), i) for i, v in enumerate(x))[:20]
        assert [(-s, i) for s, i in zip(scores[rows == k], ids[rows == k], strict=True)] == want


def test_lengths_count():
    """The nearest point of the lifted vectors is the one of the largest inner product."""
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(500, 6)) * rng.uniform(0.1, 3, (500, 1)), rng.normal(size=(20, 6))
    lifted = ann.directions(x, np.linalg.norm(x, axis=1).max())
    far = ((lifted[None] - ann.asked_for(q)[:, None]) ** 2).sum(2)
    assert (far.argmin(1) == (q @ x.T).argmax(1)).all()


def test_pages():
    page, blocks = ann.pages_of(np.array([5, 5, 0, 3, 25, 1, 10]), 10)
    assert page.tolist() == [0, 0, 0, 1, 2, 3, 4] and blocks.tolist() == [1, 1, 3, 1, 1]


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(ann.op10_nearest_neighbours(spark, "/root/testdata/sf0.01").collect(), brute(rows, {i for i, _ in rows if i % 20 == 0}, 20), 0.9)
