import math
import random
from collections import Counter
from fractions import Fraction

import pytest

from wirelens.llm import mixing as m


def deviation(shares, slots_passed):
    """The largest distance of any source from its share by the given weights, in blocks, after each slot."""
    slots = m.whole_weights(shares)
    period, schedule = sum(slots.values()), [s for s, _, _ in sorted(m.pfair_schedule(slots), key=lambda x: x[2])]
    whole = sum(Fraction(str(w)) for w in shares.values())
    scale = math.lcm(*(Fraction(str(w) ).denominator for w in shares.values()), whole.denominator)
    weight = {s: int(Fraction(str(w)) * scale) for s, w in shares.items()}
    total, done, worst = int(whole * scale), dict.fromkeys(shares, 0), 0
    # a source's distance is extreme just before and just after its own blocks
    for t in range(slots_passed):
        s = schedule[t % period]
        worst = max(worst, abs(done[s] * total - weight[s] * t))
        done[s] += 1
        worst = max(worst, abs(done[s] * total - weight[s] * (t + 1)))
    worst = max(worst, *(abs(done[s] * total - weight[s] * slots_passed) for s in shares))
    return Fraction(worst, total)


@pytest.mark.parametrize("seed", range(8))
def test_less_than_one_block(seed):
    rng = random.Random(seed)
    shares = {f"s{i}": rng.randint(1, rng.choice([3, 50, 2000])) for i in range(rng.randint(1, 25))}
    slots = m.whole_weights(shares)
    period = sum(slots.values())
    assert all(Fraction(slots[s], period) == Fraction(w, sum(shares.values())) for s, w in shares.items())
    done, schedule = Counter(), m.pfair_schedule(slots)
    assert [slot for _, _, slot in schedule] == list(range(period))
    for source, k, slot in schedule[:3000]:
        assert k == done[source]
        done[source] += 1
        for s, n in slots.items():
            assert abs(done[s] - Fraction(n * (slot + 1), period)) < 1
    assert Counter(s for s, _, _ in schedule) == slots


def test_given_weights_over_a_million_slots():
    assert deviation({"a": 0.33347, "b": 0.00001, "c": 0.66652}, 1_000_000) < 1
    assert deviation({"a": 1, "b": Fraction(1, 3), "c": "0.25"}, 1_000_000) < 1


def test_five_thousand_sources():
    """One of them has half of all weight; their weights stay as given."""
    shares = {f"s{i}": 1 + i % 7 for i in range(5000)}
    shares["s0"] = sum(shares.values()) - shares["s0"]
    slots = m.whole_weights(shares)
    assert Fraction(slots["s0"], sum(slots.values())) == Fraction(1, 2)
    assert deviation(shares, 1_000_000) < 1


def test_odd_weights():
    with pytest.raises(ValueError):
        m.whole_weights({"a": 0, "b": 1})
    assert m.whole_weights({}) == {} and m.pfair_schedule({}) == []
    assert m.whole_weights({"a": 0.1234567, "b": 0.8765433}) == {"a": 1234567, "b": 8765433}


@pytest.mark.parametrize(
    "shares",
    [
        {"a": 0.1234567, "b": 0.8765433},
        {"a": math.pi, "b": math.e, "c": 1 / 3, "d": 1e-7, "e": 12345.678901},
        {f"s{i}": math.sqrt(i + 1) for i in range(300)},
    ],
)
def test_weights_whose_period_is_too_long(shares):
    """The planned slots are less than one block from the exact weights at every slot, and hold each block in its window."""
    slots = m.whole_weights(shares)
    period = sum(slots.values())
    assert period > m.MOST_SLOTS
    plan = m.pfair_schedule(slots, m.MOST_SLOTS)
    assert [slot for _, _, slot in plan] == list(range(m.MOST_SLOTS))
    done = Counter()
    for source, k, slot in plan:
        n = slots[source]
        assert k == done[source]
        done[source] += 1
        # a source is furthest from its share just before and just after its own blocks
        assert abs(k * period - n * slot) < period and abs((k + 1) * period - n * (slot + 1)) < period
    assert all(abs(done[s] * period - n * m.MOST_SLOTS) < period for s, n in slots.items())


def test_rows_beyond_the_planned_slots(spark, monkeypatch):
    """Spans are said again, and a source that has no block in one goes beside the others."""
    monkeypatch.setattr(m, "MOST_SLOTS", 50)
    shares = {"a": 0.1234567, "b": 0.8765432, "rare": 0.0000001}
    docs = spark.createDataFrame([(i, "rare" if i % 100 == 7 else "ab"[i % 2]) for i in range(4000)], "doc_id long, source string")
    out = m.mix(docs, shares, block=4).collect()
    assert len(out) == len({r.doc_id for r in out}) == 4000
    planned = m.pfair_schedule(m.whole_weights(shares), 50)
    at = {s: [slot for x, _, slot in planned if x == s] for s in shares}
    used = Counter(x for x, _, _ in planned)
    assert used["a"] and used["b"] and not used["rare"]
    for r in out:
        if used[r.source]:
            assert r.slot == r.block // used[r.source] * 50 + at[r.source][r.block % used[r.source]]
        else:
            assert r.slot == r.block * 10_000_000


def test_default_weights():
    slots = m.tempered({"a": 10**9, "b": 10**6, "c": 1})
    assert slots["a"] > slots["b"] > slots["c"] >= 1 and abs(sum(slots.values()) - m.LEAST_PERIOD) <= 3
    many = m.tempered({f"s{i}": 10 ** (i % 7) for i in range(5000)})
    assert len(set(many.values())) >= 5 and min(many.values()) >= 1


def test_rows(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), "t" * (i % 7), "old", 1, 2, 3) for i in range(3000)] + [(7, "a", "x", "old", 1, 2, 3)] * 40 + [(None, None, None, None, None, None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, slot string, _hash int, _source int, _n int")
    shares = {"a": 0.5, "b": 0.3, "c": 0.1}
    out = m.mix(docs, shares).collect()
    assert Counter((r.doc_id, r.source, r.text, r._hash, r._source, r._n) for r in out) == Counter(r[:3] + r[4:] for r in rows)
    slots = m.whole_weights(shares | {"": 0.1})
    at = {(s, k): slot for s, k, slot in m.pfair_schedule(slots)}
    by = {}
    for r in out:
        source = r.source or ""
        by.setdefault(source, []).append(r.block * m.BLOCK + r.place)
        assert r.slot == r.block // slots[source] * sum(slots.values()) + at[source, r.block % slots[source]]
    for ranks in by.values():
        assert sorted(ranks) == list(range(len(ranks)))
    ordered = m.interleaved(docs, shares)
    assert ordered.columns == docs.columns
    assert Counter(tuple(r) for r in ordered.collect()) == Counter(rows)
    assert m.mix(docs.where("false")).count() == 0 == m.interleaved(docs.where("false")).count()


def test_order_within_parts(spark):
    docs = spark.createDataFrame([(i, "aaab"[i % 4], f"t{i}") for i in range(2000)], "doc_id long, source string, text string")
    slots = {r.doc_id: r["at"] for r in m.places(docs, {"a": 1, "b": 1}).collect()}
    from pyspark.sql import functions as F

    parts = {}
    for r in m.interleaved(docs, {"a": 1, "b": 1}).withColumn("p", F.spark_partition_id()).collect():
        parts.setdefault(r.p, []).append(slots[r.doc_id])
    assert all(p == sorted(p) for p in parts.values()) and sum(map(len, parts.values())) == 2000
