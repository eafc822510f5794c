"""Targets, multipliers and copies against plain computations."""

import math
import random
from collections import Counter

import pytest

from lotwise.llm import mixing


def plain_targets(totals, weights=(5.0, 2.0, 1.0), budget=1.5, most=2.0):
    """Share by weight; hand on what a source cannot take, until none is above its cap."""
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, open_, out = budget * sum(totals.values()), set(order), {}
    while True:
        w = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / w > most * totals[s]} if w else set()
        if not above:
            return out | {s: left * weight[s] / w for s in open_}
        for s in above:
            out[s] = most * totals[s]
            left -= out[s]
        open_ -= above


def _rows(n):
    rng = random.Random(1)
    rows = [(0, None, "a", "s0"), (1, "", "a", "s0"), (2, " \n", "a", "empty"), (3, "one two", "a", None)]
    for i in range(4, n):
        source = "hot" if rng.random() < 0.34 else rng.choice(["s0", "s1", "É", "z", None, ""])
        rows.append((i, "w " * int(rng.paretovariate(1.2) * 10), "a", source))
    return rows + [rows[9], rows[9], (None, "with no id", "a", "s1")]


def test_targets_match_resharing(spark):
    totals = {"a": 10, "b": 1000, "c": 5000, "d": 3, "e": 0, "É": 77, None: 400}
    rows = [(s, t, max(1, t // 5)) for s, t in totals.items()]
    df = spark.createDataFrame(rows, "source string, total bigint, docs bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == {s: pytest.approx(t) for s, t in plain_targets(totals).items()}
    assert mixing.source_targets(df.limit(0)).count() == 0


def test_copies_meet_targets(documents):
    rows = _rows(3000)
    docs = documents(rows)
    got = mixing.with_copies(docs, mixing.plan(docs)).collect()
    assert len(got) == len(rows)
    size, taken = Counter(), Counter()
    for r in got:
        m = r["mix"]
        assert m["size"] == len((r["text"] or "").split()) and 0 <= m["copies"] <= 2
        size[r["source"]] += m["size"]
        taken[r["source"]] += m["size"] * m["copies"]
    want = plain_targets(size)
    for r in got:
        assert r["mix"]["source_size"] == size[r["source"]]
        assert r["mix"]["target"] == pytest.approx(want[r["source"]])
    assert all(abs(taken[s] - t) <= 0.02 * t + 1 for s, t in want.items())
    again = mixing.with_copies(docs.repartition(5), mixing.plan(docs.repartition(3))).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["mix"]["copies"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["mix"]["copies"] for r in got)


def test_multipliers_solve_the_dual(spark):
    hist = {("a", 1): 50, ("a", 10): 20, ("a", 300): 2, ("b", 5): 10, ("c", 4): 3}
    target = {"a": 700.0, "b": 25.0, "c": 24.0}
    histogram = spark.createDataFrame([(s, z, n) for (s, z), n in hist.items()], "source string, size bigint, n bigint")
    totals = {s: (sum(z * n for (x, z), n in hist.items() if x == s), sum(n for (x, _), n in hist.items() if x == s)) for s in target}
    targets = spark.createDataFrame([(s, *totals[s], target[s]) for s in target], "source string, total bigint, docs bigint, target double")
    for r in mixing.tilts(histogram, targets).collect():
        words = sum(n * z * min(2, math.exp(r["x"] * z / r["mean"])) for (s, z), n in hist.items() if s == r["source"])
        assert words == pytest.approx(target[r["source"]], rel=1e-5)


def test_no_documents(documents):
    docs = documents([(1, "a b", "en", "a")]).limit(0)
    assert mixing.mixed(docs).count() == 0
