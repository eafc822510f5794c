"""PU learning on made-up texts with marker words."""

import random

import numpy as np
import pytest

from lotwise.llm import toxicity


def _rows(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.15
        words = rng.choices(vocab, k=rng.randrange(20, 80))
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "nasty", "foul"]))
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_edge_texts(spark, documents):
    rows, labels = _rows(1, 900)
    edge = [(2000, None, "en", "a"), (2001, "", "en", "a"), (2002, "!!", "en", "a"), (None, "vile foul nasty", "en", "a")]
    docs = documents(rows + edge)
    half = spark.createDataFrame([x for x in labels if x[0] < 600] + [(5, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs.filter("doc_id < 600"), half)
    scored = docs.select("doc_id", toxicity.score(docs["text"], model).alias("s")).collect()
    got = {r["doc_id"]: r["s"] for r in scored}
    assert len(scored) == len(rows) + 4 and all(0 <= x <= 1 for x in got.values())
    held = [(got[i] >= 0.5) == bool(t) for i, t in labels if i >= 600]
    assert np.mean(held) > 0.97
    assert got[2000] == got[2001] == got[2002] < 0.5 and got[None] > 0.5
    kept = toxicity.remove_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(x < 0.5 for x in got.values())


def test_a_rerun_agrees(spark, documents):
    rows, labels = _rows(2, 200)
    docs, marks = documents(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    a, b = (toxicity.train(docs.repartition(n), marks) for n in (2, 5))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_nothing_to_learn_from(spark, documents):
    docs = documents([(1, "some words", "en", "a")])
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert toxicity.remove_toxic(docs, model).count() == 1
    assert toxicity.train(docs.limit(0), spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")).bias < 3


def test_the_negative_part_never_drives_the_fit():
    # positives hidden in all unlabelled texts: the corrected risk keeps their scores up
    rows = [np.array([1, 2], np.int32)] * 50 + [np.array([3], np.int32)] * 50 + [np.array([1, 2], np.int32)] * 10
    positive = np.array([True] * 50 + [False] * 60)
    s = toxicity.Settings(buckets=8)
    model = toxicity.fit_nnpu(rows, positive, 1 / 6, s)
    score = lambda cols: 1 / (1 + np.exp(-(model.bias + model.weights[cols].sum())))
    assert score([1, 2]) > 0.9 and score([3]) < 0.2
    assert toxicity.fit_nnpu([], np.zeros(0, bool), 0.2, s).bias == pytest.approx(np.log(0.25))


def _plain_fit(rows, positive, prior, s):
    """The same risk, gradient and steps, feature by feature in plain Python."""
    import math

    n_pos, n_unl = sum(positive), len(rows) - sum(positive)
    in_pos, in_unl = {}, {}
    for row, p in zip(rows, positive):
        for x in row:
            side = in_pos if p else in_unl
            side[x] = side.get(x, 0) + 1
    told = []
    for x in sorted({*in_pos, *in_unl}):
        p0 = (in_unl.get(x, 0) + 1) / (n_unl + 2)
        z = (in_pos.get(x, 0) / n_pos - p0) / math.sqrt(p0 * (1 - p0) * (1 / n_pos + 1 / n_unl))
        if in_pos.get(x, 0) + in_unl.get(x, 0) >= s.rare and abs(z) >= s.surprise:
            told.append(x)
    w, bias = dict.fromkeys(told, 0.0), math.log(prior / (1 - prior))
    m, v = dict.fromkeys([*told, None], 0.0), dict.fromkeys([*told, None], 0.0)
    turned = 0
    for step in range(1, s.rounds + 1):
        f = [bias + sum(w[x] for x in row if x in w) for row in rows]
        risk_u = sum(math.log1p(math.exp(a)) for a, p in zip(f, positive) if not p) / n_unl
        risk_p = sum(math.log1p(math.exp(a)) for a, p in zip(f, positive) if p) / n_pos
        below = risk_u - prior * risk_p < 0
        turned += below
        slope = dict.fromkeys([*told, None], 0.0)
        for a, p, row in zip(f, positive, rows):
            sigma = 1 / (1 + math.exp(-a))
            if below:  # climb back: against the gradient of the negative part alone
                g = prior * sigma / n_pos if p else -sigma / n_unl
            else:
                g = prior * (sigma - 1) / n_pos - prior * sigma / n_pos if p else sigma / n_unl
            slope[None] += g
            for x in row:
                if x in w:
                    slope[x] += g
        for x in told:
            slope[x] += s.decay * w[x]
        for x in slope:
            m[x] = 0.9 * m[x] + 0.1 * slope[x]
            v[x] = 0.999 * v[x] + 0.001 * slope[x] ** 2
            move = s.rate * (m[x] / (1 - 0.9**step)) / (math.sqrt(v[x] / (1 - 0.999**step)) + 1e-8)
            if x is None:
                bias -= move
            else:
                w[x] -= move
    return w, bias, turned


@pytest.mark.parametrize("prior", [0.1, 0.6])
def test_fit_against_plain_arithmetic(prior):
    rng = np.random.default_rng(5)
    rows, positive = [], []
    for i in range(160):
        p = i % 4 == 0
        own = set(rng.choice(30, 8, replace=False).tolist()) | ({40, 41} if p or rng.random() < 0.1 else set())
        rows.append(np.array(sorted(own), np.int32))
        positive.append(p)
    s = toxicity.Settings(buckets=64, rounds=40, surprise=2.0)
    got = toxicity.fit_nnpu(rows, np.array(positive), prior, s)
    w, bias, turned = _plain_fit([r.tolist() for r in rows], positive, prior, s)
    assert {40, 41} <= set(w) and (turned > 0 or prior < 0.5)
    assert got.bias == pytest.approx(bias, rel=1e-6)
    assert {i: x for i, x in enumerate(got.weights.tolist()) if x} == pytest.approx({i: x for i, x in w.items() if x}, rel=1e-4)


def test_scores_against_plain_sums(spark, documents):
    import math

    import xxhash

    rng = np.random.default_rng(6)
    model = toxicity.Model(rng.normal(0, 1, 97).astype(np.float32), -0.3)
    texts = [None, "", "a b c", "A a A", "é x9 — foo_bar", "long " * 200_000 + "end", "a b c"]
    docs = documents([(i, t, None, None) for i, t in enumerate(texts)] + [(2, "a b c", None, None)])
    docs = docs.selectExpr("*", "1 AS features", "2 AS toxic_", "map('a', 1) AS m")
    for r in docs.select("text", toxicity.score(docs["text"], model).alias("s")).collect():
        words = set()
        for word in "".join(c.lower() if "A" <= c <= "Z" else c if c >= "\x80" or c.isalnum() else " " for c in r["text"] or "").split(" "):
            words |= {word} - {""}
        f = model.bias + sum(float(model.weights[x]) for x in {xxhash.xxh32_intdigest(w.encode()) % 97 for w in words})
        assert r["s"] == pytest.approx(1 / (1 + math.exp(-f)), rel=1e-5)
