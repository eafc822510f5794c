"""The audit against counting term by term and source by source."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from lotwise.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, top=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        groups.add((lang or "", source or ""))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= 3)
        sources = sorted(s for own, s in groups if own == lang)
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(whole)
        for a in sources:
            pair = [(-sum((p[a][t] - p[b][t]) ** 2 // p[b][t] for t in kept), b.encode()) for b in sources if b != a]
            own = [(-((p[a][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[lang, a][t] and p[a][t] > q[t]]
            for part, values in (("pair", pair), ("term", own)):
                for i, (v, item) in enumerate(sorted(values)[: top if part == "term" else None]):
                    out.add((lang, a, part, item.decode(), -v, i + 1))
    return out


def _rows(n=300, seed=1):
    rng = random.Random(seed)
    vocab = [f"{c}{d}" for c in "abcdeäé漢" for d in "xyzuvw"] + ["Dog", "dOG", "I'm", "x9y", "É"]
    rows = [(0, None, None, None), (1, "", "en", "empty"), (2, "123 456 \n", "en", ""), (3, "lonely", "xx", "one")]
    rows += [(4, "word " * 50_000 + "other", "en", "s1"), (5, "a b c", "vo", "s1"), (6, "a d", "vo", "s2")]
    for i in range(7, n):
        source = rng.choice(["s0"] * 6 + [f"s{k}" for k in range(1, 9)] + ["S É"])
        rows.append((i, " ".join(rng.choices(vocab, k=rng.randrange(40))), rng.choice(["en", "de", None]), source))
    return rows + rows[7:20] + [(7, "other", "en", "s3"), (None, "other other", "en", "s3")]


def test_matches_plain_counting(spark, documents):
    rows = _rows()
    docs = documents(rows).selectExpr("*", "1 AS place", "2 AS term", "3 AS n", "map('a', 1) AS docs")
    got = divergence.audit(docs).collect()
    assert {tuple(r) for r in got} == plain(rows) and len(got) == len(plain(rows))
    assert divergence.audit(docs.limit(0)).count() == 0


def test_tasks_and_ranks_change_nothing(spark, documents):
    rows = _rows(200, 2)
    s = divergence.Settings(top=5, held=20, task_pairs=50)
    got = divergence.audit(documents(rows), s).collect()
    assert {tuple(r) for r in got} == plain(rows, 5)


def test_tree_pairs_each_node_with_its_ancestors():
    rng = random.Random(4)
    paths = Counter()
    for _ in range(3000):
        places = sorted(rng.sample(range(6), rng.randrange(1, 6)))
        paths[tuple((x, rng.choice([10, 20, 300]), 3 + x) for x in places)] += 1
    want = defaultdict(int)
    f = lambda p, q: (p - q) ** 2 // q
    for path, times in paths.items():
        for i, (b, pb, b0) in enumerate(path):
            for a, p_a, a0 in path[:i]:
                want[a, b] += times * (f(p_a, pb) - f(p_a, b0) - f(a0, pb) + f(a0, b0))
                want[b, a] += times * (f(pb, p_a) - f(pb, a0) - f(b0, p_a) + f(b0, a0))
    tree = divergence.PatternTree()
    tree.BUFFER = 100
    for path in sorted(paths):
        tree.insert(list(path), paths[path])
    tree.finish()
    got = {}
    for a, b, ab, ba in np.array(tree.taken()).T.tolist():
        got[a, b], got[b, a] = ab, ba
    assert got == want


def test_shares_of_many_occurrences_are_exact(spark):
    n, of = 8_999_999_999_999, 9_123_456_789_012_345
    row = spark.createDataFrame([(n, of)], "n bigint, of bigint")
    got = row.select(divergence.share_of(row["n"], row["of"], divergence.Settings()).alias("p")).first()["p"]
    assert got == 1 + 1_000_000_000 * (n + 1) // of
