"""Winnowing, similarity and repeated passages against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lotwise.llm import paragraphs as p


@pytest.mark.parametrize("n", [1, 5, 28, 29, 300])
def test_winnowing_takes_the_least_of_every_window(n):
    h = np.random.default_rng(n).integers(0, 40, n).astype(np.uint64)
    want = {i for j in range(max(1, n - 27)) for i in range(j, min(n, j + 28)) if h[i] == h[j : j + 28].min()}
    assert set(p.winnowed(h, 28).tolist()) == want
    assert len(p.winnowed(h[:0], 28)) == 0


def test_run_hashes_depend_on_the_run_alone():
    h = np.random.default_rng(1).integers(0, 5, 400).astype(np.uint64)
    for width in (1, 2, 5, 24):
        got = p.run_hashes(h, width)
        runs = [tuple(h[i : i + width]) for i in range(400 - width + 1)]
        assert len(set(zip(runs, got.tolist()))) == len(set(runs)) == len(set(got.tolist()))
    assert len(p.run_hashes(h[:4], 5)) == 0


def test_packed_sets_keep_the_lower_bytes():
    x = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 500, np.uint64))
    assert p.unpacked_set(p.packed_set(x)).tolist() == sorted(v & ((1 << 48) - 1) for v in x.tolist())
    assert len(p.unpacked_set(p.packed_set(x[:0]))) == 0


def test_bands_reach_the_recall():
    bands, rows = p.tune_bands(0.8, 0.9995, 64)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9995 and bands * rows <= 64


def test_similar_joins_all_linked_sets():
    rng = np.random.default_rng(2)
    base = [np.unique(rng.integers(0, 10**9, 60)) for _ in range(5)]
    sets = [np.unique(np.where(rng.random(len(b)) < rng.choice([0, 0.05, 0.2]), rng.integers(0, 10**9, len(b)), b)) for b in base * 12]
    a, b = p.similar(sets, (4, 5))
    label = np.arange(len(sets))
    label[a] = b
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            inter = len(np.intersect1d(sets[i], sets[j]))
            if inter * 5 >= 4 * (len(sets[i]) + len(sets[j]) - inter):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    assert label.tolist() == root


def _corpus():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(500)]
    line = lambda k: " ".join(rng.choices(vocab, k=k))
    passage, para = line(51), line(90).split()
    rows = [(0, None, "en", "a"), (1, "", "en", "a"), (2, "short line\nshort line", "en", "a")]
    for i in range(3, 43):
        text = line(120) + "\n" + line(70)
        if i % 4 == 0:  # in the middle of a line
            w = text.split(" ")
            at = rng.randrange(len(w))
            text = " ".join(w[:at] + [passage.upper()] + w[at:])
        if i % 5 == 0:
            near = list(para)
            near[rng.randrange(90)] = "other"
            text += "\n" + " ".join(near)
        rows.append((i, text, "en", "a"))
    return rows + [(100, line(200), "en", "a"), (101, rows[7][1], "en", "a"), (None, rows[8][1], "en", "a")], passage


def test_planted_passages_are_found_and_clean_texts_left(documents):
    rows, passage = _corpus()
    docs = documents(rows)
    found = p.repeats(docs).collect()
    repeated = {r["id"] for r in found}
    planted = {i for i in range(4, 43) if i % 4 == 0} | {7, 101}
    assert planted <= repeated
    assert repeated <= planted | {i for i in range(5, 43) if i % 5 == 0}
    # every class keeps one place
    kept = Counter(r["class_id"] for r in found if r["kept"])
    assert set(kept.values()) == {1} and set(kept) == {r["class_id"] for r in found}
    out = {r["doc_id"]: r["text"] for r in p.without_repeats(docs).collect() if r["doc_id"] is not None}
    assert out[100] == dict((r[0], r[1]) for r in rows)[100] and out[0] is None and out[1] == ""
    assert out[101] == "" or len(out[101].split()) < 10
    assert passage.split()[20].upper() in out[4] and all(len(out[i].split()) < 241 for i in planted if i not in (4, 7))


def test_runs_of_51_words_settle_what_is_repeated(documents):
    """A piece in several contexts, runs of 50 and 51 words, a text that repeats itself."""
    rng = random.Random(9)
    fresh = iter(range(10**6))
    own = lambda k: [f"u{next(fresh)}" for _ in range(k)]
    run, short, loop = own(51), own(50), own(60)
    rows = [(i, own(rng.randrange(90)) + run + own(rng.randrange(90))) for i in range(12)]
    rows += [(20 + i, own(40) + short + own(40)) for i in range(6)]
    # the run once in a part too short to count, once whole; twice whole
    rows += [(30, own(9) + run[:40] + own(30) + run + own(5)), (31, run + own(3) + run), (32, loop * 4), (33, ["ha"] * 500)]
    rows += [(40, own(70)), (41, own(30) + ["ha"] * 51), (42, run[:50] + own(60)), (43, own(20) + run[1:] + own(20))]
    texts = [(i, "\n".join(w), "en", "a") for i, w in rows]
    places = defaultdict(set)
    for i, w in rows:
        for k in range(len(w) - 50):
            places[tuple(w[k : k + 51])].add(i)
    want = set().union(*(ids for ids in places.values() if len(ids) > 1))
    found = p.repeats(documents(texts)).collect()
    assert {r["id"] for r in found} == want and {0, 11, 30, 31, 33, 41} <= want and not want & {20, 32, 40, 42, 43}
    kept = Counter(r["class_id"] for r in found if r["kept"])
    assert set(kept.values()) == {1} and set(kept) == {r["class_id"] for r in found}


def _runs(texts):
    """Places (text, start) of every 51-word window that two of ``texts`` (id, words) have."""
    places = defaultdict(list)
    for k, (_, w) in enumerate(texts):
        for at in range(len(w) - 50):
            places[tuple(w[at : at + 51])].append((k, at))
    return {w: x for w, x in places.items() if len({k for k, _ in x}) > 1}


def _covering(texts):
    """{id: (words of shared runs, those of them outside the kept copies)}."""
    all_words, away, here = defaultdict(set), defaultdict(set), defaultdict(set)
    for found in _runs(texts).values():
        first = min(found, key=lambda x: (texts[x[0]][0], x[1]))
        for k, at in found:
            words = range(at, at + 51)
            all_words[texts[k][0]].update(words)
            (here if (k, at) == first else away)[texts[k][0]].update(words)
    return {i: (len(w), len(away[i] - here[i])) for i, w in all_words.items()}


def _recombined():
    rng = random.Random(12)
    fresh = iter(range(10**6))
    own = lambda k: [f"v{next(fresh)}" for _ in range(k)]
    blocks = [own(rng.randrange(20, 140)) for _ in range(12)]
    texts = []
    for i in range(60):
        words = own(rng.randrange(30))
        for _ in range(rng.randrange(1, 6)):
            b = rng.choice(blocks)
            lo = rng.choice([0, 0, rng.randrange(len(b))])
            words += b[lo : rng.choice([len(b), len(b), rng.randrange(len(b)) + 1])] + own(rng.choice([0, 1, 40]))
        texts.append((i, words))
    run, block = own(51), own(80)
    texts += [(70 + i, own(33) + run + own(41)) for i in range(3)]
    texts += [(80, own(9) + block + own(9) + block), (81, block + block + own(70) + block[5:]), (82, ["so"] * 300), (83, ["so"] * 120)]
    return [*texts, (84, texts[3][1]), (85, [*own(4), *texts[3][1]])]


def test_shared_runs_are_cut_whole_outside_their_kept_copy(documents):
    texts = _recombined()
    docs = documents([(i, "\n".join(w), "en", "a") for i, w in texts])
    got = {r["id"]: (r["repeated_words"], r["removed_words"]) for r in p.by_document(p.repeats(docs)).collect()}
    assert got == _covering(texts)
    assert got[70] == (51, 0) and got[71] == got[72] == (51, 51) and got[80] == (169 - 9, 80)
    left = {r["doc_id"]: r["text"].split() for r in p.without_repeats(docs).collect()}
    assert all(len(w) - len(left[i]) == got.get(i, (0, 0))[1] for i, w in texts)
    stands = {tuple(w[k : k + 51]) for w in left.values() for k in range(len(w) - 50)}
    assert set(_runs(texts)) <= stands


def test_a_line_removed_for_a_near_equal_one_keeps_what_others_copy(documents):
    """Document 2 is document 1 and 52 words more; document 3 has these words as well."""
    rng = random.Random(21)
    fresh = iter(range(10**6))
    own = lambda k: [f"x{next(fresh)}" for _ in range(k)]
    line, more, edited = own(300), own(52), own(200)
    other = [*edited[:100], "edit", *edited[101:]]
    texts = [(1, line), (2, line + more), (3, own(rng.randrange(60)) + more + own(40))]
    texts += [(4, edited), *((i, other) for i in (5, 6, 7))]
    docs = documents([(i, " ".join(w), "en", "a") for i, w in texts])
    got = {r["id"]: r for r in p.by_document(p.repeats(docs)).collect()}
    assert [got[i]["removed_words"] for i in (1, 2, 3, 6, 7)] == [0, 300, 52, 200, 200]
    assert got[3]["kept_ids"] == [2]
    left = [r["text"].split() for r in p.without_repeats(docs).collect()]
    stands = {tuple(w[k : k + 51]) for w in left for k in range(len(w) - 50)}
    assert set(_runs(texts)) <= stands


def test_classes_can_be_rebuilt_from_documents(documents):
    """One passage in documents 1, 2 and 3, another in 2 and 4."""
    own = lambda name, k: " ".join(f"{name}{i}" for i in range(k))
    one, two = own("a", 45) + "\n" + own("b", 40), own("c", 45) + "\n" + own("d", 20)
    rows = [(1, one), (2, one + "\n" + two), (3, own("e", 30) + "\n" + one), (4, two), (5, own("f", 90))]
    members = defaultdict(set)
    for r in p.by_document(p.repeats(documents([(i, t, "en", "a") for i, t in rows]))).collect():
        for x in r["class_ids"]:
            members[x].add(r["id"])
    assert {frozenset(x) for x in members.values()} == {frozenset({1, 2, 3}), frozenset({2, 4})}


def _line_classes(rows):
    lines = [(i, at, w) for i, t, _, _ in rows if i is not None for at, w in _lines(t)]
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) for *_, w in lines]
    root = list(range(len(lines)))
    for x in range(len(lines)):
        for y in range(x):
            n = len(sets[x] & sets[y])
            if n * 5 >= 4 * (len(sets[x]) + len(sets[y]) - n):
                a, b = root[x], root[y]
                root = [min(a, b) if r in (a, b) else r for r in root]
    out = defaultdict(set)
    for (i, at, _), r in zip(lines, root):
        out[r].add((i, at))
    return {frozenset(v) for v in out.values() if len(v) > 1}


def _lines(text):
    at = 0
    for line in (text or "").lower().split("\n"):
        words = line.split()
        if len(words) >= 50:
            yield at, words
        at += len(words)


@pytest.mark.parametrize("block", [4, 1024])
def test_line_classes_match_brute_force(documents, block):
    rows, _ = _corpus()
    got = defaultdict(set)
    for r in p.repeats(documents(rows), p.Settings(block=block)).collect():
        if r["n_words"] >= 50:
            got[r["class_id"]].add((r["id"], r["start"]))
    assert {frozenset(v) for v in got.values()} == _line_classes(rows)


def test_no_documents(documents):
    docs = documents([(1, "x", "en", "a")])
    assert p.repeats(docs.limit(0)).count() == 0 and p.repeats(docs).count() == 0
    assert p.without_repeats(docs).collect() == docs.collect()


def test_rows_that_share_an_id_very_long_texts_and_clashing_columns(documents):
    own = lambda name, k: " ".join(f"{name}{i}" for i in range(k))
    passage = own("p", 60)
    rows = [(1, passage, "en", "a"), (1, own("q", 30) + " " + passage, "en", "a"), (2, own("r", 90), "en", "a")]
    rows += [(3, own("long", 80_000) + "\n" + passage, "en", "a"), (4, None, "en", "a"), (2, own("r", 90), "en", "a")]
    docs = documents(rows).selectExpr("*", "1 AS _cut", "2 AS uid", "3 AS `_Cut`", "map('a', 1) AS m")
    found = {r["id"]: r for r in p.by_document(p.repeats(docs)).collect()}
    assert set(found) == {1, 2, 3} and found[3]["repeated_words"] == 60
    out = p.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    left = [r["text"] for r in out.collect() if r["doc_id"] == 3]
    assert left and len(left[0].split()) == 80_000


def test_one_bucket_of_many_near_lines_costs_rows_in_proportion(spark, documents, monkeypatch):
    """Boilerplate with a changing number: one component, which needs no pair of blocks but the first's."""
    words = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join([*words[:60], f"n{i}", *words[60:]]), "en", "a") for i in range(400)]
    rows += [(900 + i, " ".join(words[:40] + [f"o{i}x{k}" for k in range(40)]), "en", "a") for i in range(30)]
    met = []
    plain = p._verified

    def counted(tasks, texts, s):
        met.append(tasks.count())
        return plain(tasks, texts, s)

    monkeypatch.setattr(p, "_verified", counted)
    found = p.repeats(documents(rows), p.Settings(block=16)).filter("line").collect()
    assert len({r["class_id"] for r in found if r["id"] < 900}) == 1
    assert len({r["id"] for r in found if r["id"] < 900}) == 400
    assert met[1:] == [0] and met[0] <= 2 * 16 * 430
