"""Windows of test items in documents, against plain search."""

import random
import re

import pytest

from lotwise.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items, window=13):
    w = words(text)
    hit, names = set(), set()
    for name, t in items:
        v = words(t)
        k = min(window, len(v))
        grams = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                names.add("" if name is None else str(name))
    return len(w), len(hit), sorted(names)


def _case(seed, alphabet):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(alphabet)]
    make = lambda k: " ".join(rng.choices(vocab, k=k))
    items = [(i, make(rng.choice([0, 1, 3, 12, 13, 14, 40]))) for i in range(12)] + [(3, make(20)), (None, None), (50, "")]
    rows = [(0, None, "en", "a"), (1, "", "en", "a"), (2, "?? !!", "en", "a")]
    for i in range(3, 40):
        parts = [make(rng.randrange(30)) for _ in range(3)]
        parts.insert(1, rng.choice(items)[1] or "")
        rows.append((i, rng.choice([", ", "\n"]).join(parts).replace("w1 ", "W1; "), "en", "a"))
    return items, rows + [rows[5], (None, rows[6][1], "en", "a")]


@pytest.mark.parametrize("seed, alphabet, block", [(1, 3, 10**6), (2, 400, 10**6), (3, 5, 60), (4, 400, 60)])
def test_matches_plain_search(spark, documents, seed, alphabet, block):
    items, rows = _case(seed, alphabet)
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, found int")
    got = d.contamination(documents(rows), table, block_words=block).collect()
    assert len(got) == len(rows)
    for r in got:
        n, hit, names = plain(r["text"], items)
        f = r["found"]
        assert f["n_words"] == n and sum(s["end"] - s["start"] for s in f["spans"]) == hit
        assert sorted(f["items"]) == names
    clean = d.remove_contaminated(documents(rows), table, block_words=block)
    assert clean.columns == documents(rows).columns
    bad = sum(1 for _, t, _, _ in rows if (p := plain(t, items))[1] and 20 * p[1] >= p[0])
    assert clean.count() == len(rows) - bad


def test_spans_are_cut_out(spark, documents):
    item = " ".join(f"t{i}" for i in range(20))
    docs = documents([(1, f"before it, {item.upper()} and after", "en", "a"), (2, None, "en", "a")])
    table = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    cut = {r["doc_id"]: r["text"] for r in d.remove_spans(docs, table).collect()}
    assert cut == {1: "before it,  and after", 2: None}


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = documents([(1, "some words", "en", "a")])
    assert d.remove_contaminated(docs, none).count() == 1
    assert d.contamination(docs.limit(0), none).count() == 0


def test_the_rest_of_a_cut_item_is_no_short_item():
    words = [b"w%d" % i for i in range(45)]
    for window, block in ((13, 10), (13, 40), (5, 20)):
        pieces = d.pieces_of(words, block, window)
        starts = [tuple(p[k : k + window]) for p in pieces for k in range(len(p) - window + 1)]
        assert min(map(len, pieces)) >= window and len(starts) == len(set(starts)) == 45 - window + 1


def test_blocks_are_built_by_tasks_and_hold_every_item(spark):
    import pickle

    items, _ = _case(2, 400)
    table = spark.createDataFrame(items + [(None, None), (7, "")], "item_id bigint, text string")
    blocks = d.automata(table, "item_id", "text", 60, 13).collect()
    assert len(blocks) > 3
    held = set()
    for r in blocks:
        *_, whole, short, _, _ = pickle.loads(bytes(r["automaton"]))
        held |= {n for names in whole.values() for n in names} | {n for _, names in short.values() for n in names}
    assert held == {str(i) for i, t in items if t and d.normal_words(t.encode())}


def test_a_very_long_document_and_clashing_columns(spark, documents):
    item = " ".join(f"t{i}" for i in range(20))
    text = "filler words " * 60_000 + item + " more" * 10
    docs = documents([(1, text, "en", "a"), (1, text, "en", "a")]).selectExpr("*", "1 AS found", "map('a', 1) AS m")
    table = spark.createDataFrame([(1, item), (1, "other " + item)], "item_id bigint, text string")
    got = d.contamination(docs, table, block_words=15).collect()
    assert len(got) == 2 and {tuple(r["found_"]["items"]) for r in got} == {("1",)}
    assert all(sum(s["end"] - s["start"] for s in r["found_"]["spans"]) == 20 for r in got)
