"""Base rules and the log-likelihood ratio against plain counting."""

import math
import random
import re
from collections import Counter

import pytest

from lotwise.llm import quality


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def _rows():
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(60)] + ["é#", "<b>", " x"]
    rows = [(0, None, "en", "a"), (1, "", "en", "a"), (2, " \n\t ", "en", "a"), (3, "one", "en", "a")]
    rows += [(4, "a b c d e f " * 4000, "en", "a"), (5, "x\ny\nx\n x\n\nx", "en", "a")]
    for i in range(6, 60):
        body = rng.choices(vocab, k=rng.randrange(80))
        rows.append((i, rng.choice([" ", "\n", " \r\n", "\x0b"]).join(body + body[: rng.randrange(12)]), "en", "a"))
    return rows + [rows[10], (None, rows[11][1], "en", "a")]


def test_counts_match_plain_counting(spark, documents):
    rows = _rows()
    trusted = spark.createDataFrame([(i,) for i in range(6, 30)] + [(None,), (6,)], "doc_id bigint")
    s = quality.Settings()
    got = quality.judged(documents(rows), trusted, s).collect()
    assert len(got) == len(rows)
    for r in got:
        q, want = r["quality"], plain(r["text"])
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == want
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert q["base_failed"] == failed
        assert q["kept"] == (not failed and q["log_ratio"] >= s.threshold)


def test_ratio_matches_multinomials(spark, documents):
    rows = _rows()[3:40]
    own_ids = set(range(6, 30))
    trusted = spark.createDataFrame([(i,) for i in own_ids], "doc_id bigint")
    # so many buckets that distinct n-grams keep apart
    s = quality.Settings(buckets=1 << 20)
    got = quality.judged(documents(rows), trusted, s).collect()
    grams = {i: (w := re.findall(r"[^\x20\x09-\x0D]+", t or "")) + list(zip(w, w[1:])) for i, t, _, _ in rows}
    raw, own = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in own_ids:
            own.update(g)
    for r in got:
        g = grams[r["doc_id"]]
        value = sum(
            math.log((own[x] + 1) / (sum(own.values()) + s.buckets)) - math.log((raw[x] + 1) / (sum(raw.values()) + s.buckets))
            for x in g
        )
        # few pairs of a thousand n-grams share one of a million buckets
        assert r["quality"]["log_ratio"] == pytest.approx(value / max(1, len(g)), abs=0.02)


def test_no_python_and_empty_tables(spark, documents):
    docs = documents(_rows()[:8])
    none = spark.createDataFrame([], "doc_id bigint")
    out = quality.judged(docs, none)
    plan = out._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert out.count() == 8 and quality.judged(docs.limit(0), none).count() == 0
