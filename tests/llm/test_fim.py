"""Fill-in-middle against plain matching of units, and round trips."""

import hashlib
import random
import re

import pytest

from lotwise.llm import fim


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _texts():
    rng = random.Random(3)
    letters = "abzAZ  \n\té漢😀0<>PSM"
    texts = [None, "", " ", "a", "é", "<P>", "x<M>y", "<P", "<S<S", "漢" * 5000, "a" * 9000, "ab é " * 60_000]
    return texts + ["".join(rng.choices(letters, k=rng.randrange(1, 5000))) for _ in range(80)]


@pytest.mark.parametrize("block", [1, 7, 64, 1024])
def test_every_cut_is_where_units_end(block):
    rng = random.Random(block)
    for text in [t or "" for t in _texts()]:
        tree = fim.BlockTree(text.encode(), block)
        ends = [0]
        for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text):
            ends.append(m.end())
        assert tree.n == len(ends) - 1
        for k in {0, 1, tree.n, *(rng.randrange(tree.n + 1) for _ in range(5))}:
            k = min(k, tree.n)
            at, chars = tree.cut(k)
            assert chars == ends[k] and at == len(text[: ends[k]].encode())


def test_blocks_across_slabs(monkeypatch):
    monkeypatch.setattr(fim.BlockTree, "SLAB", 64)
    text = "abc é漢 " * 200
    tree = fim.BlockTree(text.encode(), 16)
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    for k in range(0, len(units) + 1, 37):
        assert tree.cut(k) == (len("".join(units[:k]).encode()), len("".join(units[:k])))


def test_output_and_round_trip(spark, documents):
    rows = [(i, t, "en", "s") for i, t in enumerate(_texts())]
    rows += [rows[20], (None, "no id here", "en", "s"), (-5, "minus five", None, None)]
    docs = documents(rows).withColumnRenamed("Score", "FIM")
    made = fim.with_middle(docs)
    assert made.columns == [*docs.columns, "fim_"]
    back = made.withColumn("back", fim.restored(made["fim_.output"], made["fim_.form"]))
    got = back.collect()
    assert len(got) == len(rows)
    forms = set()
    for r in got:
        assert tuple(r["fim_"]) == plain(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
        forms.add(r["fim_"]["form"])
    assert forms == {"plain", "psm", "spm"}
    assert fim.with_middle(docs.limit(0)).count() == 0
