"""Curve, shards and slots."""

import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest

from lotwise.llm import hilbert


@pytest.mark.parametrize("dims, bits", [(1, 3), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_once_in_unit_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = hilbert.hilbert_index(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def _rows(n):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        text = "x" * int(rng.integers(0, 400)) + str(i % (n // 2))
        rows.append((i, text, ["en", "de", None][i % 3], f"s{i % 7}"))
    rows += [(n, None, None, None), (n + 1, None, "en", "a"), (None, "abc", "en", "a"), rows[3], rows[3]]
    # a third of all rows with one text
    return rows + [(10_000 + i, "same" * 50, "en", "hot") for i in range(n // 2)]


def test_shards_are_even_and_groups_stay_together(documents):
    rows = _rows(1200)
    got = hilbert.placed(documents(rows), count=8, keep={}).collect()
    assert len(got) == len(rows)
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) == set(range(8))
    mean = sum(sizes.values()) / 8
    assert max(abs(x / mean - 1) for x in sizes.values()) < 0.1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # ids of equal texts, but for the group larger than a shard
    text = {i: t for i, t, _, _ in rows}
    where = defaultdict(set)
    for r in got:
        if r["id"] is not None:
            where[text[r["id"]]].add(r["shard"])
    assert [t for t, s in where.items() if len(s) > 1] == ["same" * 50]


def test_sharded_keeps_rows_and_clusters_dimensions(documents):
    rows = [(i, "t" * (i % 50) + str(i), f"l{i % 4}", f"s{i % 16}") for i in range(2000)]
    docs = documents(rows)
    out = hilbert.sharded(docs, count=16)
    assert out.columns == [*docs.columns, "shard"]
    assert out.count() == len(rows) and out.drop("shard").exceptAll(docs).count() == 0
    seen = defaultdict(set)
    for r in out.collect():
        seen[r["source"]].add(r["shard"])
    # a filter on one dimension reads a fraction of the shards
    assert np.mean([len(x) for x in seen.values()]) < 9
    again = {(r["doc_id"], r["shard"]) for r in hilbert.sharded(docs.repartition(3), count=16).collect()}
    assert again == {(r["doc_id"], r["shard"]) for r in out.collect()}


def test_few_and_no_rows(documents):
    docs = documents([(1, None, None, None)])
    (row,) = hilbert.placed(docs).collect()
    assert row["size"] == 8 and row["slot"] == 0
    assert hilbert.placed(docs.limit(0)).count() == 0 and hilbert.sharded(docs.limit(0)).count() == 0
    named = docs.withColumnRenamed("Score", "Shard")
    assert hilbert.sharded(named).columns[-1] == "shard_"


def test_many_short_texts_are_spread_over_pieces(documents, monkeypatch):
    """A third of all rows have no text: few bytes, many rows, one place on the curve."""
    monkeypatch.setattr(hilbert, "RUN_ROWS", 50)
    rng = np.random.default_rng(4)
    rows = [(i, "y" * int(rng.integers(50, 300)) + str(i), "en", f"s{i % 5}") for i in range(800)]
    rows += [(10_000 + i, None, "en", "s1") for i in range(400)]
    docs = documents(rows)
    got = hilbert.placed(docs, count=4).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert len(got) == 1200 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    # equal texts stay in one shard, and in eight parts of it
    assert len({r["shard"] for r in got if r["size"] == 8}) == 1
    narrow, starts, whole = hilbert._settled(docs, hilbert.DIMS, "text", "doc_id", 4, {})
    met = narrow.join(starts, "g")
    at = hilbert._where(whole, 4, met["start"], met["bytes"], met["rows"], met["chance"])
    parts = Counter(tuple(r) for r in met.select(*[at[x].alias(x) for x in ("shard", "piece", "part")]).collect())
    assert max(parts.values()) < 120
    out = hilbert.sharded(docs, count=4)
    assert out.drop("shard").exceptAll(docs).count() == 0 and out.count() == 1200


def test_placement_against_plain_arithmetic(documents):
    """Bytes before a group, in the order of its smallest row's place on the curve."""
    rows = [(i, "z" * (i * 37 % 200) + str(i % 150), ["en", "de"][i % 2], f"s{i % 3}") for i in range(300)]
    docs = documents(rows)
    narrow, _, whole = hilbert._settled(docs, hilbert.DIMS, "text", "doc_id", 4, {})
    groups = defaultdict(list)
    for r in narrow.collect():
        groups[r["g"]].append(r)
    order = sorted(groups.values(), key=lambda g: (min(g, key=lambda r: r["id"])["curve"], g[0]["g"]))
    total, target, want = 0, whole["b"] / 6, {}
    for g in order:
        size = sum(r["size"] for r in g)
        for r in g:
            place = total + size * (r["chance"] if size > target / 4 else 0.5)
            want[r["id"]] = min(int(place / target), 5)
        total += size
    assert {r["id"]: r["shard"] for r in hilbert.placed(docs, count=6).collect()} == want


def test_map_columns(documents):
    docs = documents([(1, "a", "en", "s"), (2, "b", "en", "s"), (2, "b", "en", "s")]).selectExpr(
        "*", "map('k', doc_id) AS m", "array(named_struct('x', map('k', 1))) AS deep"
    )
    assert hilbert.sharded(docs).count() == 3 and hilbert.placed(docs).count() == 3
