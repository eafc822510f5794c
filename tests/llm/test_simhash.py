"""SimHash fingerprints, links and survivors against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from lotwise.llm import simhash
from lotwise.llm.components import connected_components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def linked_by_distance(ids_and_fps, distance=4):
    pairs = [(i, i) for i, _ in ids_and_fps if i is not None]
    for i, a in ids_and_fps:
        for j, b in ids_and_fps:
            if i is not None and j is not None and i < j and (a ^ b).bit_count() <= distance:
                pairs.append((i, j))
    return plain_components(pairs)


TEXTS = ["", None, "  \n\t", "One", "one two", "A b c d", "É é À words here " * 9, "x " * 5000, "ö" * 3000]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint_of(text.encode() if text else None) == plain_fingerprint(text)


def _rows(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, t, "en", "a") for i, t in enumerate(TEXTS)]
    base = [" ".join(rng.choices(words, k=200)) for _ in range(6)]
    for i in range(len(rows), n):
        text = rng.choice(base).split()
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text), "en", "a"))
    return rows


def test_components_match_brute_force(documents):
    rows = _rows(3, 150)
    got = {r["id"]: (r["fp"] % (1 << 64), r["component"]) for r in simhash.near_duplicates(documents(rows)).collect()}
    fps = [(i, plain_fingerprint(t)) for i, t, _, _ in rows]
    root = linked_by_distance(fps)
    assert got == {i: (fp, root[i]) for i, fp in fps}
    assert max(list(root.values()).count(x) for x in set(root.values())) > 10


def test_parts_with_many_fingerprints_are_dealt_again(spark, monkeypatch):
    # a ball of neighbours around one number shares its leading bits
    rng = random.Random(5)
    fps = {0}
    while len(fps) < 300:
        fps.add(rng.choice(list(fps)) ^ (1 << rng.randrange(30)))
    fps |= {rng.getrandbits(63) for _ in range(200)}
    monkeypatch.setattr(simhash, "PART_MOST", 40)
    table = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    links = [(r["a"], r["b"]) for r in simhash.ball_links(table).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 16 for a, b in links)
    want = linked_by_distance([(x, x) for x in fps])
    got = plain_components(links)
    assert {x: got.get(x, x) for x in fps} == want


def test_keep_one_keeps_the_smallest_id_and_single_rows(documents, spark):
    rows = _rows(4, 80)
    rows += [rows[20], rows[20], (None, rows[30][1], "en", "a"), (None, "alone with no id at all", "en", "b")]
    docs = documents(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect() if r["doc_id"] is not None))
    root = linked_by_distance([(i, plain_fingerprint(t)) for i, t, _, _ in rows])
    assert ids == sorted(set(root.values()))
    assert kept.filter("doc_id IS NULL").count() == 1
    empty = docs.limit(0)
    assert simhash.keep_one(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0


def test_components_of_chains_hubs_and_loops(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 201), (201, 200)]
    df = spark.createDataFrame(pairs + [(None, 3)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    want = plain_components([p for p in pairs if p[0] != p[1]])
    assert got == want
    assert connected_components(df.limit(0)).count() == 0


def test_leading_bits_grow_with_the_fingerprints():
    assert simhash.leading_bits(10, 2) == 12
    assert simhash.leading_bits(10**9, 2) > simhash.leading_bits(10**6, 2)
    assert np.bitwise_count(np.uint64(2**64 - 1)) == 64


def test_keep_one_bears_map_columns(documents):
    text = " ".join(f"w{i}" for i in range(60))
    docs = documents([(1, text, "en", "a"), (2, text, "en", "a"), (1, text, "en", "a"), (3, "other words here " * 9, "en", "a")])
    docs = docs.selectExpr("*", "map('k', doc_id) AS m")
    kept = simhash.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3] and kept.columns == docs.columns
