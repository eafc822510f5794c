"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at up to four differing bits have a common variant at most two flips
from each. Every distinct fingerprint therefore stands for all its variants within two
flips, and fingerprints that meet in a variant are linked.

The 2,081 variants of a fingerprint are dealt out by their leading ``prefix`` bits: a
fingerprint travels once to each leading part it can reach (1 + p + p(p-1)/2 rows, not
2,081), and the task that owns a leading part spells the variants out there, sorts them
and looks for equal neighbours. Which pairs meet does not depend on the number of leading
bits; that number only follows from how many fingerprints there are, so that a part
holds a few thousand. Parts with more are dealt out again by further bits.

Within a part, members of one variant are linked as a chain, each pair verified, and
chains reduced to one link per member; so a group of thousands of copies never becomes
all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import distinct_rows, plain, spare, utf8
from lotwise.llm.components import connected_components
from lotwise.workspace import stored, stored_counted

BITS = 64
PART_ROWS = 2_048  # fingerprints aimed at in a leading part
PART_MOST = 4_096  # beyond this a part is dealt out again


# ---- fingerprints

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint_of(text: bytes | None, width: int = 4, seed: int = 42) -> int:
    """The fingerprint of one text as an unsigned number; zero for a text without words."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(b" ".join(words), seed)
    lines = map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter((digest(s, seed) for s in lines), np.uint64, len(words) - width + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprint(text: Column, width: int = 4, seed: int = 42) -> Column:
    """SimHash of the space-separated, A-Z lower-cased words' shingles, as a signed bigint.

    Null, empty and blank texts give zero, texts of fewer words than ``width`` the hash
    of all their words. A bit set in exactly half of the shingles is zero.
    """

    @F.arrow_udf("bigint")
    def simhash(column: pa.Array) -> pa.Array:
        found = [fingerprint_of(t, width, seed) for t in utf8(column)]
        return pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())

    return simhash(text)


# ---- links


def _flips(bits: int, low: int, most: int) -> list[tuple[int, int]]:
    """(mask, flips) of all ways to flip up to ``most`` of ``bits`` bits from bit ``low`` up."""
    return [
        (sum(1 << (low + i) for i in chosen), n)
        for n in range(most + 1)
        for chosen in combinations(range(bits), n)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def leading_bits(fingerprints: int, radius: int) -> int:
    """Fewest leading bits whose parts hold about ``PART_ROWS`` fingerprints each."""
    for p in range(12, 33):
        reach = sum(len(list(combinations(range(p), n))) for n in range(radius + 1))
        if fingerprints * reach <= PART_ROWS << p:
            break
    return p


def _dealt(rows: DataFrame, done: int, bits: int, radius: int) -> DataFrame:
    """Rows (fp, part, left) dealt out by ``bits`` more leading bits after ``done`` ones.

    ``part`` is the variant's leading bits, zero below; ``left`` the flips still free.
    """
    low = BITS - done - bits
    masks = F.array(
        *[F.struct(F.lit(_signed(m)).alias("m"), F.lit(n).alias("n")) for m, n in _flips(bits, low, radius)]
    )
    new = _signed(((1 << bits) - 1) << low)
    c = F.col
    return (
        rows.select("fp", "part", "left", F.explode(masks).alias("f"))
        .filter(c("f.n") <= c("left"))
        .select(
            "fp",
            c("part").bitwiseOR(c("fp").bitwiseAND(F.lit(new)).bitwiseXOR(c("f.m"))).alias("part"),
            (c("left") - c("f.n")).cast("tinyint").alias("left"),
        )
    )


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index for each of ``n`` nodes under links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            return label


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


class PartLinks:
    """Links within one leading part: spell out, sort, meet, verify, reduce."""

    def __init__(self, done: int, radius: int):
        self.rest = BITS - done  # bits that are still spelled out
        self.radius = radius
        spelled = _flips(self.rest, 0, radius)
        self.masks = [np.array([m for m, n in spelled if n <= k], np.uint64) for k in range(radius + 1)]
        self.low = np.uint64((1 << self.rest) - 1)

    def __call__(self, fps: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(fps)
        if n < 2:
            return fps[:0], fps[:0]
        tail = fps & self.low
        owner_bits = np.uint64(max(1, (n - 1).bit_length()))
        codes = []
        for k, masks in enumerate(self.masks):
            at = np.flatnonzero(left == k)
            if not len(at):
                continue
            spelled = tail[at, None] ^ masks[None, :]
            codes.append(((spelled << owner_bits) | at[:, None].astype(np.uint64)).ravel())
        code = np.concatenate(codes)
        code.sort()
        variant = code >> owner_bits
        same = np.flatnonzero(variant[1:] == variant[:-1])
        if not len(same):
            return fps[:0], fps[:0]
        owner = np.uint64((1 << int(owner_bits)) - 1)
        a, b = (code[same] & owner).astype(np.int64), (code[same + 1] & owner).astype(np.int64)
        pair = np.unique(np.minimum(a, b) * n + np.maximum(a, b))
        a, b = pair // n, pair % n
        true = _popcount(fps[a] ^ fps[b]) <= 2 * self.radius
        root = _components(n, a[true], b[true])
        member = np.flatnonzero(root != np.arange(n))
        return fps[member], fps[root[member]]


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links(rows: DataFrame, done: int, radius: int, partitions: int) -> DataFrame:
    """Links of all parts; the rows of a part stand together in one task, in order."""

    def find(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        link = PartLinks(done, radius)

        def emit(fps, left):
            a, b = link(fps.view(np.uint64), left)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=_LINK
            )

        key, held = None, []
        for batch in stream:
            part, fps, left = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "fp", "left"))
            cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(part)]):
                if lo == hi:
                    continue
                if part[lo] != key and held:
                    out = emit(*(np.concatenate(x) for x in zip(*held)))
                    held = []
                    if len(out):
                        yield out
                key = part[lo]
                held.append((fps[lo:hi], left[lo:hi]))
        if held:
            out = emit(*(np.concatenate(x) for x in zip(*held)))
            if len(out):
                yield out

    together = rows.repartition(partitions, "part").sortWithinPartitions("part")
    return together.mapInArrow(find, "a bigint, b bigint")


def ball_links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b): verified links that join exactly the fingerprints joined by links of up to
    ``distance`` (an even number) bits, though not every such link is listed.

    ``fps`` has one bigint column of distinct fingerprints.
    """
    radius = distance // 2
    fps, n = stored_counted(fps.select(F.col(f"`{fps.columns[0]}`").alias("fp")), "fingerprints")
    bits = leading_bits(n, radius)
    rows = fps.select("fp", F.lit(0).cast("bigint").alias("part"), F.lit(radius).cast("tinyint").alias("left"))
    rows = _dealt(rows, 0, bits, radius)
    # shuffle partitions by rows to come, about 250,000 in each
    reach = len(_flips(bits, 0, radius))
    at_least = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(at_least, n * reach // 250_000)
    done, found = bits, []
    while True:
        sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        large, many = stored_counted(sizes.filter(F.col("n") > PART_MOST).select("part"), "large_parts")
        if not many or done + 8 > BITS:
            found.append(_links(rows, done, radius, partitions))
            break
        found.append(_links(rows.join(large, "part", "left_anti"), done, radius, partitions))
        rows = stored(_dealt(rows.join(large, "part", "left_semi"), done, 8, radius), "dealt_again")
        done += 8
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", distance: int = 4) -> DataFrame:
    """(id, fingerprint bigint, component): one row per row of ``docs``.

    ``component`` is the smallest id reachable over links of up to ``distance`` bits, null
    only if no reachable row has an id. Equal texts share a fingerprint, texts without
    words that of zero. Repeated rows stay. An empty table gives an empty result.
    """
    c = F.col
    own = docs.select(c(f"`{id_column}`").alias("id"), fingerprint(c(f"`{text}`")).alias("fp"))
    own = stored(own, "simhash")
    groups = stored(own.groupBy("fp").agg(F.min("id").alias("least")), "groups")
    classes = connected_components(ball_links(groups.select("fp"), distance))
    # smallest id of each component of several fingerprints, then of every fingerprint
    linked = classes.join(groups, classes["node"] == groups["fp"])
    smallest = linked.groupBy("component").agg(F.min("least").alias("reached"))
    moved, _ = stored_counted(
        classes.join(smallest, "component").select(c("node").alias("fp"), "reached"), "moved"
    )
    label = groups.join(moved, "fp", "left").select("fp", F.coalesce("reached", "least").alias("component"))
    return own.join(label, "fp").select("id", "fp", "component")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", distance: int = 4) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest id.

    Rows without an id come last in this order; of rows with equal ids the one with the
    smallest hash over all columns stays, of wholly repeated rows one. All columns stay.
    """
    c = F.col
    row, fp = spare(docs, "_row"), spare(docs, "_fp")
    whole = F.xxhash64(*plain(docs))
    own = docs.select(
        c(f"`{id_column}`").alias("id"), whole.alias("row"), fingerprint(c(f"`{text}`")).alias("fp")
    )
    own = stored(own, "simhash")
    rank = F.struct(c("id").isNull().alias("no_id"), c("id").alias("id"), c("row").alias("row"))
    groups = stored(own.groupBy("fp").agg(F.min(rank).alias("best")), "groups")
    classes = stored(connected_components(ball_links(groups.select("fp"), distance)), "classes")
    linked = classes.join(groups, classes["node"] == groups["fp"])
    best = linked.groupBy("component").agg(F.min("best").alias("best"))
    alone = groups.join(classes, groups["fp"] == classes["node"], "left_anti").select("best")
    kept = alone.unionByName(best.select("best")).select(c("best.row").alias(row), c("best.id").alias(fp))
    kept = stored(kept.distinct(), "kept")
    marked = docs.withColumn(row, whole)
    met = marked.join(
        kept, (marked[row] == kept[row]) & marked[f"`{id_column}`"].eqNullSafe(kept[fp]), "left_semi"
    )
    # wholly repeated rows: as good as always none, so only they are compared as a whole
    twice, many = stored_counted(
        own.groupBy("row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(c("row").alias(row)), "twice"
    )
    if not many:
        return met.drop(row)
    single = met.join(twice, row, "left_anti").drop(row)
    return single.unionByName(distinct_rows(met.join(twice, row, "left_semi").drop(row)))
