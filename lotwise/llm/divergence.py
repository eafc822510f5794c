"""How far the sources of a language are apart in their terms, in exact whole numbers.

The terms of every (language, source) group are counted, those in few documents of the
language dropped, and the smoothed shares p of the rest compared: of each pair of sources
``(p - q) ** 2 / q`` summed over all kept terms, and of each source the terms it has more of
than its language.

A term that neither of two sources has adds the same to their sum as any other such term,
one that a single source has adds what depends on its count there alone. So the dense sum is
a product, the terms of one source are a histogram of their counts, and only terms that both
have need a correction. For these each term's row of nonzero counts, ordered by source, is a
path into a frequent-pattern tree; equal rows go in once with their number. A node that many
terms pass through is paired with each of its ancestors once, times the number of terms.
Rows are dealt out to tasks by ranges of paths and sorted, so a task meets its part of the
tree in depth-first order and holds one branch of it at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lotwise.llm.common import batches, utf8
from lotwise.workspace import stored, stored_lookup

# everything that is no ASCII letter and no byte of a longer code point is a blank
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 32 for b in range(256)
)
_COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


@dataclass(frozen=True)
class Settings:
    least_docs: int = 3  # documents of the language a kept term is in
    scale: int = 1_000_000_000  # a share of 1
    top: int = 200  # ranks reported of a source's own terms
    held: int = 300_000  # counts a task holds before it passes them on
    task_pairs: int = 500_000  # node and ancestor pairs a task of the tree is meant to meet


def term_counts(docs: DataFrame, s: Settings, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs), summed up as far as a task's memory goes."""
    blank = F.lit("")
    narrow = docs.select(
        *[F.coalesce(F.col(f"`{x}`").cast("string"), blank).alias(y) for x, y in ((lang, "lang"), (source, "source"), (text, "text"))]
    )
    held = s.held

    def rows(found: dict) -> Iterator[tuple]:
        for (group_lang, group_source), (n, in_docs) in found.items():
            for term, count in n.items():
                yield group_lang, group_source, term.decode(), count, in_docs[term]

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for batch in stream:
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for group, value in zip(groups, utf8(batch.column("text"))):
                terms = (value or b"").translate(_LETTERS).split()
                n, in_docs = found.setdefault(group, (Counter(), Counter()))
                size -= len(n)
                n.update(terms)
                in_docs.update(set(terms))
                size += len(n)
                if size >= held:
                    yield from batches(rows(found), _COUNTS)
                    found, size = {}, 0
        yield from batches(rows(found), _COUNTS)

    return narrow.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")


def share_of(n: Column | int, of: Column, s: Settings) -> Column:
    """1 + floor(scale * (n + 1) / of), exact for any count."""
    wide = (F.lit(n) if isinstance(n, int) else n).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
    product = wide * F.lit(s.scale).cast("decimal(10,0)")
    return F.call_function("div", product, of.cast("decimal(19,0)")).cast("bigint") + 1


def excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class PatternTree:
    """The frequent-pattern tree of one language, met path by path in their order.

    A path is a list of (place, p, base): the source's place, its share of the terms on the
    path and its share of terms it does not have. ``insert`` closes the nodes that no later
    path can share; each closed node is paired with its ancestors, times its multiplicity.
    """

    BUFFER = 1 << 20  # pairs held before they are added up
    MOST = 1 << 19  # sums held before they are passed on

    def __init__(self):
        self.branch: list[tuple[int, int, int]] = []
        self.passing: list[int] = []
        self.ancestors: list[np.ndarray] = []
        self.nodes: list[tuple] = []
        self.lengths: list[int] = []
        self.waiting = 0
        self.sums = np.zeros((3, 0), np.int64)

    def insert(self, path: list[tuple[int, int, int]], times: int) -> None:
        """``path`` may not come before an earlier one."""
        shared = 0
        for own, new in zip(self.branch, path):
            if own != new:
                break
            shared += 1
        self._close(shared)
        self.branch.extend(path[shared:])
        self.passing.extend([0] * (len(path) - shared))
        if path:
            self.passing[-1] += times

    def _close(self, depth: int) -> None:
        if len(self.branch) > max(depth, 1):
            line = np.array(self.branch, np.int64).T
        while len(self.branch) > depth:
            node, times = self.branch.pop(), self.passing.pop()
            if self.branch:
                self.passing[-1] += times
                self.ancestors.append(line[:, : len(self.branch)])
                self.nodes.append((*node, times))
                self.lengths.append(len(self.branch))
                self.waiting += len(self.branch)
                if self.waiting >= self.BUFFER:
                    self._add_up()

    def _add_up(self) -> None:
        if not self.nodes:
            return
        a, pa_, a0 = np.concatenate(self.ancestors, axis=1)
        b, pb, b0, times = np.repeat(np.array(self.nodes, np.int64).T, self.lengths, axis=1)
        none_ab, none_ba = _excess(a0, b0), _excess(b0, a0)
        ab = times * (_excess(pa_, pb) - _excess(pa_, b0) - _excess(a0, pb) + none_ab)
        ba = times * (_excess(pb, pa_) - _excess(pb, a0) - _excess(b0, pa_) + none_ba)
        keys = np.concatenate([self.sums[0], (a << 31) | b])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        values = [np.add.reduceat(np.concatenate([old, new])[order], first) for old, new in ((self.sums[1], ab), (self.sums[2], ba))]
        self.sums = np.stack([keys[first], *values])
        self.ancestors, self.nodes, self.lengths, self.waiting = [], [], [], 0

    def full(self) -> bool:
        return self.sums.shape[1] >= self.MOST

    def taken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(a, b, value of a against b, of b against a) of the closed nodes, then forgotten."""
        self._add_up()
        keys, ab, ba = self.sums
        self.sums = np.zeros((3, 0), np.int64)
        return keys >> 31, keys & ((1 << 31) - 1), ab, ba

    def finish(self) -> None:
        self._close(0)


_PAIRS = "lang string, a bigint, b bigint, ab bigint, ba bigint"


def _tree(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), *((x, pa.int64()) for x in ("a", "b", "ab", "ba"))])

    def batch_of(lang: str, tree: PatternTree) -> pa.RecordBatch:
        columns = tree.taken()
        names = pa.array([lang] * len(columns[0]), pa.string())
        return pa.RecordBatch.from_arrays([names, *(pa.array(c, pa.int64()) for c in columns)], schema=schema)

    lang, tree = None, PatternTree()
    for batch in stream:
        paths = batch.column("path")
        items = paths.flatten()
        flat = list(zip(*(items.field(i).to_pylist() for i in range(3))))
        ends = np.cumsum(paths.value_lengths().to_numpy(zero_copy_only=False)).tolist()
        low = 0
        for own, times, high in zip(batch.column("lang").to_pylist(), batch.column("times").to_pylist(), ends):
            if own != lang:
                if lang is not None:
                    tree.finish()
                    yield batch_of(lang, tree)
                lang, tree = own, PatternTree()
            tree.insert(flat[low:high], times)
            low = high
            if tree.full():
                yield batch_of(lang, tree)
    if lang is not None:
        tree.finish()
        yield batch_of(lang, tree)


def _with_shares(terms: DataFrame, langs: DataFrame, s: Settings) -> DataFrame:
    """Paths of (place, p, base) instead of counts."""
    def item(x: Column) -> Column:
        of = F.get("sizes", x["place"]) + F.col("kept")
        return F.struct(x["place"].alias("place"), share_of(x["n"], of, s).alias("p"), share_of(0, of, s).alias("base"))

    return terms.join(langs, "lang").select("lang", "term", "n", F.transform("path", item).alias("path"))


def _pair_sums(groups: DataFrame, paths: DataFrame, pairs: int, s: Settings) -> DataFrame:
    """(lang, a, b, value): the summed excess of each source over each other one."""
    c = F.col
    wide = "decimal(38,0)"
    left = groups.select("lang", c("place").alias("a"), c("base").alias("a0"), "kept")
    right = groups.select("lang", c("place").alias("b"), c("base").alias("b0"))
    # every pair of sources of a language is a row of the result
    met = left.join(right, "lang").filter("a <> b")
    dense = met.select("lang", "a", "b", (excess(c("a0"), c("b0")).cast(wide) * c("kept")).alias("value"))

    counts = paths.select("lang", F.explode("path").alias("x"), "times")
    counts = counts.groupBy("lang", c("x.place").alias("a"), c("x.p").alias("p"), c("x.base").alias("a0"))
    counts = counts.agg(F.sum("times").alias("times"))
    met = counts.join(right, "lang").filter("a <> b")
    own = excess(c("p"), c("b0")) - excess(c("a0"), c("b0"))
    other = excess(c("b0"), c("p")) - excess(c("b0"), c("a0"))
    alone = met.groupBy("lang", "a", "b").agg(
        F.sum(own.cast(wide) * c("times")).alias("ab"), F.sum(other.cast(wide) * c("times")).alias("ba")
    )

    shared = paths.filter(F.size("path") > 1)
    tasks = pairs // s.task_pairs + 1
    shared = shared.repartitionByRange(tasks, "lang", "path").sortWithinPartitions("lang", "path")
    both = shared.mapInArrow(_tree, _PAIRS)

    def turned(df: DataFrame) -> DataFrame:
        ways = F.array(
            F.struct(c("a").cast("bigint").alias("a"), c("b").cast("bigint").alias("b"), c("ab").cast(wide).alias("value")),
            F.struct(c("b").cast("bigint").alias("a"), c("a").cast("bigint").alias("b"), c("ba").cast(wide).alias("value")),
        )
        return df.select("lang", F.inline(ways))

    dense = dense.select("lang", c("a").cast("bigint").alias("a"), c("b").cast("bigint").alias("b"), c("value").cast(wide).alias("value"))
    everything = dense.unionByName(turned(alone)).unionByName(turned(both))
    return everything.groupBy("lang", "a", "b").agg(F.sum("value").cast("bigint").alias("value"))


def audit(
    docs: DataFrame,
    s: Settings = Settings(),
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank) of all groups.

    Part ``pair``: item is each other source of the language. Part ``term``: item is each of
    the ``top`` kept terms of which the source has most beyond its language. Null text,
    language and source are read as ''. A group without terms has pairs and no terms; a
    language without kept terms has pairs of value 0; a language of one source has none.
    Repeated rows count as often as they stand there. An empty table has no rows.
    """
    c = F.col
    blank = F.lit("")
    names = docs.select(
        *[F.coalesce(c(f"`{x}`").cast("string"), blank).alias(y) for x, y in ((lang, "lang"), (source, "source"))]
    )
    by_lang = Window.partitionBy("lang").orderBy("source")
    places = stored_lookup(
        names.distinct().select("*", (F.row_number().over(by_lang) - 1).alias("place")), "source_places"
    )
    counts = term_counts(docs, s, text, lang, source).join(places, ["lang", "source"])
    # one shuffle: sums by (lang, term, place) and then by (lang, term) stay where they are
    dealt = counts.select("lang", "term", "place", "n", "docs").repartition("lang", "term")
    summed = dealt.groupBy("lang", "term", "place").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = summed.groupBy("lang", "term").agg(
        F.sort_array(F.collect_list(F.struct("place", "n"))).alias("path"),
        F.sum("n").alias("n"),
        F.sum("docs").alias("docs"),
    )
    terms = stored(terms.filter(c("docs") >= s.least_docs).drop("docs"), "kept_terms")

    own = terms.select("lang", F.explode("path").alias("x")).groupBy("lang", c("x.place").alias("place"))
    own = own.agg(F.sum("x.n").alias("size"))
    totals = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("total"))
    zero = F.lit(0).cast("bigint")
    sizes = places.join(own, ["lang", "place"], "left").join(totals, "lang", "left")
    of = c("size") + c("kept")
    groups = sizes.select(
        *("lang", "source", "place"),
        *[F.coalesce(x, zero).alias(x) for x in ("size", "kept", "total")],
    ).withColumn("base", F.when(of > 0, share_of(0, of, s)).otherwise(1))
    groups = stored_lookup(groups, "source_sizes")
    langs = groups.groupBy("lang").agg(
        F.first("kept").alias("kept"),
        F.first("total").alias("total"),
        F.transform(F.array_sort(F.collect_list(F.struct("place", "size"))), lambda x: x["size"]).alias("sizes"),
    )
    langs = stored_lookup(langs, "langs")

    shares = _with_shares(terms, langs, s)
    seen = Observation()
    deep = F.size("path").cast("bigint")
    paths = shares.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
    paths = stored(paths.observe(seen, F.coalesce(F.sum(deep * (deep - 1) / 2), F.lit(0.0)).alias("pairs")), "paths")
    sums = _pair_sums(groups, paths, int(seen.get["pairs"]), s)
    label = groups.select("lang", c("place").cast("bigint").alias("a"), "source")
    other = groups.select("lang", c("place").cast("bigint").alias("b"), c("source").alias("item"))
    pairs = sums.join(label, ["lang", "a"]).join(other, ["lang", "b"])
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))

    every = share_of(c("n"), c("total") + c("kept"), s)
    met = shares.join(langs.select("lang", "kept", "total"), "lang")
    met = met.select("lang", "term", every.alias("q"), F.explode("path").alias("x"))
    met = met.filter(c("x.p") > c("q")).select(
        "lang", c("x.place").alias("place"), c("term").alias("item"), excess(c("x.p"), c("q")).alias("value")
    )
    by_place = Window.partitionBy("lang", "place").orderBy(F.desc("value"), "item")
    best = met.withColumn("rank", F.row_number().over(by_place)).filter(c("rank") <= s.top)
    best = best.join(groups.select("lang", "place", "source"), ["lang", "place"])
    return pairs.unionByName(best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
