"""Passages that repeat across documents: paragraph MinHash banding.

Two kinds of paragraphs are taken from every text, as words (A-Z lower-cased, between
ASCII blanks):

* lines of ``least_words`` words or more, compared by their sets of five-word shingles at
  Jaccard similarity 0.8 or more;
* windows of ``least_words + 1`` words that line breaks need not respect. Each belongs to
  one piece of ``piece`` words inside it, the leftmost with the least hash, so equal windows
  belong to equal pieces. A piece found twice is only a candidate: it counts as repeated
  where windows around it are the same in two texts, word by word, and the words of all
  these windows are the passage.

Lines get a MinHash signature whose bands are tuned for recall; lines that share a band's
key are candidates. Buckets with the same members are looked at once. Their shingle sets
then meet in one task, in blocks of bounded size, where similarities are counted exactly
by a matrix product over the shared shingles. A bucket of many members becomes many
blocks, never one task, and members that are in one component already meet no more.
Verified links are reduced to one for each member, and removals are settled by connected
components: the smallest place of a class is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import spare, utf8
from lotwise.llm.components import connected_components
from lotwise.workspace import stored


@dataclass(frozen=True)
class Settings:
    least_words: int = 50
    piece: int = 24
    shingle: int = 5
    threshold: tuple[int, int] = (4, 5)  # similarity as a fraction
    recall: float = 0.9995  # of pairs at the threshold
    hashes: int = 64
    block: int = 1_024  # about the lines that meet in a task


def grown(table: DataFrame) -> DataFrame:
    """A table that grows with the corpus: joined by shuffle at every size, never broadcast."""
    return table.hint("merge")


def tune_bands(similarity: float, recall: float, hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows a band whose bands still reach ``recall``."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - similarity**rows) ** bands >= recall:
            return bands, rows
    return hashes, 1


# ---- paragraphs of one text

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_STEP = 0x9E3779B97F4A7C15  # odd, for running hashes modulo 2^64


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        got = self[word] = xxhash.xxh64_intdigest(word)
        return got


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` words in a row; by doubling, so in few array operations."""
    n = len(words) - width + 1
    if n <= 0:
        return words[:0]
    out, have = None, 0
    power, length = words, 1
    left = width
    while left:
        if left & 1:
            part = power[have : have + n]
            out = part if out is None else out * np.uint64(pow(_STEP, length, 1 << 64)) + part
            have += length
        left >>= 1
        if left:
            power = power[:-length] * np.uint64(pow(_STEP, length, 1 << 64)) + power[length:]
            length *= 2
    return _mixed(out)


def _sliding(x: np.ndarray, width: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) over each ``width`` values in a row."""
    have = 1
    while have < width:
        more = min(have, width - have)
        x = take(x[:-more], x[more:])
        have += more
    return x


def winnowed(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least hash of some ``width`` neighbours."""
    if len(hashes) <= width:
        return np.flatnonzero(hashes == hashes.min()) if len(hashes) else np.zeros(0, np.int64)
    least = _sliding(hashes, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    best = _sliding(np.concatenate((edge, least, edge)), width, np.maximum)
    return np.flatnonzero(best == hashes)


@dataclass
class Pieces:
    """The pieces of one text; windows ``first`` up to ``last`` (exclusive) belong to each.

    ``contexts`` names all words of these windows; ``again`` marks those seen before.
    """

    starts: np.ndarray
    hashes: np.ndarray
    contexts: np.ndarray
    again: np.ndarray
    first: np.ndarray
    last: np.ndarray
    windows: np.ndarray


class Cutter:
    """Takes the paragraphs of texts as arrays."""

    def __init__(self, s: Settings):
        self.s = s
        self.hashes = _Hashes()
        self.bands, self.rows = tune_bands(s.threshold[0] / s.threshold[1], s.recall, s.hashes)
        rng = np.random.default_rng(7)
        self.turns = rng.integers(0, 1 << 63, self.bands * self.rows, np.uint64) * np.uint64(2) + np.uint64(1)

    def pieces(self, words: np.ndarray) -> Pieces:
        """The pieces that windows of ``least_words + 1`` words belong to, every place of each.

        Texts that are no longer than ``least_words`` have no pieces.
        """
        least = self.s.least_words + 1
        windows = run_hashes(words, least)
        every = run_hashes(words, self.s.piece) if len(windows) else words[:0]
        places = np.arange(len(every))
        if len(every):
            places = _sliding(places, least - self.s.piece + 1, lambda i, j: np.where(every[j] < every[i], j, i))
        cuts = np.flatnonzero(np.diff(places, prepend=-1))
        ends = np.append(cuts, len(places))[1:]
        at = places[cuts]
        # neighbouring windows overlap, so the outer two and their distance hold all words
        contexts = _mixed(_mixed(windows[cuts] + np.uint64(_STEP) * (ends - cuts).astype(np.uint64)) + windows[ends - 1])
        again = np.ones(len(cuts), bool)
        again[np.unique(contexts, return_index=True)[1]] = False
        return Pieces(at, every[at], contexts, again, cuts, ends, windows)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """One key for each band; equal rows of different bands have different keys."""
        least = _mixed(shingles[:, None] * self.turns[None, :]).min(axis=0).reshape(self.bands, self.rows)
        return np.array([xxhash.xxh64_intdigest(row.tobytes(), seed=k) for k, row in enumerate(least)], np.uint64)

    def lines(self, text: bytes) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """All word hashes, and (start, end) of the long lines."""
        own, long_ones = [], []
        at = 0
        for line in text.translate(_LOWER).split(b"\n"):
            words = line.split()
            own += words
            if len(words) >= self.s.least_words:
                long_ones.append((at, at + len(words)))
            at += len(words)
        return np.fromiter(map(self.hashes.__getitem__, own), np.uint64, len(own)), long_ones


_UNITS = pa.schema(
    [
        *(("id", pa.int64()), ("line", pa.bool_()), ("start", pa.int32()), ("n_words", pa.int32()), ("uid", pa.int64())),
        *(("context", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("again", pa.bool_()), ("body", pa.int64())),
        *(("bands", pa.list_(pa.int64())), ("shingles", pa.binary())),
    ]
)


def units(docs: DataFrame, s: Settings, id_column: str, text: str) -> DataFrame:
    """(id, line, start, n_words, uid, context, low, high, again, body, bands, shingles): the
    paragraphs of all texts. ``low`` and ``high`` bound the words of a piece's windows,
    counted from its start. ``context`` is that of a piece, zero for a line, ``again`` says
    that the text has it further ahead, ``body`` names the text."""

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(s)
        for batch in stream:
            ids, bodies = batch.column("id").to_pylist(), batch.column("body").to_pylist()
            for lo in range(0, len(ids), 256):
                part = slice(lo, lo + 256)
                yield packed(cutter, ids[part], bodies[part], utf8(batch.column("text").slice(lo, 256)))

    def packed(cutter: Cutter, ids: list, bodies: list, texts) -> pa.RecordBatch:
        out: dict[str, list] = {name: [] for name in _UNITS.names[:10]}
        bands, shingles = [], []

        def add(doc, line, whole, starts, lengths, uids, contexts, lows, highs, again):
            n = len(uids)
            out["id"] += [doc] * n
            out["line"] += [line] * n
            out["body"] += [whole] * n
            out["context"].append(contexts)
            out["low"].append(lows)
            out["high"].append(highs)
            out["again"].append(again)
            out["start"].append(starts)
            out["n_words"].append(lengths)
            out["uid"].append(uids)

        for doc, whole, text in zip(ids, bodies, texts):
            words, long_ones = cutter.lines(text or b"")
            p = cutter.pieces(words)
            at, n = p.starts, len(p.starts)
            reach = p.first - at, p.last - at + s.least_words
            add(doc, False, whole, at, np.full(n, s.piece), p.hashes, p.contexts, *reach, p.again)
            bands += [None] * n
            shingles += [None] * n
            every = run_hashes(words, s.shingle)
            no_context = np.zeros(1, np.uint64), np.zeros(1, int), np.zeros(1, int), np.zeros(1, bool)
            for a, b in long_ones:
                own = np.unique(every[a : b - s.shingle + 1])
                uid = np.array([xxhash.xxh64_intdigest(words[a:b].tobytes())], np.uint64)
                add(doc, True, whole, np.array([a]), np.array([b - a]), uid, *no_context)
                bands.append(cutter.signature(own).view(np.int64))
                shingles.append(packed_set(own))
        arrays = ("start", "n_words", "uid", "context", "low", "high", "again")
        joined = {k: np.concatenate(out[k]) if out[k] else np.zeros(0, np.uint64) for k in arrays}
        hashed = [joined[k].astype(np.uint64).view(np.int64) for k in ("uid", "context")]
        plain = [joined["low"], joined["high"], joined["again"].astype(bool), out["body"]]
        columns = [out["id"], out["line"], joined["start"], joined["n_words"], *hashed, *plain]
        columns = [pa.array(v, f.type) for v, f in zip([*columns, bands, shingles], _UNITS)]
        return pa.RecordBatch.from_arrays(columns, schema=_UNITS)

    kinds = "id bigint, line boolean, start int, n_words int, uid bigint, context bigint, low int, high int, again boolean, body bigint, bands array<bigint>, shingles binary"
    body = F.col(f"`{text}`")
    narrow = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), body.alias("text"), F.xxhash64(body).alias("body"))
    return narrow.mapInArrow(cut, kinds)


# ---- links between lines


def similar(sets: list[np.ndarray], threshold: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b), one for each member, that join all sets linked at the threshold."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    shared = np.bincount(code) > 1
    keep = shared[code]
    owner, code = owner[keep], np.cumsum(shared)[code[keep]] - 1
    both = np.zeros((n, n), np.float32)
    width = 8_192
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, (low, low + width))
        part = np.zeros((n, width if b - a > width else max(1, int(code[b - 1]) - low + 1)), np.float32)
        part[owner[a:b], code[a:b] - low] = 1
        both += part @ part.T
    inter = both.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - inter
    a, b = np.nonzero(np.triu(inter * threshold[1] >= union * threshold[0], 1))
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    member = np.flatnonzero(label != np.arange(n))
    return member, label[member]


_PACKED = 6  # bytes kept of a shingle's hash: two of a pair of lines collide once in 10^10 pairs


def packed_set(shingles: np.ndarray) -> bytes:
    """The hashes of a line's shingles, cut to their lower bytes."""
    return shingles.view(np.uint8).reshape(-1, 8)[:, :_PACKED].tobytes()


def unpacked_set(data: bytes) -> np.ndarray:
    """The distinct hashes of :func:`packed_set`."""
    out = np.zeros((len(data) // _PACKED, 8), np.uint8)
    out[:, :_PACKED] = np.frombuffer(data, np.uint8).reshape(-1, _PACKED)
    return np.unique(out.view(np.int64).ravel())


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _verified(tasks: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(a, b): links between uids that meet in a task; ``tasks`` is (task, uid), ``texts`` (uid, shingles)."""
    keyed = tasks.join(grown(texts), "uid").select("task", "uid", "shingles")

    def verify(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, uids, held = None, [], []

        def found() -> pa.RecordBatch:
            names = np.array(uids, np.int64)
            a, b = similar(held, s.threshold)
            return pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(names[b])], schema=_LINK)

        for batch in stream:
            keys = batch.column("task").to_pylist()
            names = batch.column("uid").to_pylist()
            sets = batch.column("shingles").to_pylist()
            for k, key in enumerate(keys):
                if key != task:
                    if len(uids) > 1 and len(out := found()):
                        yield out
                    task, uids, held = key, [], []
                uids.append(names[k])
                held.append(unpacked_set(sets[k]))
        if len(uids) > 1 and len(out := found()):
            yield out

    together = keyed.repartition("task").sortWithinPartitions("task")
    return stored(together.mapInArrow(verify, "a bigint, b bigint"), "line_links")


def line_links(lines: DataFrame, s: Settings) -> DataFrame:
    """(a, b): verified links between uids of lines that are similar but not equal.

    They have the components of all pairs that share a key and are similar. A bucket of one
    block is one task. In a larger one every block meets itself and the first block; what
    that joins needs no pair between its members any more. So only members outside the
    bucket's largest component meet all blocks: many copies of one line with a few
    changes cost rows in proportion to their number.
    """
    c = F.col
    banded = lines.select("uid", F.explode("bands").alias("key"))
    met = banded.groupBy("key").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi"))
    met = stored(met.filter("lo < hi").select("key"), "colliding")
    members = stored(banded.join(grown(met), "key").distinct(), "members")
    # one bucket of those with the same members
    sets = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("uid")).alias("x"),
        F.bit_xor(F.xxhash64("uid", F.lit(1))).alias("y"),
        F.min("uid").alias("lo"),
    )
    chosen = sets.groupBy("n", "x", "y", "lo").agg(F.min("key").alias("key"))
    # two blocks meet in a task
    chosen = chosen.select("key", F.ceil(c("n") * 2 / s.block).cast("int").alias("blocks"))
    rows = stored(members.join(grown(stored(chosen, "buckets")), "key"), "bucket_rows")
    wanted = stored(members.select("uid").distinct(), "wanted")
    texts = lines.select("uid", "shingles").join(grown(wanted), "uid", "left_semi")
    texts = stored(texts.groupBy("uid").agg(F.min("shingles").alias("shingles")), "line_shingles")

    own = F.pmod(F.xxhash64("uid", F.lit(2)), c("blocks")).cast("int")
    small = rows.filter("blocks <= 2").select(c("key").alias("task"), "uid")
    large = rows.filter("blocks > 2").withColumn("own", own)
    # the first block goes to every other one, which meets itself there as well
    others = F.when(c("own") == 0, F.sequence(F.lit(1), c("blocks") - 1)).otherwise(F.array("own"))
    first = large.select("key", "uid", F.explode(others).alias("j")).select(F.xxhash64("key", "j").alias("task"), "uid")
    links = _verified(small.unionByName(first), texts, s)
    large = stored(large, "large_buckets")
    if large.isEmpty():
        return links

    label = stored(connected_components(links), "first_components").select(c("node").alias("uid"), "component")
    placed = large.join(grown(label), "uid", "left").withColumn("component", F.coalesce("component", "uid"))
    placed = stored(placed, "placed_members")
    sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("m"), F.sum("n").alias("all"))
    main = main.select("key", c("m.component").alias("main"), (c("all") - c("m.n")).alias("rest"))
    met = placed.join(grown(stored(main.filter("rest > 0"), "main_components")), "key")
    parts = F.ceil(c("rest") * 2 / s.block).cast("int")
    part = F.pmod(F.xxhash64("uid", F.lit(3)), parts).cast("int")
    # (part of the rest, block of all): a member of the rest meets every block, all meet every part
    as_rest = met.filter("component <> main").select(
        "key", "uid", part.alias("i"), F.explode(F.sequence(F.lit(0), c("blocks") - 1)).alias("j")
    )
    as_any = met.select("key", "uid", F.explode(F.sequence(F.lit(0), parts - 1)).alias("i"), c("own").alias("j"))
    tasks = as_rest.unionByName(as_any).distinct().select(F.xxhash64("key", "i", "j").alias("task"), "uid")
    return links.unionByName(_verified(tasks, texts, s))


# ---- repeats


_WINDOW = pa.schema([("context", pa.int64()), ("shift", pa.int32()), ("window", pa.int64())])


def _windows(docs: DataFrame, spots: DataFrame, s: Settings, id_column: str, text: str) -> DataFrame:
    """(context, shift, window): the windows of the pieces in ``spots`` (id, contexts);
    ``shift`` is where a window starts, counted from its piece."""

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(s)
        for batch in stream:
            for body, asked in zip(utf8(batch.column("text")), batch.column("contexts")):
                words, _ = cutter.lines(body or b"")
                p = cutter.pieces(words)
                chosen = np.isin(p.contexts.view(np.int64), asked.values.to_numpy(zero_copy_only=False)) & ~p.again
                if chosen.any():
                    n = p.last - p.first
                    mine = np.repeat(chosen, n)  # windows come in the order of their pieces
                    names = np.repeat(p.contexts[chosen].view(np.int64), n[chosen])
                    shift = np.flatnonzero(mine) - np.repeat(p.starts[chosen], n[chosen])
                    columns = [pa.array(names), pa.array(shift, pa.int32()), pa.array(p.windows[mine].view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, schema=_WINDOW)

    narrow = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    kinds = "context bigint, shift int, window bigint"
    return narrow.join(spots, "id").select("text", "contexts").mapInArrow(cut, kinds)


def shared_pieces(docs: DataFrame, pieces: DataFrame, s: Settings, id_column: str, text: str) -> DataFrame:
    """(id, start, body, class_id, first, low, high, own): each piece in windows that two texts share.

    A window's copy at the smallest place stays; windows that stay with one context are a
    class, named by it, and ``first`` is where it stands. ``low`` and ``high`` bound the
    words of the piece's windows in that class, from its start. ``own`` says that the class is
    named by the piece's context. All windows of a context hold its piece, so their words have
    no gaps.

    A context found in two texts is shared as it stands if its piece has no other. Where a
    piece has several, one text for each context is asked for its windows.
    """
    c = F.col
    texts = F.count_if(~c("again"))
    twice = pieces.groupBy("uid").agg(texts.alias("n")).filter("n > 1").select("uid")
    place = F.struct("id", "start", "body")
    several = pieces.join(grown(stored(twice, "repeated_pieces")), "uid")
    several = stored(several.select("uid", "context", "again", "id", "start", "body", "low", "high"), "several")
    contexts = several.groupBy("uid", "context").agg(texts.alias("n"), F.min(place).alias("place"))
    contexts = stored(contexts, "contexts")

    open_uids = contexts.groupBy("uid").agg(
        F.count(F.lit(1)).alias("m"),
        F.max("n").alias("most"),
        F.min("place.body").alias("lo"),
        F.max("place.body").alias("hi"),
    )
    open_uids = grown(stored(open_uids.filter("m > 1 AND (lo < hi OR most > 1)").select("uid"), "open_pieces"))
    asked = stored(contexts.join(open_uids, "uid").select("context", "n", "place"), "open_contexts")
    spots = asked.groupBy("place.id").agg(F.collect_set("context").alias("contexts"))
    windows = stored(_windows(docs, stored(spots, "spots"), s, id_column, text), "windows")
    known = asked.select("context", "n", "place.*")
    met = windows.select("context", "window").join(grown(stored(known, "known_contexts")), "context")
    met = met.groupBy("window").agg(
        F.min("body").alias("lo"),
        F.max("body").alias("hi"),
        F.max("n").alias("most"),
        F.min(F.struct("id", "start", "body", "context")).alias("first"),
    )
    met = met.filter("lo < hi OR most > 1").select("window", c("first.context").alias("class_id"))
    settled = windows.join(grown(stored(met, "shared_windows")), "window")
    settled = settled.groupBy("context", "class_id").agg(
        F.min("shift").alias("low"), (F.max("shift") + s.least_words + 1).alias("high")
    )
    stands = asked.select(c("context").alias("class_id"), c("place").alias("first"))
    settled = settled.join(grown(stored(stands, "first_places")), "class_id")

    nothing = F.lit(None).cast("int")
    whole = contexts.join(open_uids, "uid", "left_anti").filter("n > 1")
    whole = whole.select("context", c("context").alias("class_id"), c("place").alias("first"))
    whole = whole.select("*", nothing.alias("low"), nothing.alias("high"))
    shared = grown(stored(settled.select(whole.columns).unionByName(whole), "shared_places"))
    places = several.select("id", "start", "body", "context", c("low").alias("_low"), c("high").alias("_high"))
    return places.join(shared, "context").withColumns(
        {"low": F.coalesce("low", "_low"), "high": F.coalesce("high", "_high"), "own": c("context") == c("class_id")}
    )


def repeats(docs: DataFrame, s: Settings = Settings(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, body, line, start, n_words, run_start, run_words, class_id, kept_id, kept): each
    paragraph of a repeated class. ``body`` is the hash of the text it stands in.

    A line is its own run. A piece's run are the words around it that texts share in windows
    of ``least_words + 1`` words; a piece has a row for each class its windows belong to.
    ``start`` and ``run_start`` count words of the text from 0. Of a class the paragraph at
    the smallest (id, start) is ``kept``, and ``kept_id`` is its document. Null, empty and
    shorter texts have no paragraphs; rows without an id are not compared. A passage that
    recurs within one text alone is not repeated. Rows that share an id are texts of their
    own; wholly repeated rows are copies of each other, and as nothing tells them apart, what
    is kept in one is kept in all. No documents give an empty table.
    """
    c = F.col
    docs = docs.filter(c(f"`{id_column}`").isNotNull())
    every = stored(units(docs, s, id_column, text), "units")
    pieces = every.filter("NOT line").drop("bands", "shingles")
    lines = every.filter("line")
    place = F.min(F.struct("id", "start", "body")).alias("first")
    n = F.count(F.lit(1)).alias("n")

    found = shared_pieces(docs, pieces, s, id_column, text)
    found = found.withColumns({"line": F.lit(False), "n_words": F.lit(s.piece)})

    groups = stored(lines.groupBy("uid").agg(n, place), "line_groups")
    classes = connected_components(line_links(lines, s)).select(c("node").alias("uid"), "component")
    labelled = groups.join(classes, "uid", "left").withColumn("class_id", F.coalesce("component", "uid"))
    labelled = stored(labelled.select("uid", "n", "first", "class_id"), "labelled")
    whole = labelled.groupBy("class_id").agg(F.sum("n").alias("n"), F.min("first").alias("first")).filter("n > 1")
    mapped = labelled.select("uid", "class_id").join(whole.select("class_id", "first"), "class_id")
    alike = lines.select("id", "body", "line", "start", "n_words", "uid").join(grown(stored(mapped, "repeated_lines")), "uid")
    alike = alike.withColumns({"low": F.lit(0), "high": c("n_words"), "own": F.lit(True)})

    names = ["id", "body", "line", "start", "n_words", "low", "high", "class_id", "first", "own"]
    both = found.select(names).unionByName(alike.select(names))
    here = c("own") & (c("first") == F.struct("id", "start", "body"))
    run = [(c("start") + c("low")).alias("run_start"), (c("high") - c("low")).alias("run_words")]
    return both.select(*names[:5], *run, "class_id", c("first.id").alias("kept_id"), here.alias("kept"))


_CUTS = "repeated_words bigint, removed_words bigint, removed array<struct<start: int, end: int>>"


def _cuts(runs: pa.Array) -> pa.Array:
    """What runs (start, end, kept) of each document cover, and what of it goes."""
    repeated, removed, sizes, spans = [], [], [], []
    for own in runs:
        flat = own.values
        low, high, kept = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("start", "end", "kept"))
        edges, at = np.unique(np.concatenate((low, high)), return_inverse=True)
        a, b = at[: len(low)], at[len(low) :]
        n = len(edges)

        def inside(which: np.ndarray) -> np.ndarray:
            return (np.bincount(a[which], minlength=n) - np.bincount(b[which], minlength=n)).cumsum()[:-1] > 0

        width = np.diff(edges)
        gone = inside(~kept) & ~inside(kept)
        turns = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
        repeated.append(int(width[inside(np.ones(len(low), bool))].sum()))
        removed.append(int(width[gone].sum()))
        sizes.append(len(turns) // 2)
        spans.append(edges[turns].reshape(-1, 2))
    both = np.concatenate(spans) if spans else np.zeros((0, 2))
    kind = pa.int32()
    pairs = pa.StructArray.from_arrays([pa.array(both[:, k], kind) for k in (0, 1)], ["start", "end"])
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), kind), pairs)
    columns = [pa.array(repeated, pa.int64()), pa.array(removed, pa.int64()), lists]
    return pa.StructArray.from_arrays(columns, ["repeated_words", "removed_words", "removed"])


def by_text(found: DataFrame) -> DataFrame:
    """(id, body, repeated_words, removed_words, kept_ids, class_ids, removed): one row for each
    text with repeats. ``removed`` lists the spans to cut, ``kept_ids`` where their words
    stay, ``class_ids`` all classes the text is in, with a kept copy or another.
    No word of a run of windows that stays here is cut, whatever else it belongs to."""
    c = F.col
    run = F.struct(
        c("run_start").alias("start"),
        (c("run_start") + c("run_words")).alias("end"),
        (c("kept") & ~c("line")).alias("kept"),
    )
    goes = F.when(~c("kept"), c("kept_id"))
    listed = found.groupBy("id", "body").agg(
        F.collect_set(run).alias("runs"),
        F.array_sort(F.collect_set(goes)).alias("kept_ids"),
        F.array_sort(F.collect_set("class_id")).alias("class_ids"),
    )
    found = listed.select("id", "body", "kept_ids", "class_ids", F.arrow_udf(_cuts, _CUTS)("runs").alias("cuts"))
    return found.select("id", "body", "cuts.repeated_words", "cuts.removed_words", "kept_ids", "class_ids", "cuts.removed")


def by_document(found: DataFrame) -> DataFrame:
    """(id, repeated_words, removed_words, kept_ids, class_ids): one row for each id with
    repeats; of texts that share an id the words are added up."""
    together = by_text(found).groupBy("id").agg(
        F.sum("repeated_words").alias("repeated_words"),
        F.sum("removed_words").alias("removed_words"),
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(x)))).alias(x) for x in ("kept_ids", "class_ids")],
    )
    return together


def without_repeats(docs: DataFrame, s: Settings = Settings(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every repeated passage but the kept one cut out of ``text``.

    Words between are joined as they stood; texts without repeats are unchanged.
    """
    side = spare(docs, "_cut")
    cuts = by_text(repeats(docs, s, id_column, text)).filter("removed_words > 0")
    cuts = cuts.select(F.struct("id", "body", "removed").alias(side))

    @F.arrow_udf("string")
    def cut(texts: pa.Array, notes: pa.Array) -> pa.Array:
        import re

        word = re.compile(rb"[^\x20\x09-\x0D]+")
        out = []
        for value, note in zip(utf8(texts), notes):
            spans = note["removed"].as_py() if note.is_valid else None
            if value is None or not spans:
                out.append(value)
                continue
            at = [m.span() for m in word.finditer(value)]
            kept, last = [], 0
            for x in spans:
                low, high = at[x["start"]][0], at[x["end"] - 1][1]
                kept.append(value[last : max(last, low)])
                last = max(last, high)
            out.append(b"".join([*kept, value[last:]]))
        return pa.array([None if v is None else v.decode() for v in out], pa.string())

    here = (docs[f"`{id_column}`"] == cuts[side]["id"]) & (F.xxhash64(docs[f"`{text}`"]) == cuts[side]["body"])
    met = docs.join(cuts, here, "left")
    return met.withColumn(text, cut(F.col(f"`{text}`"), F.col(side))).drop(side)
