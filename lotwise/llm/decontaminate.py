"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. Training tokens stream through it:
each word extends the longest run that some item contains, or falls back along suffix
links. A word is hit where the running length reaches the window, which marks the words
of the window behind it; items shorter than the window count as one window of their own.

Most words cannot take part: a window needs as many words in a row that occur in some
item at all. Such runs are found first, by one array operation per text, and only they
are streamed.

An automaton is held whole by a task, so its size is bounded: items are dealt out to blocks
of about ``block_words`` words, and tasks build one automaton for each block. The driver
passes them on one at a time as bytes. Documents are read once: a batch of them meets the
automata one after the other, of which a task holds one at a time.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import normal_words, spare, utf8
from lotwise.workspace import stored

WINDOW = 13
BLOCK_WORDS = 1_000_000

# ---- the automaton, kept as plain lists so that it can be sent anywhere


class Automaton:
    def __init__(self, window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.whole: dict[int, set[str]] = {}  # states of full windows -> items
        self.short: dict[int, tuple[int, set[str]]] = {}  # states of whole short items
        self.least = window  # words in the shortest window

    def add(self, words: Sequence[int]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _copy(self, at: int, length: int) -> int:
        self.step.append(dict(self.step[at]))
        self.link.append(self.link[at])
        self.length.append(length)
        return len(self.step) - 1

    def _extend(self, last: int, word: int) -> int:
        step, link, length = self.step, self.link, self.length
        known = step[last].get(word)
        if known is not None:  # an earlier item has this run
            if length[known] == length[last] + 1:
                return known
            return self._split(last, word, known)
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            target = step[at][word]
            link[new] = target if length[target] == length[at] + 1 else self._split(at, word, target)
        return new

    def _split(self, at: int, word: int, target: int) -> int:
        """A state of its own for the run that ends in ``word`` after state ``at``."""
        copy = self._copy(target, self.length[at] + 1)
        self.link[target] = copy
        while at >= 0 and self.step[at].get(word) == target:
            self.step[at][word] = copy
            at = self.link[at]
        return copy

    def walk(self, words: Sequence[int]) -> Iterator[tuple[int, int]]:
        """(state, longest matching length) after each word; -1 stands for no item word."""
        step, link, length = self.step, self.link, self.length
        state = run = 0
        for word in words:
            after = step[state].get(word)
            while after is None and state:
                state = link[state]
                run = length[state]
                after = step[state].get(word)
            if after is None:
                state = run = 0
            else:
                state, run = after, run + 1
            yield state, run

    def of_window(self, state: int, run: int) -> int:
        """The state of the last ``window`` words, if as many match."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    @staticmethod
    def build(items: Sequence[tuple[str, list[bytes]]], window: int) -> Automaton:
        """Items without words leave no trace; an item id may come several times."""
        out = Automaton(window)
        coded = []
        for name, words in items:
            if words:
                coded.append((name, [out.vocabulary.setdefault(w, len(out.vocabulary)) for w in words]))
        for _, words in coded:
            out.add(words)
        for name, words in coded:
            if len(words) < window:
                out.least = min(out.least, len(words))
                *_, (state, _) = out.walk(words)
                out.short.setdefault(state, (len(words), set()))[1].add(name)
                continue
            for state, run in out.walk(words):
                if run >= window:
                    out.whole.setdefault(out.of_window(state, run), set()).add(name)
        return out

    def parts(self) -> tuple:
        # nearest state with a short item along the suffix links, itself included
        near = [-1] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            up = near[self.link[state]] if state else -1
            near[state] = state if state in self.short else up
        return self.window, self.vocabulary, self.step, self.link, self.length, self.whole, self.short, self.least, near


def matches(words: list[bytes], parts: tuple) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged half-open spans of hit words, and the items whose windows occur."""
    window, vocabulary, step, link, length, whole, short, least, near = parts
    spans: list[tuple[int, int]] = []
    items: set[str] = set()
    if len(words) < least or not vocabulary:
        return spans, items
    codes = np.fromiter((vocabulary.get(w, -1) for w in words), np.int64, len(words))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], codes >= 0, [0])).astype(np.int8)))
    for start, end in edges.reshape(-1, 2):
        if end - start < least:
            continue
        state = run = 0
        for at, word in enumerate(codes[start:end].tolist(), start):
            after = step[state].get(word)
            while after is None and state:
                state = link[state]
                run = length[state]
                after = step[state].get(word)
            if after is None:
                state = run = 0
                continue
            state, run = after, run + 1
            hit = 0
            if run >= window:
                hit, top = window, state
                while length[link[top]] >= window:
                    top = link[top]
                items |= whole[top]
            small = near[state]
            while small >= 0:
                size, names = short[small]
                if size <= run:
                    hit = max(hit, size)
                    items |= names
                small = near[link[small]] if small else -1
            if hit:
                low = at + 1 - hit
                while spans and spans[-1][1] >= low:
                    low = min(low, spans.pop()[0])
                spans.append((int(low), int(at + 1)))
    return spans, items


# ---- over tables


_ITEM = pa.schema([("id", pa.string()), ("words", pa.binary()), ("n", pa.int64())])
_BLOCK = pa.schema([("block", pa.int64()), ("automaton", pa.binary())])


def pieces_of(words: list[bytes], block_words: int, window: int) -> list[list[bytes]]:
    """An item longer than a block in pieces that overlap by a window less one word; each
    starts with a whole window, so no remainder passes for an item of few words."""
    starts = range(0, max(1, len(words) - window + 1), block_words)
    return [words[at : at + block_words + window - 1] for at in starts]


def _pieces(items: DataFrame, id_column: str, text: str, block_words: int, window: int) -> DataFrame:
    """(id, words, n): the normalised words of each item, blank-separated, in pieces."""

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for name, value in zip(batch.column("id").to_pylist(), utf8(batch.column("text"))):
                for piece in pieces_of(normal_words(value), block_words, window):
                    row = [[name or ""], [b" ".join(piece)], [len(piece)]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _ITEM)], schema=_ITEM)

    rows = items.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(cut, "id string, words binary, n bigint")


def automata(items: DataFrame, id_column: str, text: str, block_words: int, window: int) -> DataFrame:
    """(block, automaton): a pickled automaton for each block of items, stored; built by tasks."""
    pieces = stored(_pieces(items, id_column, text, block_words, window), "items")
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("id", "words"), F.lit(blocks)).alias("block")

    def build(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def packed() -> pa.RecordBatch:
            data = pickle.dumps(Automaton.build(held, window).parts(), pickle.HIGHEST_PROTOCOL)
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([data], pa.binary())], schema=_BLOCK)

        for batch in stream:
            for own, name, words in zip(*(batch.column(x).to_pylist() for x in ("block", "id", "words"))):
                if own != key and held:
                    yield packed()
                    held = []
                key = own
                held.append((name, words.split()))
        if held:
            yield packed()

    # a stated number of tasks: the items weigh little, building an automaton is the work
    dealt = pieces.select(block, "id", "words").repartition(blocks, "block").sortWithinPartitions("block", "id", "words")
    return stored(dealt.mapInArrow(build, "block bigint, automaton binary"), "automata")


_FOUND = "n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"


def _find(text: Column, sent: list) -> Column:
    """What a text's words meet in the automata of all blocks."""
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ("items", pa.list_(pa.string())),
        ]
    )
    held: list = [None, None]  # block and automaton that the task holds

    def automaton(block: int) -> tuple:
        if held[0] != block:
            held[1] = None  # never two at a time
            held[:] = block, pickle.loads(sent[block].value)
            vars(sent[block]).pop("_value", None)  # nor the bytes of those that are not in use
        return held[1]

    @F.arrow_udf(f"struct<{_FOUND.replace(' bigint', ':bigint').replace(' array', ':array')}>")
    def stream(texts: pa.Array) -> pa.Array:
        counts, found = [0] * len(texts), [([], set())] * len(texts)
        for block in range(len(sent)):
            parts = automaton(block)
            for k, value in enumerate(utf8(texts)):
                words = normal_words(value)
                spans, items = matches(words, parts)
                counts[k] = len(words)
                if spans:
                    before, names = found[k]
                    found[k] = (_merged([*spans, *before]) if before else spans), items | names
        if not sent:
            counts = [len(normal_words(value)) for value in utf8(texts)]
        rows = zip(counts, found)
        out = [{"n_words": n, "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(items)} for n, (spans, items) in rows]
        return pa.array(out, kind)

    return stream(text)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    name: str = "found",
) -> DataFrame:
    """``docs`` and a column ``name``: n_words, merged spans of hit words, ids of the items.

    Null and wordless texts have no words and no spans, wordless items no windows. Items
    with one id count as one, a null item id is the empty text. Repeated documents are
    each answered. ``name`` is lengthened if ``docs`` has such a column.
    """
    spark = docs.sparkSession
    blocks = automata(items, item_id, item_text, block_words, window)
    sent = []
    for row in blocks.select("block").orderBy("block").collect():
        data = blocks.filter(F.col("block") == row["block"]).first()["automaton"]  # one block at a time
        sent.append(spark.sparkContext.broadcast(bytes(data)))
    return docs.withColumn(spare(docs, name), _find(F.col(f"`{text}`"), sent))


def hit_words(found: str) -> Column:
    return F.aggregate(
        F.col(f"{found}.spans"), F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]
    )


def contaminated(found: str, per_cent: int = 5) -> Column:
    """At least one hit word, and at least ``per_cent`` of all words hit."""
    hit = hit_words(found)
    return (hit > 0) & (hit * 100 >= F.col(f"{found}.n_words") * per_cent)


def digest_of_items(found: str) -> Column:
    return F.sha2(F.concat_ws(",", F.array_sort(F.col(f"{found}.items"))), 256)


def remove_contaminated(docs: DataFrame, items: DataFrame, per_cent: int = 5, **options) -> DataFrame:
    """``docs`` without the contaminated rows; its columns are unchanged."""
    found = spare(docs, "found")
    marked = contamination(docs, items, name=found, **options)
    return marked.filter(~contaminated(found, per_cent)).select(*[F.col(f"`{x}`") for x in docs.columns])


def remove_spans(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words cut out of ``text``; what stands between words stays."""
    found = spare(docs, "found")
    marked = contamination(docs, items, text=text, name=found, **options)

    @F.arrow_udf("string")
    def cut(texts: pa.Array, notes: pa.Array) -> pa.Array:
        import re

        word = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
        out = []
        for value, note in zip(utf8(texts), notes):
            spans = note["spans"].as_py()
            if value is None or not spans:
                out.append(value)
                continue
            at = [m.span() for m in word.finditer(value)]
            kept, last = [], 0
            for s in spans:
                kept.append(value[last : at[s["start"]][0]])
                last = at[s["end"] - 1][1]
            out.append(b"".join([*kept, value[last:]]))
        return pa.array([None if v is None else v.decode() for v in out], pa.string())

    cleaned = marked.withColumn(text, cut(F.col(f"`{text}`"), F.col(found)))
    return cleaned.select(*[F.col(f"`{x}`") for x in docs.columns])
