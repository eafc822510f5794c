"""Language identification by words first, shorter and shorter character runs after.

A word the model knows scores its log frequency in each language. An unseen word is read
as character runs, its start and end marked: at each place the longest known run counts,
from ``longest`` characters down to one. A text's score in a language is the mean over
its words, so long and short texts compare.

The model is learned from a bounded sample of labelled texts, at most ``texts`` for each
language, and keeps the ``words`` and ``runs`` most frequent of each language. It is
sent to the tasks, which predict whole texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import batches, share, spare
from lotwise.workspace import measured

UNKNOWN = "und"


def _class(fits: Callable[[str], bool], end: int = 0x110000) -> str:
    """The inside of a character class of all code points whose general category ``fits``."""
    met = np.fromiter((fits(unicodedata.category(chr(i))) for i in range(end)), bool, end)
    edges = np.flatnonzero(np.diff(np.concatenate(([False], met, [False])).astype(np.int8)))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2]))


@lru_cache
def _word() -> re.Pattern:
    """Letters and the marks that belong to them, at least one letter."""
    letter, mark = _class(lambda k: k[0] == "L"), _class(lambda k: k[0] == "M")
    return re.compile(f"[{mark}]*[{letter}][{letter}{mark}]*")


@lru_cache
def _rare() -> re.Pattern:
    """Marks, number characters that are no digits, and everything beyond the basic plane."""
    inside = _class(lambda k: k[0] == "M" or k in ("Nl", "No"), 0x10000)
    return re.compile(f"[{inside}\U00010000-\U0010ffff]")


# the same words where no such character occurs, and several times as fast
_PLAIN_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    texts: int = 5_000  # most texts of a language learned from
    words: int = 50_000  # most words of a language kept
    runs: int = 50_000  # most character runs of a language kept
    longest: int = 4
    evidence: float = 20.0  # words at most that sharpen a score


@dataclass(frozen=True)
class Model:
    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    runs: dict[str, int]
    run_scores: np.ndarray
    floor: np.ndarray  # a character that no language knows
    longest: int
    evidence: float


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and combining marks; other number characters are none."""
    if not text:
        return []
    lower = text.lower()
    plain = lower.isascii() or not _rare().search(lower)
    return (_PLAIN_WORD if plain else _word()).findall(lower)


def runs_of(word: str, longest: int) -> Iterator[str]:
    marked = f" {word} "
    for n in range(1, longest + 1):
        for at in range(len(marked) - n + 1):
            yield marked[at : at + n]


def counts(docs: DataFrame, s: Settings, text: str, lang: str) -> DataFrame:
    """(lang, kind, item, n): words and character runs of all rows of ``docs``."""
    longest = s.longest

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("kind", pa.string()), ("item", pa.string()), ("n", pa.int64())])
        for batch in stream:
            seen: dict[str, Counter] = {}
            for language, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                seen.setdefault(language, Counter()).update(words_of(value))
            yield from batches(
                (
                    (language, kind, item, n)
                    for language, found in seen.items()
                    for kind, counted in (("word", found), ("run", _runs(found, longest)))
                    for item, n in counted.items()
                ),
                schema,
            )

    narrow = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    found = narrow.mapInArrow(count, "lang string, kind string, item string, n bigint")
    return found.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


def _runs(words: Counter, longest: int) -> Counter:
    out: Counter = Counter()
    for word, n in words.items():
        for run in runs_of(word, longest):
            out[run] += n
    return out


def sample(docs: DataFrame, s: Settings, id_column: str, lang: str) -> DataFrame:
    """About ``Settings.texts`` rows of each language at most, chosen by a hash of the id."""
    language, size, name = F.col(f"`{lang}`"), spare(docs, "_size"), spare(docs, "_lang")
    known = docs.filter(language.isNotNull())
    # one row a language, and languages are names
    sizes = measured(known.groupBy(language.alias(name)).agg(F.count(F.lit(1)).alias(size)))
    part = F.least(F.lit(1.0), F.lit(float(s.texts)) / F.col(size))
    met = known.join(sizes, language == F.col(name))
    met = met.filter(F.coalesce(share(F.col(f"`{id_column}`"), 3), F.lit(0.0)) < part)
    return met.select(*[known[f"`{x}`"] for x in docs.columns])


def train(
    docs: DataFrame, s: Settings = Settings(), id_column: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Model:
    """Learn from the rows of ``docs`` that have a language. No such row: every prediction
    is ``und``. Equal frequencies are cut in code point order."""
    best = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item")
    most = F.when(F.col("kind") == "word", s.words).otherwise(s.runs)
    found = counts(sample(docs, s, id_column, lang), s, text, lang)
    kept = found.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= most)
    # ``words + runs`` rows a language at most: the model is as large as that, wherever it lives
    rows = kept.select("lang", "kind", "item", "n").toArrow().to_pylist()
    languages = sorted({r["lang"] for r in rows})
    column = {name: i for i, name in enumerate(languages)}

    def tabled(kind: str) -> tuple[dict[str, int], np.ndarray]:
        places: dict[str, int] = {}
        own = sorted((r["item"], r["lang"], r["n"]) for r in rows if r["kind"] == kind)
        for item, _, _ in own:
            places.setdefault(item, len(places))
        table = np.full((len(places), max(1, len(languages))), 0.5)
        for item, language, n in own:
            table[places[item], column[language]] += n
        return places, np.log(table) - np.log(table.sum(axis=0) + 1.0)

    words, word_scores = tabled("word")
    runs, run_scores = tabled("run")
    floor = (run_scores.min(axis=0) if len(run_scores) else np.zeros(max(1, len(languages)))) - 1.0
    return Model(languages, words, word_scores, runs, run_scores, floor, s.longest, s.evidence)


class Reader:
    """Scores texts under a model; remembers unseen words it has read."""

    def __init__(self, model: tuple):
        (self.languages, self.words, self.word_scores, self.runs, self.run_scores, self.floor, self.longest, self.evidence) = model
        self.unseen: dict[str, np.ndarray] = {}

    def backoff(self, word: str) -> np.ndarray:
        """Mean over the places of a word of its longest known run."""
        got = self.unseen.get(word)
        if got is None:
            marked = f" {word} "
            total = np.zeros(len(self.floor))
            for at in range(len(marked)):
                for n in range(min(self.longest, len(marked) - at), 0, -1):
                    row = self.runs.get(marked[at : at + n])
                    if row is not None:
                        total += self.run_scores[row]
                        break
                else:
                    total += self.floor
            got = total / len(marked)
            if len(self.unseen) > 100_000:
                self.unseen.clear()
            self.unseen[word] = got
        return got

    def __call__(self, text: str | None) -> tuple[str, float]:
        found = Counter(words_of(text))
        if not found or not self.languages:
            return UNKNOWN, 0.0
        known, weight = [], []
        total = np.zeros(len(self.floor))
        for word, n in found.items():
            row = self.words.get(word)
            if row is None:
                total += n * self.backoff(word)
            else:
                known.append(row)
                weight.append(n)
        if known:
            total += np.array(weight, float) @ self.word_scores[known]
        n_words = sum(found.values())
        odds = total / n_words * min(n_words, self.evidence)
        best = int(odds.argmax())
        return self.languages[best], 1.0 / float(np.exp(np.clip(odds - odds[best], -700, 0)).sum())


def predict(spark, text: Column, model: Model) -> Column:
    """struct(lang, score) of whole texts; ``und`` and 0 for null or without any letter.

    Equal texts, repeated rows among them, get the same. Languages that score alike are
    settled in code point order."""
    sent = spark.sparkContext.broadcast(tuple(vars(model).values()))
    kept: list[Reader] = []

    @F.arrow_udf("struct<lang:string,score:double>")
    def identify(column: pa.Array) -> pa.Array:
        if not kept:
            kept.append(Reader(sent.value))
        read = [kept[0](t) for t in column.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([r[0] for r in read], pa.string()), pa.array([r[1] for r in read], pa.float64())],
            names=["lang", "score"],
        )

    return identify(text)
