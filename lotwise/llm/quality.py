"""Quality rules with column functions alone.

Base rules count words, symbols, repeated lines and repeated five-word windows of a whole
text. The verdict on the rest is a hashed n-gram log-likelihood ratio: words and
pairs of neighbouring words fall into ``buckets`` hashed classes, whose frequencies are
counted in a trusted target and in the whole corpus. A document's mean log ratio says
how much more likely it is under the target; the threshold is fixed, so equal texts are
always judged alike.

The corpus is counted over all texts, with map-side combine to at most ``buckets`` rows
a task. The ratios, one array of that fixed length, enter the second scan as a scalar.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import share, spare

BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    smoothing: float = 1.0  # pseudo-count of each bucket in target and corpus
    trusted: int = 100_000  # most trusted ids that are looked up: bounds what is broadcast
    threshold: float = -0.1  # least mean log ratio of a kept document, in nats an n-gram
    least_words: int = 10
    repeats: int = 20  # most per cent of words in repeated windows


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Runs without ASCII blanks; no words for null."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+"))


def _with_next(items: Column, after: int) -> Column:
    """Hash of each item with the one ``after`` places on."""
    n = F.greatest(F.size(items) - after, F.lit(0))
    return F.zip_with(
        F.slice(items, F.lit(1), n), F.slice(items, F.lit(1 + after), n), lambda a, b: F.xxhash64(a, b)
    )


def pairs(word_list: Column) -> Column:
    """Hashes of neighbouring words."""
    return let(word_list, lambda w: _with_next(w, 1))


def singles(word_list: Column) -> Column:
    return F.transform(word_list, lambda w: F.xxhash64(w))


def windows(pair_list: Column) -> Column:
    """Hashes of five words in a row, from the hashes of pairs."""
    return let(let(pair_list, lambda p: _with_next(p, 1)), lambda t: _with_next(t, 2))


def covered(window_list: Column, width: int = 5) -> Column:
    """Words that stand in a window found twice or more."""

    def of_repeated(w: Column) -> Column:
        ordered = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            same = F.filter(
                s,
                lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)),
            )
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        return F.aggregate(
            let(ordered, repeated),
            F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
            lambda a, i: F.struct(
                (i + width).alias("end"), (a["n"] + i + width - F.greatest(i, a["end"])).alias("n")
            ),
            lambda a: a["n"],
        )

    return let(
        window_list,
        lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), of_repeated(w)).otherwise(0),
    ).cast("bigint")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[#*$%&|<>]")).cast("bigint")


def log_ratios(docs: DataFrame, trusted: DataFrame, s: Settings, id_column: str, text: str) -> DataFrame:
    """One row, one array: the log ratio of each bucket, target against corpus.

    ``trusted`` has one column of ids. At most about ``Settings.trusted`` of them, chosen
    by a hash, stand for the target. Without any, all ratios are alike.
    """
    c = F.col
    ids = trusted.select(c(f"`{trusted.columns[0]}`").alias("id")).filter("id IS NOT NULL").distinct()
    part = min(1.0, s.trusted / max(1, ids.count()))
    ids = ids.filter(share(c("id"), 4) < F.lit(part)).withColumn("target", F.lit(1))
    met = docs.select(c(f"`{id_column}`").alias("id"), c(f"`{text}`").alias("text"))
    met = met.join(F.broadcast(ids), "id", "left")  # bounded by Settings.trusted
    bucket = F.explode(let(words(c("text")), lambda w: F.concat(singles(w), pairs(w)))).alias("h")
    counts = met.select("target", bucket).groupBy(F.pmod("h", F.lit(s.buckets)).alias("bucket"))
    counts = counts.agg(F.count(F.lit(1)).alias("raw"), F.count("target").alias("own"))
    full = counts.unionByName(
        docs.sparkSession.range(s.buckets).select(c("id").alias("bucket"), F.lit(0).alias("raw"), F.lit(0).alias("own"))
    )
    full = full.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("own").alias("own"))
    listed = full.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "raw", "own"))).alias("b"),
        F.sum("raw").alias("all_raw"),
        F.sum("own").alias("all_own"),
    )
    a = s.smoothing

    def log_share(n: Column, of: Column) -> Column:
        return F.log((n + a) / (of + a * s.buckets))

    ratio = F.transform("b", lambda x: log_share(x["own"], c("all_own")) - log_share(x["raw"], c("all_raw")))
    return listed.select(ratio.alias("ratios"))


def judged(
    docs: DataFrame,
    trusted: DataFrame,
    s: Settings = Settings(),
    id_column: str = "doc_id",
    text: str = "text",
    name: str = "quality",
) -> DataFrame:
    """``docs`` and a column ``name``: struct(n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, log_ratio, base_failed, kept).

    Null and blank texts have no words and fail the base rules. A text
    without words has a ratio of 0. Repeated rows are judged alike.
    """
    c = F.col
    name, ratios = spare(docs, name), spare(docs, "_ratios")
    body = c(f"`{text}`")

    def of_pairs(w: Column, p: Column) -> Column:
        def ratio(h: Column) -> Column:
            return F.get(c(ratios), F.pmod(h, F.lit(s.buckets)).cast("int"))

        summed = F.aggregate(p, F.lit(0.0), lambda n, h: n + ratio(h))
        summed = F.aggregate(w, summed, lambda n, x: n + ratio(F.xxhash64(x)))
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            symbols(body).alias("n_symbols"),
            repeated_lines(body).alias("n_dup_lines"),
            covered(windows(p)).alias("n_repeat_words"),
            (summed / F.greatest(F.size(p) + F.size(w), F.lit(1))).alias("log_ratio"),
        )

    def verdict(n: Column) -> Column:
        failed = (n["n_words"] < s.least_words) | (n["n_repeat_words"] * 100 > n["n_words"] * s.repeats)
        own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_ratio"]
        kept = ~failed & (n["log_ratio"] >= s.threshold)
        return F.struct(*[n[x].alias(x) for x in own], failed.alias("base_failed"), kept.alias("kept"))

    counted = let(words(body), lambda w: let(pairs(w), lambda p: let(of_pairs(w, p), verdict)))
    # a subquery may not stand inside the functions on arrays, a column of it may
    with_ratios = docs.withColumn(ratios, log_ratios(docs, trusted, s, id_column, text).scalar())
    return with_ratios.withColumn(name, counted).drop(ratios)
