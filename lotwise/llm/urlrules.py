"""URL filters by association rules, with column functions alone.

Labelled addresses become sets of tokens (host and its parents, path parts, query keys and
so on). FP-growth mines token combinations together with the label; rules are combinations
that come with one label often enough (support) and reliably enough (confidence). A rule
that a more general one of the same label makes superfluous is dropped. The rest lie in an
inverted index under their rarest token: an address looks up its own tokens only, and of
the rules whose tokens it all has the most reliable one decides.

Stated rules for hosts and paths, where one fits, come before the mined ones.

Rules are mined from all labelled addresses and all their frequent tokens; every address is
judged in the scan that reads it, without a shuffle. The index is one value: the rules that
are needed, none of which covers less than a stated share of the labelled addresses.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import share, spare
from lotwise.llm.quality import let
from lotwise.workspace import measured, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = "tokens array<string>, verdict string, confidence double, support bigint, key string"


@dataclass(frozen=True)
class Settings:
    labelled: int | None = None  # a caller's bound on the addresses that are mined; none: all
    support: float = 0.002  # least share of the mined addresses that a rule covers
    confidence: float = 0.9  # least share of its label among the addresses it covers
    # a caller's bound on the tokens of one address that are combined, the most telling first;
    # none: all of them. Tokens that always come together count as one there
    combined: int | None = None
    buckets: int = 4096  # of the index
    default: str = "allow"  # where no rule fits


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def tokens(url: Column) -> Column:
    """The distinct tokens of an address; none for null and for a text without ``://``.

    Kind and value: scheme, every parent of the host, every part of the path (digits alone
    as 0), the first part, the ending of the last, every query key, whether there is a
    fragment. A host over 253 characters is no name and stays whole. Values over 64
    characters stand as their digest.
    """
    text = F.coalesce(url, F.lit(""))
    parts = F.filter(F.split(path(url), "/"), lambda x: x != "")
    query = F.regexp_extract(text, r"://[^?#]*\?([^#]*)", 1)

    def kind(name: str, values: Column) -> Column:
        short = lambda v: F.when(F.length(v) > 64, F.sha2(v, 256)).otherwise(v)
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(name + " "), short(v)))

    def parents(name: Column) -> Column:
        labels = F.split(name, r"\.")
        ends = let(
            labels,
            lambda x: F.transform(
                F.sequence(F.lit(1), F.size(x)), lambda i: F.array_join(F.slice(x, i, F.size(x) - i + 1), ".")
            ),
        )
        return F.when(F.length(name) > 253, F.array(name)).otherwise(ends)

    def of_parts(p: Column) -> Column:
        plain = F.transform(p, lambda x: F.when(x.rlike("^[0-9]+$"), "0").otherwise(x))
        last = F.coalesce(F.get(p, F.size(p) - 1), F.lit(""))
        first = F.slice(plain, 1, 1)
        ending = F.array(F.regexp_extract(last, r"(\.[A-Za-z0-9]{1,5})$", 1))
        return F.concat(kind("path", plain), kind("first", first), kind("ending", ending))

    every = F.concat(
        kind("scheme", F.array(F.translate(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.-]{0,15})://", 1), UPPER, LOWER))),
        let(host(url), lambda h: kind("host", parents(h))),
        let(parts, of_parts),
        kind("query", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
        kind("fragment", F.array(F.when(F.contains(text, F.lit("#")), "yes").otherwise(""))),
    )
    return F.when(F.contains(text, F.lit("://")), F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def stated(host_value: Column, path_value: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest of ``rules`` (host and path, verdict) that fits, or null.

    A rule fits its host and all subdomains, if the path starts with the rule's. Of rules of
    one length the first in code point order wins. The list becomes part of the plan: it is
    meant for some hundred rules.
    """
    found = []
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        of_host = (host_value == name) | F.endswith(host_value, F.lit("." + name))
        fits = of_host & F.startswith(path_value, F.lit(slash + rest))
        found.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    empty = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*found, empty)


def mine(labelled: DataFrame, s: Settings = Settings(), url: str = "url", label: str = "label") -> DataFrame:
    """Rules (tokens, verdict, confidence, support, key) from labelled addresses, stored.

    Repeated rows count once, rows without a label not at all; an address with two labels
    counts for both. Without labelled addresses there are no rules.
    """
    c, spark = F.col, labelled.sparkSession
    rows = labelled.select(c(f"`{url}`").alias("url"), c(f"`{label}`").cast("string").alias("label"))
    rows = rows.filter("url IS NOT NULL AND label IS NOT NULL").distinct()
    sample = rows
    if s.labelled is not None:
        sample = rows.filter(share(c("url"), 5) < F.lit(min(1.0, s.labelled / max(1, rows.count()))))
    sample = stored(sample.select("url", "label", tokens(c("url")).alias("tokens")), "labelled_addresses")
    n = sample.count()
    if not n:
        return spark.createDataFrame([], RULES)

    # frequent tokens and how far their labels are from the labels of all
    each = sample.select("url", "label", F.explode("tokens").alias("token"))
    by_label = each.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"))
    base = sample.groupBy("label").agg((F.count(F.lit(1)) / n).alias("base"))
    frequent = by_label.groupBy("token").agg(F.sum("n").alias("all")).filter(c("all") >= s.support * n)
    tilt = by_label.join(frequent, "token").join(measured(base), "label")
    tilt = tilt.groupBy("token", "all").agg(F.max(c("n") / c("all") - c("base")).alias("tilt"))
    tilt = stored(tilt, "token_tilts")
    met = each.join(measured(tilt), "token")
    if s.combined is None:
        alike = stored(_alike(met), "tokens_alike")
        own = met.join(measured(alike.select(c("head").alias("token"))), "token").groupBy("url", "label")
        baskets = own.agg(F.collect_list("token").alias("tokens"))
    else:
        ranked = F.reverse(F.array_sort(F.collect_list(F.struct("tilt", "all", "token"))))
        own = met.groupBy("url", "label")
        baskets = own.agg(F.slice(F.transform(ranked, lambda x: x["token"]), 1, s.combined).alias("tokens"))
    # the label is an item that no token can be
    baskets = baskets.select(F.array_append("tokens", F.concat(F.lit("label "), "label")).alias("items"))
    baskets = stored(baskets, "baskets")
    share_of_met = baskets.count() / n
    if not share_of_met:
        return spark.createDataFrame([], RULES)
    least = min(1.0, s.support / share_of_met)
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=s.confidence).fit(baskets)
    found = model.associationRules.filter(F.startswith(c("consequent")[0], F.lit("label ")) & (c("lift") > 1))
    rows_met = baskets.count()
    found = found.select(
        F.array_sort("antecedent").alias("tokens"),
        F.substring(c("consequent")[0], 7, 1 << 30).alias("verdict"),
        "confidence",
        F.round(c("support") * rows_met).cast("bigint").alias("support"),
    )
    found = stored(found, "mined_rules")
    needed = _needed(_keyed(found, tilt))
    if s.combined is None:
        needed = _keyed(_spelled_out(stored(needed, "needed_rules").drop("key"), alike), tilt)
    return stored(needed, "url_rules")


def _alike(met: DataFrame) -> DataFrame:
    """(head, members) of tokens that lie in just the same labelled addresses.

    Rules that take one of them for another cover the same rows, and one with two of them is
    never needed: it is enough to mine the head. Equal sets have equal hashes, 128 bits long.
    """
    c = F.col
    here = [F.bit_xor(F.xxhash64(*x)).alias(n) for n, x in (("a", ("url", "label")), ("b", ("label", "url")))]
    sets = met.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *here)
    members = F.array_sort(F.collect_list("token"))
    return sets.groupBy("n", "a", "b").agg(members.alias("members")).select(c("members")[0].alias("head"), "members")


def _spelled_out(rules: DataFrame, alike: DataFrame) -> DataFrame:
    """Rules over heads as the rules over all members, one for each choice of members."""
    c = F.col
    by_head = rules.select(*rules.columns, F.explode("tokens").alias("head"))
    lists = by_head.join(measured(alike), "head").groupBy(*rules.columns).agg(F.collect_list("members").alias("lists"))
    grown = F.aggregate(
        "lists",
        F.array(F.array().cast("array<string>")),
        lambda done, own: F.flatten(F.transform(done, lambda x: F.transform(own, lambda t: F.array_append(x, t)))),
    )
    spelled = lists.withColumn("tokens_", F.explode(grown)).withColumn("tokens", F.array_sort("tokens_"))
    return spelled.select(*rules.columns)


def _keyed(rules: DataFrame, counts: DataFrame) -> DataFrame:
    """Rules with their rarest token as ``key``."""
    c = F.col
    own = rules.select("*", F.explode("tokens").alias("token")).join(measured(counts.select("token", "all")), "token")
    same = [x for x in rules.columns]
    return own.groupBy(*same).agg(F.min(F.struct("all", "token")).alias("least")).select(*same, c("least.token").alias("key"))


def _needed(rules: DataFrame) -> DataFrame:
    """Rules without those of which a part gives the same verdict as reliably."""
    c = F.col
    part = rules.select(
        c("key").alias("token"),
        c("tokens").alias("part"),
        c("verdict").alias("part_verdict"),
        c("confidence").alias("part_confidence"),
    )
    own = rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("token"))
    covered = own.join(measured(part), "token").filter(
        (c("verdict") == c("part_verdict"))
        & (c("part_confidence") >= c("confidence"))
        & (F.size("part") < F.size("tokens"))
        & (F.size(F.array_except("part", "tokens")) == 0)
    )
    return rules.join(covered.select("tokens", "verdict").distinct(), ["tokens", "verdict"], "left_anti")


def index(rules: DataFrame, s: Settings) -> DataFrame:
    """One row, one column: for each bucket of token hashes the rules whose key falls into it."""
    c = F.col
    rule = F.struct("confidence", "support", "tokens", "verdict", "key")
    own = rules.select(F.pmod(F.xxhash64("key"), F.lit(s.buckets)).alias("bucket"), rule.alias("rule"))
    every = rules.sparkSession.range(s.buckets).select(c("id").alias("bucket"))
    full = every.join(own, "bucket", "left").groupBy("bucket").agg(F.array_sort(F.collect_list("rule")).alias("rules"))
    listed = F.array_sort(F.collect_list(F.struct("bucket", "rules")))
    return full.agg(F.transform(listed, lambda x: x["rules"]).alias("index"))


def judged(
    pages: DataFrame,
    rules: DataFrame,
    listed: Sequence[tuple[str, str]] = (),
    s: Settings = Settings(),
    url: str = "url",
    name: str = "url_filter",
) -> DataFrame:
    """``pages`` and a column ``name``: struct(host, path, rule, verdict, learned).

    ``rule`` is the stated rule that decides, else null; ``learned`` the mined one
    (confidence, support, tokens, verdict, key) that is most reliable among those that fit,
    also where a stated rule decides, else null. Null and texts without ``://`` have an
    empty host and path, no tokens and the default verdict, unless a stated rule fits.
    """
    c = F.col
    name, held = spare(pages, name), spare(pages, "_index")
    value = c(f"`{url}`")

    def fitting(own: Column) -> Column:
        met = F.flatten(
            F.transform(own, lambda t: F.filter(F.get(c(held), F.pmod(F.xxhash64(t), F.lit(s.buckets)).cast("int")), lambda r: r["key"] == t))
        )
        whole = F.filter(met, lambda r: F.size(F.array_except(r["tokens"], own)) == 0)
        return F.array_max(whole)

    def verdict(x: Column) -> Column:
        rule = stated(x["host"], x["path"], listed)
        final = F.coalesce(rule["verdict"], x["learned"]["verdict"], F.lit(s.default))
        return F.struct(x["host"], x["path"], rule["rule"].alias("rule"), final.alias("verdict"), x["learned"].alias("learned"))

    seen = F.struct(host(value).alias("host"), path(value).alias("path"), let(tokens(value), fitting).alias("learned"))
    # a subquery may not stand inside the functions on arrays, a column of it may
    with_index = pages.withColumn(held, index(rules, s).scalar())
    return with_index.withColumn(name, let(seen, verdict)).drop(held)


def labelled_by(pages: DataFrame, listed: Sequence[tuple[str, str]], url: str = "url") -> DataFrame:
    """(url, label) of the addresses that a stated rule decides."""
    value = F.col(f"`{url}`")
    found = pages.select(value.alias("url"), stated(host(value), path(value), listed)["verdict"].alias("label"))
    return found.filter("label IS NOT NULL")
