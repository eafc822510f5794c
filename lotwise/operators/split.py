"""Stratified split into train, test and validation, with every hold-out key covered.

A round holds out a share of each price stratum. Which rows these are is settled by a
few numbers: the interior price breaks and, per stratum, the last hold-out row in the
order (bucket of the row id, row id). The numbers are found by aggregates whose size
does not depend on the rows; the split itself is then a plain expression on each row,
with no sort, no window and no shuffle of the rows.

Hold-out rows with a key value that no training row has go back to training. Coverage
is settled on the distinct key tuples, not on the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.nulls import all_of, any_of, same
from lotwise.operators.quantiles import bracketed_quantiles, brackets, exact_quantiles
from lotwise.operators.rank import numbered
from lotwise.params import Params
from lotwise.workspace import BROADCAST_BYTES, stored, stored_lookup, stored_sized

# every single entry must occur among the training rows
COVERAGE_KEYS = [
    ["make"],
    ["model_key"],
    ["trim_key"],
    ["trim_key", "year"],
    ["gear_type"],
    ["cylinder"],
    ["trim_key", "mileage_range"],
    ["personal"],
]
KEY_COLUMNS = [
    "make",
    "model_key",
    "trim_key",
    "year",
    "gear_type",
    "cylinder",
    "mileage_range",
    "personal",
]


@dataclass(frozen=True)
class Cut:
    """Hold out the rows of a stratum up to and with (bucket, row_id)."""

    stratum: int
    bucket: int
    row_id: str


def order_id(df: DataFrame) -> Column:
    """The id, or for a row without one a hash of its values: such rows are spread as others."""
    values = [c for c in (*KEY_COLUMNS, "price", "mileage", "link") if c in df.columns]
    return F.coalesce(F.col("id"), F.concat(F.lit("?"), F.hex(F.xxhash64(*values))))


def hash_bucket(p: Params, row_id: Column) -> Column:
    """Default order of the rows: a seeded hash of the id, folded into buckets."""
    return F.pmod(F.xxhash64(row_id, F.lit(p.seed)), F.lit(p.order_buckets))


def price_breaks(
    df: DataFrame, groups: int, price: str = "price", around: Sequence[tuple[float, float]] | None = None
) -> list[float]:
    """Interior quantiles of the price: ``groups - 1`` numbers at most.

    ``around``: where they are likely to lie. Otherwise a sketch tells; where that does not
    help, as with millions of different prices close together, prices are ordered by ranges.
    """
    probs = [i / groups for i in range(1, groups)]
    found = None
    if around is not None:
        found = bracketed_quantiles(df, price, probs, around)
    if found is None and (near := brackets(df, price, probs)) is not None:
        found = bracketed_quantiles(df, price, probs, near.near)
    if found is None:
        found = [r["q"] for r in exact_quantiles(df, price, probs).orderBy("p").collect()]
    return sorted(set(found))


def stratum(breaks: list[float], price: str = "price") -> Column:
    """Number of breaks below the price: intervals closed on the right."""
    return sum(((F.col(price) > b).cast("int") for b in breaks), F.lit(0))


def holdout_cuts(df: DataFrame, share: float) -> list[Cut]:
    """One cut per stratum for a frame with ``_stratum``, ``_bucket`` and ``id``.

    Rows that share an id stay on one side, so with unique ids exactly
    ``ceil(share * rows)`` rows of the stratum are held out.
    """
    c = F.col
    # at most strata x buckets rows
    counts = df.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("n")).toArrow()
    strata: dict[int, list[tuple[int, int]]] = {}
    for number, bucket, n in zip(*(counts.column(x).to_pylist() for x in ("_stratum", "_bucket", "n"))):
        if number is not None:
            strata.setdefault(number, []).append((bucket, n))
    last: list[tuple[int, int, int]] = []  # stratum, its last bucket, rows held out of that
    for number, own in strata.items():
        want = math.ceil(sum(n for _, n in own) * share)
        before = 0
        for bucket, n in sorted(x for x in own if x[0] is not None):
            if before < want <= before + n:
                last.append((number, bucket, want - before))
            before += n
    # rows of the last buckets; those with an id before theirs are all rows that rank before
    need = F.lit(None).cast("bigint")
    for number, bucket, k in last:
        need = F.when((c("_stratum") == number) & (c("_bucket") == bucket), F.lit(k)).otherwise(need)
    met = df.select("_stratum", "_bucket", "id", need.alias("need")).filter(c("need").isNotNull())
    by_id = Window.partitionBy("_stratum").orderBy("id")
    rows = (
        met.withColumn("before", F.rank().over(by_id) - 1)
        .filter(c("before") < c("need"))
        .groupBy("_stratum")
        .agg(F.first("_bucket").alias("_bucket"), F.max("id").alias("id"))
    ).collect()
    return [Cut(r["_stratum"], r["_bucket"], r["id"]) for r in rows]


def held_out(cuts: list[Cut], group: Column, bucket: Column, row_id: Column) -> Column:
    return any_of(
        (group == k.stratum)
        & ((bucket < k.bucket) | ((bucket == k.bucket) & (row_id <= k.row_id)))
        for k in cuts
    )


def holdout_rule(
    df: DataFrame,
    share: float,
    p: Params,
    bucket: Column | None = None,
    around: Sequence[tuple[float, float]] | None = None,
) -> tuple[list[float], list[Cut]]:
    """The numbers that settle one round: price breaks, and one cut per stratum."""
    breaks = price_breaks(df, p.strata, around=around)
    row_id = order_id(df)
    order = hash_bucket(p, row_id) if bucket is None else bucket
    narrow = df.select(stratum(breaks).alias("_stratum"), order.alias("_bucket"), row_id.alias("id"))
    return breaks, holdout_cuts(narrow, share)


def in_holdout(
    df: DataFrame, breaks: list[float], cuts: list[Cut], p: Params, bucket: Column | None = None
) -> Column:
    """Never null: a row without a price or a bucket is not held out."""
    row_id = order_id(df)
    order = hash_bucket(p, row_id) if bucket is None else bucket
    return F.coalesce(held_out(cuts, stratum(breaks), order, row_id), F.lit(False))


def stratified_holdout(
    df: DataFrame, share: float, p: Params, bucket: Column | None = None, name: str = "held_out"
) -> DataFrame:
    """Rows plus a flag: held out of their price stratum or not."""
    breaks, cuts = holdout_rule(df, share, p, bucket)
    return df.withColumn(name, in_holdout(df, breaks, cuts, p, bucket))


def _by_kind(tuples: DataFrame, keys: list[list[str]]) -> DataFrame:
    """Key tuples with one row for each kind of key: its number and text."""
    kinds = [F.struct(F.lit(i).alias("kind"), _key_text(key).alias("key")) for i, key in enumerate(keys)]
    return tuples.withColumn("_k", F.explode(F.array(*kinds))).select(*tuples.columns, "_k.kind", "_k.key")


def semi_join_chain(df: DataFrame, train: DataFrame, keys=COVERAGE_KEYS) -> DataFrame:
    """Rows of ``df`` each of whose keys, taken one by one, occurs in ``train``.

    Settled on the distinct key tuples of both sides: those of ``df`` with a key that
    ``train`` lacks are found in one join for all kinds of key, and rows with such a
    tuple are left out.
    """
    columns = list(dict.fromkeys(k for key in keys for k in key))
    known = _by_kind(train.select(*columns).distinct(), keys).select("kind", "key").distinct()
    tuples = _by_kind(df.select(*columns).distinct(), keys)
    lacking = tuples.join(known, ["kind", "key"], "left_anti").select(*columns).distinct()
    return _without_tuples(df, lacking, columns)


def _without_tuples(df: DataFrame, tuples: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``columns`` do not occur in ``tuples``, null matching null.

    Rows meet by one hash of the columns; the columns themselves decide.
    """
    renamed = [F.col(c).alias(f"_k_{c}") for c in columns]
    # stored: the planner would carry what it knows of each column over to every alias
    right = stored_lookup(tuples.select(F.xxhash64(*columns).alias("_h"), *renamed), "tuples")
    hit = (F.xxhash64(*[df[c] for c in columns]) == right["_h"]) & all_of(
        same(df[c], right[f"_k_{c}"]) for c in columns
    )
    return df.join(right, hit, "left_anti")


def anti_join_natural(df: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of ``df`` that do not occur in ``other``, compared on all common columns."""
    common = [c for c in df.columns if c in other.columns]
    return _without_tuples(df, other.select(*common).distinct(), common)


def _key_text(columns: list[str]) -> Column:
    """One text per key; a missing part differs from every value."""
    parts = [
        F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(c).cast("string")))
        for c in columns
    ]
    return F.concat_ws("\u0001", *parts)


def uncovered_tuples(tuples: DataFrame) -> DataFrame:
    """Held-out key tuples with at least one key that no training tuple has, once for each such key.

    ``tuples`` holds each distinct key tuple with ``any_out`` and ``all_out``. All keys
    are looked at in one aggregate per (kind of key, key): no training set is joined.
    """
    keyed = _by_kind(tuples, COVERAGE_KEYS)
    missing = keyed.groupBy("kind", "key").agg(F.bool_and("all_out").alias("m")).filter("m")
    missing = stored_lookup(missing.select("kind", "key"), "missing_keys")
    hit = keyed.filter("any_out").join(missing, ["kind", "key"], "left_semi")
    return hit.select(*KEY_COLUMNS)


def return_uncovered(df: DataFrame, flag: str, within: Column | None = None) -> DataFrame:
    """Clear the flag on held-out rows that have a key no training row has.

    ``within`` limits the rows that count, here those not held out in an earlier round.
    A missing flag counts as not held out.

    Coverage is worked out on the distinct key tuples of all rows, from one scan. The
    uncovered tuples are those of rare keys, so as a rule they are few and one more scan
    meets them in memory. If they are many, the planner joins by shuffle; rows that are
    not held out have no key to meet and are spread by skew handling.
    """
    out = F.coalesce(F.col(flag), F.lit(False))
    counted = df if within is None else df.filter(within)
    tuples = stored(
        counted.groupBy(*KEY_COLUMNS).agg(F.max(out).alias("any_out"), F.min(out).alias("all_out")),
        "key_tuples",
    )
    # tuples by the hash of their columns: as good as always one tuple per hash
    hashed = uncovered_tuples(tuples).groupBy(F.xxhash64(*KEY_COLUMNS).alias("_h"))
    uncovered, _, size = stored_sized(
        hashed.agg(F.collect_set(F.struct(*KEY_COLUMNS)).alias("_tuples")), "uncovered"
    )

    def repaired(rows: DataFrame) -> DataFrame:
        # one number to look up, none for training rows; the columns decide on a hit
        met = rows.withColumn("_h", F.when(out, F.xxhash64(*KEY_COLUMNS)))
        met = met.join(uncovered, "_h", "left")
        hit = F.exists("_tuples", lambda t: all_of(same(t[k], F.col(k)) for k in KEY_COLUMNS))
        kept = out & ~F.coalesce(hit, F.lit(False))
        return met.withColumn(flag, kept).drop("_h", "_tuples")

    # a lookup in memory is cheaper than a copy of all rows, a shuffle for each later scan is not
    return repaired(df) if size <= BROADCAST_BYTES else stored(repaired(df), "repaired")


def split_with_coverage(df: DataFrame, p: Params, bucket: Column | None = None) -> DataFrame:
    """Rows plus ``split``: ``train``, ``test`` or ``validation``.

    First the validation share is held out and repaired, then the test share of the rest.
    """
    probs = [i / p.strata for i in range(1, p.strata)]
    near = brackets(df, "price", probs)
    breaks, cuts = holdout_rule(df, p.validation_share, p, bucket, near and near.near)
    first = df.withColumn("_validation", in_holdout(df, breaks, cuts, p, bucket))
    first = return_uncovered(first, "_validation")
    # every stratum loses about the same share, so its ends hardly move
    breaks, cuts = holdout_rule(first.filter("NOT _validation"), p.test_share, p, bucket, near and near.wide)
    test = ~F.col("_validation") & in_holdout(first, breaks, cuts, p, bucket)
    second = return_uncovered(first.withColumn("_test", test), "_test", ~F.col("_validation"))
    name = F.when(F.col("_validation"), "validation").when(F.col("_test"), "test").otherwise("train")
    return second.withColumn("split", name).drop("_validation", "_test")


def random_sample(
    df: DataFrame, n: int, p: Params, row_id: str = "id", order: Column | None = None
) -> DataFrame:
    """``n`` rows in hash order of their id, or another ``order``: the same rows on every run.

    Any ``n``: keys are dealt out by ranges, the counts of the ranges tell which one holds
    the n-th, and a filter takes all rows up to that key, so no task holds the sample. Only
    rows that tie with the n-th in order and id are numbered, to take as many as are left;
    rows that are alike in all columns are interchangeable. ``df`` is read three times.
    """
    c = F.col
    if n <= 0:
        return df.limit(0)
    first = F.xxhash64(c(row_id), F.lit(p.seed)) if order is None else order
    key = F.struct(first.alias("k"), c(row_id).alias("i"))
    ranged = df.select(key.alias("key")).repartitionByRange("key").withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "sample_keys")
    ends = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).withColumn("end", ends)
    met = sizes.filter(c("end") >= n).orderBy("range").first()
    if met is None:
        return df
    before = met["end"] - met["n"]
    in_order = Window.partitionBy("range").orderBy("key")
    inside = ranged.filter(c("range") == met["range"]).select(
        "key", F.row_number().over(in_order).alias("place"), F.rank().over(in_order).alias("from")
    )
    last = inside.filter(c("place") == n - before).select("key", "from").first()
    kinds = ranged.schema["key"].dataType
    at = F.struct(*[F.lit(last["key"][f.name]).cast(f.dataType).alias(f.name) for f in kinds])
    left = n - before - (last["from"] - 1)
    if left == ranged.filter(c("key") == at).count():
        return df.filter(key <= at)
    alike = F.xxhash64(*[F.to_json(F.struct(c(f"`{x}`"))) for x in df.columns])
    ties = numbered(df.filter(key == at).withColumn("_tie", alike), "_tie", name="_left")
    return df.filter(key < at).unionByName(ties.filter(c("_left") < left).select(*df.columns))
