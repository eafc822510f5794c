"""Sorts, top-k and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.nulls import paste
from lotwise.operators.profile import likes_by_model
from lotwise.workspace import stored, stored_lookup


def numbered(df: DataFrame, *order: Column | str, name: str = "place") -> DataFrame:
    """Rows with their place (from 0) in an order over all of them.

    Ranges of the order are dealt out and stored; a row's place is its place within its
    range plus the rows of the ranges before, whose counts are one row a range. So no task
    sees more than its range. Rows that tie are numbered as they come: end the order with
    a key. ``df`` gets no other column.
    """
    c = F.col
    within = F.monotonically_increasing_id()  # range number above 33 bits, place in it below
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", within)
    ordered = stored(ordered, "ordered")
    part, at = F.shiftright("_at", 33), c("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    out = ordered.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return out.select(*df.columns, (c("_start") + at).alias(name))


def sort_trim_gap(df: DataFrame, gap: str, trim: str = "trim_key", row_id: str = "id") -> DataFrame:
    """By trim, best gap first. A range sort on all three columns, so a trim that holds
    a large part of the rows is still spread over many partitions."""
    return df.orderBy(trim, F.desc(gap), row_id)


def top_n_with_ties(df: DataFrame, by: Sequence[str], score: str, n: int) -> DataFrame:
    """The ``n`` best rows per group and every row tied with the last of them.

    Only the n-th best score per group is ranked for: ``row_number() <= n`` is cut to n
    rows per group on the map side, before the shuffle. The rows then join with that
    threshold, so ties, however many, stay where they are. ``df`` is read twice: pass a
    stored table.
    """
    best = Window.partitionBy(*by).orderBy(F.desc_nulls_last(score))
    least = (
        df.select(*by, score)
        .withColumn("_n", F.row_number().over(best))
        .filter(F.col("_n") <= n)
        .groupBy(*by)
        .agg(F.min(score).alias("_least"))
    )
    least = stored_lookup(least, "least")
    return df.join(least, list(by)).filter(F.col(score) >= F.col("_least")).drop("_least")


def first_per_group(df: DataFrame, by: str, score: str, row_id: str = "id") -> DataFrame:
    """Best row per group (ties: smallest id). Each map task sends one row of a group on."""
    best = Window.partitionBy(by).orderBy(F.desc_nulls_last(score), row_id)
    return df.withColumn("_n", F.row_number().over(best)).filter("_n <= 1").drop("_n")


def top_liked_models(df: DataFrame, n: int = 10) -> DataFrame:
    """The models with the most likes, with their chart label, best first."""
    likes = likes_by_model(df).orderBy(F.desc_nulls_last("total_likes"), "make", "model").limit(n)
    return likes.select(paste(F.col("make"), F.col("model")).alias("make_model"), "total_likes")


def ordered_labels(df: DataFrame, label: str, value: str) -> DataFrame:
    """Labels with their place when ordered by value, largest first."""
    out = numbered(df.select(label, value), F.desc_nulls_last(value), label)
    return out.withColumn("place", (F.col("place") + 1).cast("int"))


def last_row(df: DataFrame, *order: str) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(1)


def union_rows(df: DataFrame, *others: DataFrame) -> DataFrame:
    """Append by column name, keeping duplicates."""
    for other in others:
        df = df.unionByName(other)
    return df


def union_missing_columns(df: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        df = df.unionByName(other, allowMissingColumns=True)
    return df


def missing_values(fresh: DataFrame, trained: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the fresh rows that the training rows do not have.

    Both sides are reduced to their keys before they meet.
    """
    return fresh.select(key).distinct().subtract(trained.select(key).distinct())


def missing_trims(fresh: DataFrame, trained: DataFrame) -> DataFrame:
    return missing_values(fresh, trained, "trim_key")


def missing_years(fresh: DataFrame, trained: DataFrame) -> DataFrame:
    return missing_values(fresh, trained, "year")
