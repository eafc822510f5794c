"""The additive group-effects model, fitted from one scan of the rows.

Every number of the model is a function of sums per (make, model, trim, year). One
aggregate with map-side combine reduces the rows to these *cells*; they are stored, and
all effects, each fitted on what the levels above leave over, are small aggregates on
them. No later level touches the rows again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.operators.groups import left_lookup
from lotwise.params import Params
from lotwise.workspace import measured, stored, stored_lookup

CELL = ["make", "model_key", "trim_key", "year"]
_TABLES = ("make", "model", "trim", "trim_year", "cells")
_SUMS = ["listings", "n", "price_sum", "tier_n", "tier_sum", "train_n", "train_sum"]


@dataclass(frozen=True)
class PriceModel:
    """Fitted state: one scalar, four lookup tables, and the sums they were fitted on."""

    mu: float
    make: DataFrame  # make, b_make
    model: DataFrame  # model_key, b_model
    trim: DataFrame  # trim_key, b_trim, a, b, aa, bb, price_pmmt, avg_ymmt, listing_count
    trim_year: DataFrame  # trim_key, year, b_year, avg_mileage_range, and their fitted values
    cells: DataFrame  # make, model_key, trim_key, year and sums: all that a later fit needs

    def save(self, path: str) -> None:
        """Write the tables below ``path``, which must not exist yet."""
        spark = self.make.sparkSession
        spark.createDataFrame([(self.mu,)], "mu double").coalesce(1).write.parquet(f"{path}/mu")
        for name in _TABLES:
            getattr(self, name).write.parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> PriceModel:
        mu = spark.read.parquet(f"{path}/mu").first()["mu"]
        *tables, cell = [spark.read.parquet(f"{path}/{n}") for n in _TABLES]
        return PriceModel(mu, *[measured(t) for t in tables], cell)


def cells(df: DataFrame, fit_on: str = "full") -> DataFrame:
    """Sums per (make, model, trim, year) over rows with ``split``, ``price``, ``mileage_range``.

    ``listings`` counts all rows, whatever the means are fitted on.
    """
    train = F.col("split") == "train"
    used = F.lit(True) if fit_on == "full" else train
    return df.groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("listings"),
        F.count_if(used).alias("n"),
        F.sum(F.when(used, F.col("price"))).alias("price_sum"),
        F.count(F.when(used, F.col("mileage_range"))).alias("tier_n"),
        F.sum(F.when(used, F.col("mileage_range"))).alias("tier_sum"),
        F.count_if(train).alias("train_n"),
        F.sum(F.when(train, F.col("price"))).alias("train_sum"),
    )


def overall_mean(cell: DataFrame) -> float:
    """Mean training price: one number."""
    return cell.agg((F.sum("train_sum") / F.sum("train_n")).alias("mu")).first()["mu"]


def level_effect(cell: DataFrame, keys: list[str], explained: Column, name: str) -> DataFrame:
    """Mean of what ``explained`` (per row of the cell) leaves of the training price."""
    left_over = F.sum(F.col("train_sum") - F.col("train_n") * explained)
    trained = cell.filter(F.col("train_n") > 0)
    return trained.groupBy(*keys).agg((left_over / F.sum("train_n")).alias(name))


def year_line(year_effects: DataFrame, p: Params) -> DataFrame:
    """Per trim the unweighted line through its (year, b_year) points; one point: flat."""
    one = F.count(F.lit(1)) == 1
    slope = F.regr_slope("b_year", "year")
    slope = F.when(F.abs(slope) >= p.flat_slope, slope).otherwise(F.lit(0.0))
    return year_effects.groupBy("trim_key").agg(
        F.when(one, F.max("b_year")).otherwise(F.regr_intercept("b_year", "year")).alias("a"),
        F.when(one, F.lit(0.0)).otherwise(slope).alias("b"),
    )


def mileage_line(tiers: DataFrame) -> DataFrame:
    """Per trim the line through its (year, mean mileage tier) points.

    One unknown mean makes the whole line unknown.
    """
    one = F.count(F.lit(1)) == 1
    known = F.count("avg_mileage_range") == F.count(F.lit(1))
    y, x = "avg_mileage_range", "year"
    return tiers.groupBy("trim_key").agg(
        F.when(one, F.max(y)).when(known, F.regr_intercept(y, x)).alias("aa"),
        F.when(one, F.lit(0.0)).when(known, F.regr_slope(y, x)).alias("bb"),
    )


def tier_means(cell: DataFrame) -> DataFrame:
    """Mean mileage tier per (trim, year); null if one listing has no mileage."""
    complete = F.sum("tier_n") == F.sum("n")
    return cell.filter("n > 0").groupBy("trim_key", "year").agg(
        F.when(complete, F.sum("tier_sum") / F.sum("n")).alias("avg_mileage_range")
    )


def trim_stats(cell: DataFrame) -> DataFrame:
    n = F.sum("n")
    return cell.groupBy("trim_key").agg(
        F.try_divide(F.sum("price_sum"), n).alias("price_pmmt"),
        F.try_divide(F.sum(F.col("n") * F.col("year")), n).alias("avg_ymmt"),
        F.sum("listings").alias("listing_count"),
    )


def merged_cells(one: DataFrame, other: DataFrame) -> DataFrame:
    """Cells of both: they are sums, so those of a cell add up."""
    both = one.unionByName(other).groupBy(*CELL)
    return both.agg(*[F.sum(x).alias(x) for x in _SUMS])


def refit(model: PriceModel, fresh: DataFrame, p: Params = Params()) -> PriceModel:
    """The model of all rows seen so far and the ``fresh`` ones, which need a ``split`` too.

    Only the fresh rows and the stored sums are read: what the model was fitted on before
    need not be there any more. ``p.fit_on`` must be what the model was fitted with.
    """
    return fit_cells(merged_cells(model.cells, cells(fresh, p.fit_on)), p)


def fit(df: DataFrame, p: Params = Params()) -> PriceModel:
    """Fit on the rows marked ``train``; group means on ``p.fit_on`` rows."""
    return fit_cells(cells(df, p.fit_on), p)


def fit_cells(sums: DataFrame, p: Params = Params()) -> PriceModel:
    """Fit on the sums of :func:`cells`."""
    c = F.col
    cell = stored(sums, "cells")
    mu = overall_mean(cell)
    make = stored_lookup(level_effect(cell, ["make"], F.lit(mu), "b_make"), "make")
    cell_1 = left_lookup(cell, make, ["make"])
    so_far = F.lit(mu) + c("b_make")
    model = stored_lookup(level_effect(cell_1, ["model_key"], so_far, "b_model"), "model")
    cell_2 = left_lookup(cell_1, model, ["model_key"])
    so_far = so_far + c("b_model")
    trim_level = stored_lookup(level_effect(cell_2, ["trim_key"], so_far, "b_trim"), "trim_level")
    cell_3 = left_lookup(cell_2, trim_level, ["trim_key"])
    so_far = so_far + c("b_trim")
    years = level_effect(cell_3, ["trim_key", "year"], so_far, "b_year")
    trim_year = stored_lookup(
        tier_means(cell).join(years, ["trim_key", "year"], "left"), "trim_year"
    )
    trained_years = trim_year.filter(c("b_year").isNotNull())
    trim = trim_stats(cell)
    for part in (trim_level, year_line(trained_years, p), mileage_line(trim_year)):
        trim = trim.join(part, "trim_key", "left")
    return PriceModel(mu, make, model, stored_lookup(trim, "trim"), trim_year, cell)


def year_line_check(model: PriceModel) -> DataFrame:
    """Year effect of every trained (trim, year) beside its value on the line."""
    lines = model.trim.select("trim_key", "a", "b")
    points = model.trim_year.filter(F.col("b_year").isNotNull()).select("trim_key", "year", "b_year")
    fitted = F.col("a") + F.col("b") * F.col("year")
    return points.join(lines, "trim_key").withColumn("b_year_line", fitted)


def mileage_line_check(model: PriceModel) -> DataFrame:
    """Mean tier of every (trim, year) beside its value on the line, not below zero."""
    from lotwise.functions.pricing import clamp_at_zero, line

    lines = model.trim.select("trim_key", "aa", "bb")
    points = model.trim_year.select("trim_key", "year", "avg_mileage_range")
    fitted = clamp_at_zero(line(F.col("aa"), F.col("bb"), F.col("year")))
    return points.join(lines, "trim_key").withColumn("avg_mileage_range_line", fitted)
