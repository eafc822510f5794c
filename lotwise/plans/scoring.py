"""Scoring: frame in, frame out, no state. Three lookups, then column arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions import pricing
from lotwise.functions.clean import mileage_tier
from lotwise.operators.groups import left_lookup
from lotwise.params import Params
from lotwise.plans.effects import PriceModel

YEAR_LINE = ["a", "b"]
MILEAGE_LINE = ["aa", "bb"]
GROUP_STATS = ["price_pmmt", "avg_ymmt"]


def join_make_effect(df: DataFrame, m: PriceModel) -> DataFrame:
    return left_lookup(df, m.make, ["make"])


def join_model_effect(df: DataFrame, m: PriceModel) -> DataFrame:
    return left_lookup(df, m.model, ["model_key"])


def join_trim_columns(df: DataFrame, m: PriceModel, columns: list[str]) -> DataFrame:
    """Any of the trim level's columns: effect, lines, group means, listing count."""
    return left_lookup(df, m.trim.select("trim_key", *columns), ["trim_key"])


def join_trim_effect(df: DataFrame, m: PriceModel) -> DataFrame:
    return join_trim_columns(df, m, ["b_trim"])


def join_year_line(df: DataFrame, m: PriceModel) -> DataFrame:
    return join_trim_columns(df, m, YEAR_LINE)


def join_mileage_line(df: DataFrame, m: PriceModel) -> DataFrame:
    return join_trim_columns(df, m, MILEAGE_LINE)


def join_group_stats(df: DataFrame, m: PriceModel) -> DataFrame:
    """Trim means, and the mean mileage tier of the (trim, year)."""
    out = join_trim_columns(df, m, GROUP_STATS)
    tiers = m.trim_year.select("trim_key", "year", "avg_mileage_range")
    return left_lookup(out, tiers, ["trim_key", "year"])


def join_model_tables(df: DataFrame, m: PriceModel, with_count: bool = False) -> DataFrame:
    """All effects and group means; the trim level's tables travel as one."""
    columns = ["b_trim", *YEAR_LINE, *MILEAGE_LINE, *GROUP_STATS]
    columns += ["listing_count"] if with_count else []
    return join_trim_columns(join_model_effect(join_make_effect(df, m), m), m, columns)


def predict(joined: DataFrame, mu: float, p: Params = Params()) -> DataFrame:
    """Prediction after every level, and the explanation of the last one.

    ``stage_make`` has no floor; the later stages are floored at a share of the trim's
    mean price. ``pred1`` = with the year line, ``pred2`` = mileage adjusted,
    ``pred3`` = floored, the model's answer.
    """
    c = F.col
    with_make = F.lit(mu) + c("b_make")
    with_model = with_make + c("b_model")
    with_trim = with_model + c("b_trim")
    fallback = pricing.year_fallback(c("b"), c("price_pmmt"), c("year"), c("avg_ymmt"), p)
    trim_price = c("price_pmmt")
    return (
        joined.withColumns(
            {
                "stage_make": with_make,
                "stage_model": pricing.price_floor(with_model, trim_price, p),
                "stage_trim": pricing.price_floor(with_trim, trim_price, p),
                "price_year_value": fallback,
                "avg_mileage_range_lr": pricing.clamp_at_zero(
                    pricing.line(c("aa"), c("bb"), c("year"))
                ),
                "_tier": mileage_tier(c("mileage"), p.tier_width),
            }
        )
        .withColumn(
            "pred1", with_trim + pricing.line(c("a"), c("b"), c("year")) + c("price_year_value")
        )
        .withColumns(
            {
                "stage_year": pricing.price_floor(c("pred1"), trim_price, p),
                "pred2": pricing.mileage_adjust(c("pred1"), c("avg_mileage_range_lr"), c("_tier"), p),
            }
        )
        .withColumns(
            {
                "pred3": pricing.price_floor(c("pred2"), trim_price, p),
                "year_effect": c("pred1") - trim_price,
                "mileage_effect": c("pred2") - c("pred1"),
            }
        )
        .drop("_tier")
    )


def score(df: DataFrame, m: PriceModel, p: Params = Params(), with_count: bool = False) -> DataFrame:
    """Predictions for any rows with keys: full data, fresh listings or typed-in cars."""
    return predict(join_model_tables(df, m, with_count), m.mu, p)


def with_linear_gap(scored: DataFrame, p: Params = Params()) -> DataFrame:
    """Gap of the prediction over the asked price, in currency and per cent."""
    c = F.col
    return scored.withColumns(
        {
            "price_difference": c("pred3") - c("price"),
            "absolute_difference": F.abs(c("pred3") - c("price")),
            "l_gap": pricing.price_gap(c("pred3"), c("price"), p),
        }
    )


def with_forest_gap(scored: DataFrame, p: Params = Params()) -> DataFrame:
    c = F.col
    return scored.withColumns(
        {
            "price_difference_rf": c("predicted_price_rf") - c("price"),
            "r_gap": pricing.price_gap(c("predicted_price_rf"), c("price"), p),
        }
    )
