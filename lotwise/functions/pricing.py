"""Column expressions of the additive price model. Missing input gives a missing
result in every branch, so no expression here has an ``otherwise`` over nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.params import Params


def line(intercept: Column, slope: Column, x: Column) -> Column:
    return intercept + slope * x


def clamp_at_zero(x: Column) -> Column:
    return F.when(x > 0, x).when(x <= 0, F.lit(0.0))


def year_fallback(slope: Column, trim_price: Column, year: Column, trim_year: Column, p: Params) -> Column:
    """Flat trims move by a fixed share of their mean price per year off their mean year."""
    return F.when(slope == 0, trim_price * p.year_rate * (year - trim_year)).when(
        slope != 0, F.lit(0.0)
    )


def mileage_adjust(pred: Column, expected_tier: Column, tier: Column, p: Params) -> Column:
    return pred + F.lit(p.mileage_weight) * pred * (expected_tier - tier) / F.lit(p.mileage_scale)


def price_floor(pred: Column, trim_price: Column, p: Params) -> Column:
    low = trim_price * p.floor_share
    return F.when(pred >= low, pred).when(pred < low, low)


def gap_percent(pred: Column, price: Column) -> Column:
    return F.try_divide(pred - price, price) * 100


def gap_deadband(gap: Column, p: Params) -> Column:
    return F.when(gap.between(-p.deadband, p.deadband), F.lit(0.0)).otherwise(gap)


def price_gap(pred: Column, price: Column, p: Params) -> Column:
    return gap_deadband(gap_percent(pred, price), p)
