"""Hierarchical group keys. ``year`` stays an integer beside ``trim_key``; the pasted
year and mileage keys are built only where an output shows them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.nulls import paste


def model_key(make: Column, model: Column) -> Column:
    return paste(make, model)


def trim_key(make: Column, model: Column, trim: Column, cylinder: Column, gear: Column) -> Column:
    """Make, then the already prefixed model key, so the make shows twice."""
    return paste(make, model_key(make, model), trim, cylinder, gear)


def year_key(trim: Column, year: Column) -> Column:
    return paste(trim, year)


def mileage_key(trim: Column, tier: Column) -> Column:
    return paste(trim, tier.cast("bigint"))


def year_of_key(key: Column) -> Column:
    return F.right(key, F.lit(4)).try_cast("int")


def trim_of_key(key: Column) -> Column:
    return F.left(key, F.length(key) - 5)


def with_keys(df: DataFrame) -> DataFrame:
    """Add ``model_key`` and ``trim_key``."""
    c = F.col
    return df.withColumns(
        {
            "model_key": model_key(c("make"), c("model")),
            "trim_key": trim_key(c("make"), c("model"), c("trim"), c("cylinder"), c("gear_type")),
        }
    )
