"""Group statistics as lookup tables, and the same statistics put back on the rows.

The tables are plain aggregates (map-side combine, so a hot group is no hot task). A
statistic goes back on the rows by a join with the stored table, not by a window over
the group, which would pull the whole group into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.nulls import all_of, same, strict_avg
from lotwise.workspace import stored_lookup


def left_lookup(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left equi join in which null matches null; the table's key columns are dropped.

    Whether ``table`` is broadcast was settled when its rows were counted on storing it.
    """
    right = table.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    joined = df.join(right, all_of(same(df[k], right[f"_r_{k}"]) for k in keys), "left")
    return joined.drop(*[f"_r_{k}" for k in keys])


def group_table(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])


def with_group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Rows plus the statistics of their group."""
    return left_lookup(df, stored_lookup(group_table(df, keys, stats), "stats"), keys)


# --- lookup tables -----------------------------------------------------------------


def trim_mean_year_table(df: DataFrame) -> DataFrame:
    return group_table(df, ["trim_key"], {"avg_ymmt": strict_avg("year")})


def trim_mean_price_table(df: DataFrame) -> DataFrame:
    return group_table(df, ["trim_key"], {"price_pmmt": strict_avg("price")})


def mileage_tier_table(df: DataFrame) -> DataFrame:
    return group_table(df, ["trim_key", "year"], {"avg_mileage_range": strict_avg("mileage_range")})


def trim_year_price_table(df: DataFrame) -> DataFrame:
    return group_table(df, ["trim_key", "year"], {"price_pmmty": strict_avg("price")})


def trim_year_mileage_table(df: DataFrame) -> DataFrame:
    return group_table(df, ["trim_key", "year"], {"avg_mileage": strict_avg("mileage") + 1})


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


# --- statistics on the rows --------------------------------------------------------


def with_trim_means(df: DataFrame) -> DataFrame:
    """``avg_ymmt`` and ``price_pmmt`` from one aggregate."""
    return with_group_stats(
        df, ["trim_key"], {"avg_ymmt": strict_avg("year"), "price_pmmt": strict_avg("price")}
    )


def with_year_means(df: DataFrame) -> DataFrame:
    """``avg_mileage`` and ``price_pmmty`` per year of build."""
    return with_group_stats(
        df, ["year"], {"avg_mileage": strict_avg("mileage") + 1, "price_pmmty": strict_avg("price")}
    )


def with_mean_mileage_tier(df: DataFrame) -> DataFrame:
    return with_group_stats(
        df, ["trim_key", "year"], {"avg_mileage_range": strict_avg("mileage_range")}
    )


def with_listing_count(df: DataFrame) -> DataFrame:
    """Listings per trim, counted before any deal filter."""
    return with_group_stats(df, ["trim_key"], {"listing_count": F.count(F.lit(1))})


def with_trim_prediction_mean(df: DataFrame) -> DataFrame:
    """Mean prediction per trim, and how far the mean price lies from it."""
    c = F.col
    out = with_group_stats(df, ["trim_key"], {"pred3_pmmt": strict_avg("pred3")})
    return out.withColumns(
        {
            "pmmt_difference": c("price_pmmt") - c("pred3_pmmt"),
            "pmmt_absolute": F.try_divide(c("price_pmmt") - c("pred3_pmmt"), c("price_pmmt")) * 100,
        }
    )
