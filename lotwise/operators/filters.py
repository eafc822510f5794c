"""Row filters. Each is a narrow predicate; a row whose test is unknown is not kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.nulls import all_of, same
from lotwise.params import Params
from lotwise.workspace import stored_lookup


def filter_price_cap(df: DataFrame, p: Params) -> DataFrame:
    return df.filter(F.col("price") < p.price_cap)


def filter_min_year(df: DataFrame, p: Params) -> DataFrame:
    return df.filter(F.col("year") > p.min_year)


def filter_price_present(df: DataFrame) -> DataFrame:
    return df.filter(F.col("price").isNotNull())


def keep_listings(df: DataFrame, p: Params) -> DataFrame:
    """First year, price cap and price presence: Catalyst folds them into one filter, in this
    order, so that a price is only worked out for a row of a late enough year."""
    return filter_price_present(filter_price_cap(filter_min_year(df, p), p))


def filter_positive_price(df: DataFrame) -> DataFrame:
    return df.filter(F.col("price") > 0)


def filter_mileage_anomaly(df: DataFrame, p: Params) -> DataFrame:
    return df.filter(F.col("mileage") <= p.mileage_limit)


def filter_make_model(df: DataFrame, make: str | Column, model: str | None = None) -> DataFrame:
    """Rows of one make (a literal or a scalar subquery) and, if given, one model."""
    out = df.filter(F.col("make") == make)
    return out if model is None else out.filter(F.col("model") == model)


def _unsold_low_mileage(p: Params) -> Column:
    return (
        (F.col("listing_count") > p.min_count)
        & (F.col("date_sold") == "")
        & (F.col("mileage") < p.max_mileage)
    )


def deal_filter_full(df: DataFrame, p: Params) -> DataFrame:
    return df.filter(_unsold_low_mileage(p) & (F.col("l_gap") > p.gap_full))


def deal_filter_recent(df: DataFrame, p: Params) -> DataFrame:
    return df.filter(F.col("l_gap") > p.gap_recent)


def deal_filter_full_dual(df: DataFrame, p: Params) -> DataFrame:
    return deal_filter_full(df, p).filter(F.col("r_gap") > p.gap_full)


def deal_filter_recent_dual(df: DataFrame, p: Params) -> DataFrame:
    return df.filter((F.col("l_gap") > p.gap_recent) & (F.col("r_gap") > p.gap_recent))


def semi_join_keys(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key tuple occurs in ``known``; null matches null, as in the source rules.

    The known side is reduced to its distinct keys by a map-side-combined aggregate,
    stored and counted, so that ``df`` is not shuffled for a short list of keys.
    """
    right = known.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    right = stored_lookup(right, "known_keys")
    return df.join(right, all_of(same(df[k], right[f"_k_{k}"]) for k in keys), "left_semi")


def in_trained_keys(df: DataFrame, trained: DataFrame, check_year: bool = False) -> DataFrame:
    """Fresh rows whose trim (and, if asked, whose year) the model was trained on."""
    out = semi_join_keys(df, trained, ["trim_key"])
    return semi_join_keys(out, trained, ["year"]) if check_year else out
