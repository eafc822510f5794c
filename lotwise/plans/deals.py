"""Deal recommendation: scored listings, filtered, ranked and shaped for export."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.display import format_thousands, round_format
from lotwise.operators import filters
from lotwise.operators.groups import with_listing_count
from lotwise.operators.rank import first_per_group, missing_trims, sort_trim_gap, top_n_with_ties
from lotwise.params import Params
from lotwise.plans.effects import PriceModel
from lotwise.plans.scoring import score, with_forest_gap, with_linear_gap
from lotwise.workspace import stored, stored_lookup

# fixed values: column names of the published exports, and where they come from
_IDENTITY = {
    "Id": "id",
    "Link": "link",
    "Make": "make",
    "Model": "model_key",
    "Trim": "trim_key",
    "Year": "year",
    "Price": "price",
    "Mileage": "mileage",
}
_LINEAR = {"L_Predicted_Price": "pred3", "L_Price_Gap_Percentage": "l_gap"}
_FOREST = {"R_Predicted_Price": "predicted_price_rf", "R_Price_Gap_Percentage": "r_gap"}
_EXPLANATION = {
    "Average_Year_per_Trim": "avg_ymmt",
    "Average_Milerange_per_Trim_Year_LR": "avg_mileage_range_lr",
    "Average_Price_per_Trim": "price_pmmt",
    "Year_Effect": "year_effect",
    "Mileage_Effect": "mileage_effect",
}
LINEAR_COLUMNS = {**_IDENTITY, **_LINEAR, **_EXPLANATION}
DUAL_COLUMNS = {**_IDENTITY, **_LINEAR, **_FOREST, **_EXPLANATION}
FULL_LINEAR_COLUMNS = {**_IDENTITY, "Date_sold": "date_sold", **_EXPLANATION, **_LINEAR, "Count": "listing_count"}
FULL_DUAL_COLUMNS = {
    **_IDENTITY,
    "Date_sold": "date_sold",
    **_EXPLANATION,
    **_LINEAR,
    **_FOREST,
    "Count": "listing_count",
}

# fixed values: decimals shown per formatted column
DISPLAY_DIGITS = {
    "Price": 0,
    "Mileage": 0,
    "Average_Year_per_Trim": 2,
    "Average_Price_per_Trim": 2,
    "Average_Milerange_per_Trim_Year_LR": 2,
    "Year_Effect": 2,
    "Mileage_Effect": 2,
    "L_Predicted_Price": 2,
    "R_Predicted_Price": 2,
}


def select_rename(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(source).alias(name) for name, source in columns.items()])


def formatted(df: DataFrame) -> DataFrame:
    """Thousands separators on the number columns of an export."""
    shown = {c: d for c, d in DISPLAY_DIGITS.items() if c in df.columns}
    return df.withColumns({c: format_thousands(F.col(c), d) for c, d in shown.items()})


def scored_full(df: DataFrame, m: PriceModel, p: Params) -> DataFrame:
    """Full data with prediction, gap and listings per trim. The counts come with the
    model's trim table, which was fitted on the same rows."""
    return with_linear_gap(score(df, m, p, with_count=True), p)


def scored_recent(df: DataFrame, m: PriceModel, p: Params) -> DataFrame:
    """Fresh data with prediction, gap, and fresh listings per trim."""
    return with_linear_gap(score(with_listing_count(df), m, p), p)


def deals_full_linear(scored: DataFrame, p: Params) -> DataFrame:
    """Unsold, low-mileage listings of common trims asked far below the prediction,
    the best per trim with ties."""
    candidates = stored(
        select_rename(filters.deal_filter_full(scored, p), LINEAR_COLUMNS), "candidates"
    )
    return top_n_with_ties(candidates, ["Trim"], "L_Price_Gap_Percentage", p.top_per_trim)


def deals_recent_linear(scored: DataFrame, p: Params) -> DataFrame:
    return select_rename(filters.deal_filter_recent(scored, p), LINEAR_COLUMNS)


def deals_full_dual(scored: DataFrame, p: Params) -> DataFrame:
    """As the linear deals, but both models must agree; ranked by the forest's gap."""
    candidates = stored(
        select_rename(filters.deal_filter_full_dual(scored, p), DUAL_COLUMNS), "candidates"
    )
    return top_n_with_ties(candidates, ["Trim"], "R_Price_Gap_Percentage", p.top_per_trim)


def deals_recent_dual(scored: DataFrame, p: Params) -> DataFrame:
    return select_rename(filters.deal_filter_recent_dual(scored, p), DUAL_COLUMNS)


def sorted_deals(deals: DataFrame, gap: str = "L_Price_Gap_Percentage") -> DataFrame:
    return sort_trim_gap(deals, gap, "Trim", "Id")


def deal_short_table(deals: DataFrame) -> DataFrame:
    """One line per trim, rounded, for reading."""
    best = first_per_group(deals, "Trim", "L_Price_Gap_Percentage", "Id")
    return best.select(
        "Trim",
        "Year",
        format_thousands(F.col("Mileage")).alias("Mileage"),
        format_thousands(F.col("Price")).alias("Price"),
        round_format(F.col("L_Predicted_Price")).alias("Pred_Price"),
        round_format(F.col("L_Price_Gap_Percentage")).alias("Gap_Perc"),
    )


def deal_short_table_dual(deals: DataFrame) -> DataFrame:
    """Every dual deal, rounded, for reading."""
    return deals.select(
        "Trim",
        "Year",
        format_thousands(F.col("Mileage")).alias("Mileage"),
        format_thousands(F.col("Price")).alias("Price"),
        round_format(F.col("L_Predicted_Price")).alias("L_Price"),
        round_format(F.col("R_Predicted_Price")).alias("R_Price"),
        round_format(F.col("R_Price_Gap_Percentage")).alias("R_Gap"),
    )


def deals_by_gap(deals: DataFrame, gap: str = "R_Price_Gap_Percentage") -> DataFrame:
    return deals.orderBy(F.desc(gap), "Id")


def price_guard(low: float) -> Column:
    """Drops mis-keyed prices below a share of the trim's mean price."""
    return F.col("Price") >= F.col("Average_Price_per_Trim") * low


# fixed value: format of the sale date in the outcome file
SOLD_DATE = "d-MMM-yy"


def outcome_rows(
    deals: DataFrame, status: DataFrame, guard: float | None = None, recommended_on: date | None = None
) -> DataFrame:
    """Deals with what became of them: ``sold``, ``sold_on`` and ``days_to_sale``.

    ``status`` has Id, status text and, if known, ``Sold Date`` as text. It may list any
    listings, or none for a deal, or several lines for one: a listing is sold if a line
    says so, on the earliest readable date. It is cut to the deals' ids before the join.
    """
    c = F.col
    ids = stored_lookup(deals.select("Id").distinct(), "deal_ids")
    sold = F.coalesce(F.lower(F.trim(c("status"))) == "sold", F.lit(False))
    text = c("Sold Date") if "Sold Date" in status.columns else F.lit(None).cast("string")
    known = (
        status.join(ids, "Id", "left_semi")
        .select("Id", sold.alias("sold"), F.when(sold, F.try_to_date(text, SOLD_DATE)).alias("sold_on"))
        .groupBy("Id")
        .agg(F.bool_or("sold").alias("sold"), F.min("sold_on").alias("sold_on"))
    )
    rows = deals if guard is None else deals.filter(price_guard(guard))
    days = F.datediff("sold_on", F.lit(recommended_on).cast("date"))
    return rows.join(known, "Id", "left").withColumns(
        {"sold": F.coalesce("sold", F.lit(False)), "days_to_sale": days}
    )


def outcome_backtest(deals: DataFrame, status: DataFrame, guard: float | None = None) -> DataFrame:
    """Recommended, sold and the hit rate."""
    rows = outcome_rows(deals, status, guard)
    return rows.agg(
        F.count(F.lit(1)).alias("recommended"),
        F.count_if("sold").alias("sold"),
        F.avg(F.col("sold").cast("int")).alias("hit_rate"),
    )


def recent_dual_inputs(fresh: DataFrame, trained: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fresh rows whose trim was trained on, and the trims that were not."""
    return filters.in_trained_keys(fresh, trained), missing_trims(fresh, trained)


def with_both_gaps(scored_by_both: DataFrame, p: Params) -> DataFrame:
    return with_forest_gap(with_linear_gap(scored_by_both, p), p)
