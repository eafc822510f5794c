"""Cleaning, keys, display and other scalar columns; row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.catalog import sql as S
from lotwise.catalog.registry import query
from lotwise.catalog.rounding import r
from lotwise.catalog.study import P
from lotwise.functions import clean, display, keys
from lotwise.operators import filters
from lotwise.operators.profile import nth_most_frequent_make
from lotwise.plans import deals, forest
from lotwise.sources.listings import drop_column

c = F.col


# junk that a cast alone would take for a number, put into some of the rows
_JUNK = ["12f", "12d", "NaN", "Infinity", "1e3x", "", "-", "1.5.2"]


def _messy(text):
    """``text`` with junk in every row whose likes are below the number of junk texts."""
    junk = F.element_at(F.array(*[F.lit(x) for x in _JUNK]), c("likes").cast("int") + 1)
    return F.when(c("likes") < len(_JUNK), junk).otherwise(text)


_CLEAN_ROWS = f"CASE WHEN likes >= {len(_JUNK)} THEN"


@query("clean_mileage", S.CLEAN + f"SELECT id, {_CLEAN_ROWS} mileage END AS mileage FROM cleaned")
def _(s):
    return s.raw.select("id", clean.clean_mileage(_messy(c("mileage_raw"))).alias("mileage"))


@query("clean_price", S.CLEAN + f"SELECT id, {_CLEAN_ROWS} price END AS price FROM cleaned")
def _(s):
    return s.raw.select("id", clean.clean_price(_messy(c("price_raw"))).alias("price"))


@query(
    "cast_cylinder",
    S.RAW
    + """, messy AS (SELECT id, CASE likes % 11 WHEN 0 THEN 'N/A' WHEN 1 THEN cylinder || '.0'
      ELSE CAST(cylinder AS VARCHAR) END AS text FROM listings)
    SELECT id, CAST(TRY_CAST(text AS DOUBLE) AS INT) AS cylinder FROM messy""",
)
def _(s):
    cyl, kind = c("cylinder").cast("string"), c("likes") % 11
    text = F.when(kind == 0, "N/A").when(kind == 1, F.concat(cyl, F.lit(".0"))).otherwise(cyl)
    return s.raw.select("id", clean.cast_cylinder(text).alias("cylinder"))


@query("parse_date_sold", S.CLEAN + "SELECT id, date_sold FROM cleaned")
def _(s):
    return s.raw.select("id", clean.parse_date_sold(c("time")).alias("date_sold"))


@query("parse_posted_hours", S.CLEAN + "SELECT id, rounded(posted_time, 6) AS posted_time FROM cleaned")
def _(s):
    return s.raw.select("id", r(clean.parse_posted_hours(c("time")), 6).alias("posted_time"))


@query("mileage_tier", S.CLEAN + "SELECT id, mileage_range FROM cleaned")
def _(s):
    tier = clean.mileage_tier(clean.clean_mileage(c("mileage_raw")), P.tier_width)
    return s.raw.select("id", tier.alias("mileage_range"))


@query("model_key", S.CLEAN + "SELECT id, model_key FROM cleaned")
def _(s):
    return s.raw.select("id", keys.model_key(c("make"), c("model")).alias("model_key"))


@query("trim_key", S.CLEAN + "SELECT id, trim_key FROM cleaned")
def _(s):
    return keys.with_keys(s.raw).select("id", "trim_key")


@query("year_key", S.KEEP + "SELECT id, year_key FROM kept")
def _(s):
    return s.kept.select("id", keys.year_key(c("trim_key"), c("year")).alias("year_key"))


@query("mileage_key", S.KEEP + "SELECT id, mileage_key FROM kept")
def _(s):
    key = keys.mileage_key(c("trim_key"), c("mileage_range"))
    return s.kept.select("id", key.alias("mileage_key"))


@query(
    "display_make_model",
    S.RAW + "SELECT make || '-' || model AS make_model, count(*) AS n FROM listings GROUP BY 1",
)
def _(s):
    label = keys.model_key(c("make"), c("model")).alias("make_model")
    return s.raw.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


@query("car_age", S.RAW + "SELECT id, CAST(2002 - year AS INT) AS car_age FROM listings")
def _(s):
    return s.raw.select("id", display.car_age(c("year"), P.age_year).alias("car_age"))


_EXPORT_SQL = """id AS "Id", link AS "Link", make AS "Make", model_key AS "Model", trim_key AS "Trim",
  year AS "Year", price AS "Price", mileage AS "Mileage", rounded(pred3, 2) AS "L_Predicted_Price",
  rounded(l_gap, 4) AS "L_Price_Gap_Percentage", rounded(avg_ymmt, 4) AS "Average_Year_per_Trim",
  rounded(avg_mileage_range_lr, 2) AS "Average_Milerange_per_Trim_Year_LR",
  rounded(price_pmmt, 2) AS "Average_Price_per_Trim", rounded(year_effect, 2) AS "Year_Effect",
  rounded(mileage_effect, 2) AS "Mileage_Effect" """

# decimals compared per export column
EXPORT_DIGITS = {
    "L_Predicted_Price": 2,
    "L_Price_Gap_Percentage": 4,
    "Average_Year_per_Trim": 4,
    "Average_Milerange_per_Trim_Year_LR": 2,
    "Average_Price_per_Trim": 2,
    "Year_Effect": 2,
    "Mileage_Effect": 2,
}


def rounded_export(df):
    return df.withColumns({k: r(k, d) for k, d in EXPORT_DIGITS.items()})


@query("select_rename", S.SCORED + f"SELECT {_EXPORT_SQL} FROM scored")
def _(s):
    return rounded_export(deals.select_rename(s.scored, deals.LINEAR_COLUMNS))


@query(
    "split_year_key",
    S.KEEP
    + """SELECT id, CAST(right(year_key, 4) AS INT) AS year2, left(year_key, length(year_key) - 5) AS trim_part
    FROM kept""",
)
def _(s):
    key = keys.year_key(c("trim_key"), c("year"))
    return s.kept.select(
        "id", keys.year_of_key(key).alias("year2"), keys.trim_of_key(key).alias("trim_part")
    )


@query(
    "format_thousands",
    S.KEEP + "SELECT id, format('{:,}', CAST(price AS BIGINT)) AS price_text, "
    "format('{:,.2f}', price / 7) AS part_text FROM kept",
)
def _(s):
    return s.kept.select(
        "id",
        display.format_thousands(c("price")).alias("price_text"),
        display.format_thousands(c("price") / 7, 2).alias("part_text"),
    )


@query(
    "reparse_round_format",
    S.KEEP
    + """SELECT id, format('{:,}', CAST(round_even(CAST(replace(format('{:,.2f}', price / 8), ',', '') AS DOUBLE), 0)
      AS BIGINT)) AS price_text FROM kept""",
)
def _(s):
    text = display.format_thousands(c("price") / 8, 2)
    return s.kept.select("id", display.reparse_round_format(text).alias("price_text"))


@query("reparse_mileage", S.KEEP + "SELECT id, mileage AS mileage2 FROM kept")
def _(s):
    text = display.format_thousands(c("mileage"))
    return s.kept.select("id", display.reparse_number(text).alias("mileage2"))


@query("drop_column", S.RAW + "SELECT id, make, model, trim, year FROM listings")
def _(s):
    rows = s.raw.select("id", "make", "model", "trim", "year", F.lit("").alias("car"))
    return drop_column(rows)


@query(
    "to_factor",
    S.KEEP
    + """SELECT id, CAST(dense_rank() OVER (ORDER BY make) - 1 AS DOUBLE) AS make_code,
      CAST(dense_rank() OVER (ORDER BY model_key) - 1 AS DOUBLE) AS model_key_code FROM kept""",
)
def _(s):
    coded = forest.to_factor(s.kept, ["make", "model_key"])
    return coded.select("id", "make_code", "model_key_code")


@query("abs_diff", S.SCORED + "SELECT id, rounded(absolute_difference, 2) AS absolute_difference FROM scored")
def _(s):
    return s.scored.select("id", r("absolute_difference").alias("absolute_difference"))


# --- filters -----------------------------------------------------------------------


@query("filter_price_cap", S.CLEAN + "SELECT id, price FROM cleaned WHERE price < 365000")
def _(s):
    return filters.filter_price_cap(s.cleaned, P).select("id", "price")


@query("filter_min_year", S.CLEAN + "SELECT id, year FROM cleaned WHERE year > 1995")
def _(s):
    return filters.filter_min_year(s.cleaned, P).select("id", "year")


@query("filter_price_present", S.CLEAN + "SELECT id, price FROM cleaned WHERE price IS NOT NULL")
def _(s):
    return filters.filter_price_present(s.cleaned).select("id", "price")


@query("filter_positive_price", S.CLEAN + "SELECT id, price FROM cleaned WHERE price > 0")
def _(s):
    return filters.filter_positive_price(s.cleaned).select("id", "price")


@query("filter_mileage_anomaly", S.CLEAN + "SELECT id, mileage FROM cleaned WHERE mileage <= 650000")
def _(s):
    return filters.filter_mileage_anomaly(s.cleaned, P).select("id", "mileage")


NTH_MAKE_SQL = "(SELECT make FROM {rows} GROUP BY make ORDER BY count(*) DESC, make LIMIT 1 OFFSET {skip})"


@query(
    "filter_make_model",
    S.KEEP
    + f"""SELECT id, make, model, year FROM kept
    WHERE make = {NTH_MAKE_SQL.format(rows="kept", skip=0)} AND model = 'ECONOMY'""",
)
def _(s):
    make = nth_most_frequent_make(s.kept, 1).scalar()
    return filters.filter_make_model(s.kept, make, "ECONOMY").select("id", "make", "model", "year")


_FULL_SQL = "listing_count > 10 AND l_gap > 20 AND date_sold = '' AND mileage < 80000"


@query("deal_filter_full", S.SCORED + f"SELECT id, rounded(l_gap, 4) AS l_gap FROM scored WHERE {_FULL_SQL}")
def _(s):
    return filters.deal_filter_full(s.scored, P).select("id", r("l_gap", 4).alias("l_gap"))


@query("deal_filter_recent", S.RECENT + "SELECT id, rounded(l_gap, 4) AS l_gap FROM scored WHERE l_gap > 10")
def _(s):
    return filters.deal_filter_recent(s.fresh_scored, P).select("id", r("l_gap", 4).alias("l_gap"))


@query("deal_filter_full_dual")
def _(s):
    scored = deals.with_both_gaps(forest.rf_predict(s.forest, s.scored), P)
    return filters.deal_filter_full_dual(scored, P).select("id", "l_gap", "r_gap")


@query("deal_filter_recent_dual")
def _(s):
    fresh = filters.in_trained_keys(s.fresh_scored, s.known)
    scored = deals.with_both_gaps(forest.rf_predict(s.known_forest, fresh), P)
    return filters.deal_filter_recent_dual(scored, P).select("id", "l_gap", "r_gap")


@query(
    "in_trained_keys",
    S.KNOWN
    + """SELECT id, trim_key, year FROM fresh WHERE trim_key IN (SELECT trim_key FROM known)
    AND year IN (SELECT year FROM known)""",
)
def _(s):
    return filters.in_trained_keys(s.fresh, s.known, check_year=True).select("id", "trim_key", "year")
