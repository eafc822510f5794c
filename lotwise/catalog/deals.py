"""Gaps, explanations and the composed deal recommendations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lotwise.catalog import sql as S
from lotwise.catalog.registry import query
from lotwise.catalog.scalars import _EXPORT_SQL, _FULL_SQL, rounded_export
from lotwise.catalog.rounding import r
from lotwise.catalog.study import P
from lotwise.functions import pricing
from lotwise.functions.clean import parse_posted_hours
from lotwise.operators import groups, rank
from lotwise.operators.filters import in_trained_keys
from lotwise.plans import deals, forest
from lotwise.sources.listings import RAW_COLUMNS
from lotwise.sources.sinks import sink_csv
from lotwise.streaming.recent import recent_deals_to, scored_stream
from lotwise.workspace import new_path

c = F.col

_DEALS = f""", deal AS (SELECT * FROM (SELECT * FROM scored WHERE {_FULL_SQL})
  QUALIFY rank() OVER (PARTITION BY trim_key ORDER BY l_gap DESC) <= 2) """


@query(
    "price_gap",
    S.SCORED
    + """SELECT id, rounded(price_difference, 2) AS price_difference,
    rounded(price_difference / price * 100, 4) AS percentage_difference FROM scored""",
)
def _(s):
    return s.scored.select(
        "id",
        r("price_difference").alias("price_difference"),
        r(pricing.gap_percent(c("pred3"), c("price")), 4).alias("percentage_difference"),
    )


@query("gap_deadband", S.SCORED + "SELECT id, rounded(l_gap, 4) AS l_gap FROM scored")
def _(s):
    return s.scored.select("id", r("l_gap", 4).alias("l_gap"))


@query("price_gap_rf")
def _(s):
    scored = deals.with_forest_gap(forest.rf_predict(s.forest, s.kept_table), P)
    return scored.select("id", "price_difference_rf", "r_gap")


@query(
    "explain_effects",
    S.SCORED
    + """SELECT id, rounded(year_effect, 2) AS year_effect, rounded(mileage_effect, 2) AS mileage_effect
    FROM scored""",
)
def _(s):
    return s.scored.select("id", *[r(k).alias(k) for k in ("year_effect", "mileage_effect")])


@query("deals_full_linear", S.SCORED + _DEALS + f"SELECT {_EXPORT_SQL} FROM deal")
def _(s):
    return rounded_export(deals.sorted_deals(deals.deals_full_linear(s.scored, P)))


@query("deals_recent_linear", S.RECENT + f"SELECT {_EXPORT_SQL} FROM scored WHERE l_gap > 10")
def _(s):
    return rounded_export(deals.sorted_deals(deals.deals_recent_linear(s.fresh_scored, P)))


@query("deals_recent_stream", S.RECENT + f"SELECT {_EXPORT_SQL} FROM scored WHERE l_gap > 10")
def _(s):
    """The fresh scrape lands as three files; the stream stops after two and goes on from its checkpoint."""
    root = new_path(s.spark, "landing")
    names = {ours: theirs for theirs, ours in RAW_COLUMNS.items()}
    raw = s.raw.filter(parse_posted_hours(c("time")).isNotNull()).withColumn("car", F.lit(""))
    part = F.pmod(F.xxhash64("id"), F.lit(3))
    for landed in ((0, 1), (2,)):
        for k in landed:
            sink_csv(raw.filter(part == k).select(*[c(n).alias(theirs) for n, theirs in names.items()]), f"{root}/in/{k}")
        scored = scored_stream(s.spark, f"{root}/in/*", s.known_model, P)
        query = recent_deals_to(f"{root}/out", f"{root}/state", scored, P)
        query.awaitTermination()
    return rounded_export(deals.sorted_deals(s.spark.read.parquet(f"{root}/out")))


@query("deals_full_dual")
def _(s):
    scored = deals.with_both_gaps(forest.rf_predict(s.forest, s.scored), P)
    return deals.sorted_deals(deals.deals_full_dual(scored, P), "R_Price_Gap_Percentage")


@query("deals_recent_dual")
def _(s):
    fresh = in_trained_keys(s.fresh_scored, s.known)
    scored = deals.with_both_gaps(forest.rf_predict(s.known_forest, fresh), P)
    return deals.sorted_deals(deals.deals_recent_dual(scored, P), "R_Price_Gap_Percentage")


@query(
    "deal_short_table",
    S.SCORED
    + _DEALS
    + """SELECT trim_key AS "Trim", year AS "Year", format('{:,}', CAST(mileage AS BIGINT)) AS "Mileage",
    format('{:,}', CAST(price AS BIGINT)) AS "Price",
    format('{:,}', CAST(round_even(pred3, 0) AS BIGINT)) AS "Pred_Price",
    format('{:,}', CAST(round_even(l_gap, 0) AS BIGINT)) AS "Gap_Perc"
    FROM deal QUALIFY row_number() OVER (PARTITION BY trim_key ORDER BY l_gap DESC, id) = 1""",
)
def _(s):
    return deals.deal_short_table(deals.deals_full_linear(s.scored, P))


def _status(s):
    """What became of the listings, as typed by hand: words in mixed case, two listings in
    three at all, some twice with two dates, some dates that are none."""
    word = F.when(c("year") % 2 == 0, " Sold").otherwise("sold")
    day = F.concat((c("id_num") % 28 + 1).cast("string"), F.lit("-Apr-24"))
    lines = s.kept.filter("likes % 3 > 0").select(
        c("id").alias("Id"),
        F.when(c("personal") == "F", word).otherwise("no").alias("status"),
        F.when(c("likes") % 7 == 1, F.lit("soon")).otherwise(day).alias("Sold Date"),
        "likes",
    )
    again = lines.filter("likes % 2 = 0").withColumns({"status": F.lit("SOLD "), "Sold Date": F.lit("30-Apr-24")})
    return lines.unionByName(again).drop("likes")


_OUTCOME = """, outcome AS (SELECT *, likes % 3 > 0 AND (personal = 'F' OR likes % 2 = 0) AS sold,
    least(CASE WHEN likes % 3 > 0 AND personal = 'F' AND likes % 7 <> 1
      THEN make_date(2024, 4, CAST(id_num % 28 + 1 AS INT)) END,
      CASE WHEN likes % 3 > 0 AND likes % 2 = 0 THEN DATE '2024-04-30' END) AS sold_on FROM deal)
    """


@query(
    "outcome_backtest",
    S.SCORED
    + _DEALS
    + _OUTCOME
    + """SELECT count(*) AS recommended, count(*) FILTER (sold) AS sold,
    rounded(avg(CASE WHEN sold THEN 1.0 ELSE 0.0 END), 6) AS hit_rate FROM outcome""",
)
def _(s):
    out = deals.outcome_backtest(deals.deals_full_linear(s.scored, P), _status(s))
    return out.withColumn("hit_rate", r("hit_rate", 6))


@query(
    "outcome_rows_guarded",
    S.SCORED
    + _DEALS
    + _OUTCOME
    + """SELECT id AS "Id", sold, CAST(sold_on AS VARCHAR) AS sold_on,
    CAST(date_diff('day', DATE '2024-04-09', sold_on) AS INT) AS days_to_sale
    FROM outcome WHERE price >= 0.4 * price_pmmt""",
)
def _(s):
    found = deals.deals_full_linear(s.scored, P)
    out = deals.outcome_rows(found, _status(s), guard=0.4, recommended_on=date(2024, 4, 9))
    return out.select("Id", "sold", c("sold_on").cast("string").alias("sold_on"), "days_to_sale")


# --- two models: the second prediction is one that SQL can follow --------------------


def _second(scored):
    """Scored rows whose second prediction is that of the trim level, taken with caution.

    The factor also keeps means of a few whole prices off the halves of a whole number."""
    return deals.with_both_gaps(scored.withColumn(forest.PREDICTION, c("stage_trim") * 0.9713), P)


_SECOND = """, other AS (SELECT *, stage_trim * CAST(0.9713 AS DOUBLE) AS second FROM scored),
    two AS (SELECT *, second - price AS difference, CASE WHEN (second - price) / price * 100 BETWEEN -0.01 AND 0.01
      THEN 0 ELSE (second - price) / price * 100 END AS r_gap FROM other)"""
_DUAL_SQL = (
    _EXPORT_SQL
    + """, rounded(second, 2) AS "R_Predicted_Price", rounded(r_gap, 4) AS "R_Price_Gap_Percentage" """
)
_FULL_DUAL = f"""{_SECOND}, dual AS (SELECT * FROM (SELECT * FROM two WHERE {_FULL_SQL} AND r_gap > 20)
  QUALIFY rank() OVER (PARTITION BY trim_key ORDER BY r_gap DESC) <= 2) """
_RECENT_DUAL = f"""{_SECOND}, dual AS (SELECT * FROM two WHERE l_gap > 10 AND r_gap > 10
  AND trim_key IN (SELECT trim_key FROM known)) """


def _rounded_dual(df):
    extra = {"R_Predicted_Price": 2, "R_Price_Gap_Percentage": 4}
    return rounded_export(df).withColumns({k: r(k, d) for k, d in extra.items()})


@query(
    "price_gap_second",
    S.SCORED + _SECOND + "SELECT id, rounded(difference, 2) AS price_difference_rf, rounded(r_gap, 4) AS r_gap FROM two",
)
def _(s):
    out = _second(s.scored)
    return out.select("id", r("price_difference_rf").alias("price_difference_rf"), r("r_gap", 4).alias("r_gap"))


@query(
    "deal_filter_full_second",
    S.SCORED + _SECOND + f"SELECT id, rounded(r_gap, 4) AS r_gap FROM two WHERE {_FULL_SQL} AND r_gap > 20",
)
def _(s):
    out = deals.filters.deal_filter_full_dual(_second(s.scored), P)
    return out.select("id", r("r_gap", 4).alias("r_gap"))


@query("deal_filter_recent_second", S.RECENT + _RECENT_DUAL + "SELECT id, rounded(r_gap, 4) AS r_gap FROM dual")
def _(s):
    rows = _second(in_trained_keys(s.fresh_scored, s.known))
    return deals.filters.deal_filter_recent_dual(rows, P).select("id", r("r_gap", 4).alias("r_gap"))


@query("deals_full_second", S.SCORED + _FULL_DUAL + f"SELECT {_DUAL_SQL} FROM dual")
def _(s):
    out = deals.deals_full_dual(_second(s.scored), P)
    return _rounded_dual(deals.sorted_deals(out, "R_Price_Gap_Percentage"))


@query("deals_recent_second", S.RECENT + _RECENT_DUAL + f"SELECT {_DUAL_SQL} FROM dual")
def _(s):
    out = deals.deals_recent_dual(_second(in_trained_keys(s.fresh_scored, s.known)), P)
    return _rounded_dual(deals.sorted_deals(out, "R_Price_Gap_Percentage"))


def _text(column: str) -> str:
    return f"format('{{:,}}', CAST(round_even({column}, 0) AS BIGINT))"


@query(
    "deal_short_table_dual",
    S.SCORED
    + _FULL_DUAL
    + f"""SELECT trim_key AS "Trim", year AS "Year", format('{{:,}}', CAST(mileage AS BIGINT)) AS "Mileage",
    format('{{:,}}', CAST(price AS BIGINT)) AS "Price", {_text("pred3")} AS "L_Price",
    {_text("second")} AS "R_Price", {_text("r_gap")} AS "R_Gap" FROM dual""",
)
def _(s):
    return deals.deal_short_table_dual(deals.deals_full_dual(_second(s.scored), P))


@query(
    "deals_by_gap",
    S.SCORED
    + _DEALS
    + 'SELECT id AS "Id", rounded(l_gap, 4) AS "L_Price_Gap_Percentage" FROM deal ORDER BY 2 DESC, 1',
)
def _(s):
    gap = "L_Price_Gap_Percentage"
    out = deals.deals_by_gap(deals.deals_full_linear(s.scored, P), gap)
    return out.select("Id", r(gap, 4).alias(gap))


@query(
    "deals_vs_trim_mean",
    S.KEEP
    + """, gaps AS (SELECT id, trim_key, price, mileage, date_sold, count(*) OVER w AS listing_count,
      (avg(price) OVER w - price) / price * 100 AS gap FROM kept WINDOW w AS (PARTITION BY trim_key)),
    good AS (SELECT * FROM gaps WHERE gap > 20 AND listing_count > 10 AND date_sold = '' AND mileage < 80000)
    SELECT id, trim_key, price, rounded(gap, 4) AS gap FROM good
    QUALIFY rank() OVER (PARTITION BY trim_key ORDER BY gap DESC) <= 2""",
)
def _(s):
    return deals_vs_trim_mean(s.kept_table)


def deals_vs_trim_mean(kept):
    """The smallest deal report: listings far below the mean price of their trim."""
    stats = {"price_pmmt": F.avg("price"), "listing_count": F.count(F.lit(1))}
    rows = groups.with_group_stats(kept, ["trim_key"], stats)
    gap = pricing.price_gap(c("price_pmmt"), c("price"), P)
    rows = rows.withColumn("l_gap", gap)
    good = deals.filters.deal_filter_full(rows, P).select("id", "trim_key", "price", c("l_gap").alias("gap"))
    best = rank.top_n_with_ties(good, ["trim_key"], "gap", P.top_per_trim)
    return best.withColumn("gap", r("gap", 4))
