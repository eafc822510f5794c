"""Profiles, group statistics, sorts, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.catalog import sql as S
from lotwise.catalog.registry import query
from lotwise.catalog.scalars import NTH_MAKE_SQL
from lotwise.catalog.rounding import r
from lotwise.catalog.study import P
from lotwise.operators import filters, groups, profile, rank, sketches
from lotwise.plans.evaluate import metrics_log, rmse_ladder, stage_errors, validation_score
from lotwise.plans.scoring import score
from lotwise.workspace import new_path, stored, stored_lookup

c = F.col


@query(
    "row_count",
    S.CLEAN
    + """SELECT count(*) AS rows_raw, count(*) FILTER (price < 365000) AS rows_under_cap,
    count(*) FILTER (price < 365000 AND year > 1995) AS rows_recent_years,
    count(*) FILTER (price < 365000 AND year > 1995 AND price IS NOT NULL) AS rows_kept FROM cleaned""",
)
def _(s):
    return profile.filter_funnel(s.cleaned, P)


@query(
    "year_frequency",
    S.CLEAN
    + "SELECT year, count(*) AS n FROM cleaned WHERE price < 365000 GROUP BY year ORDER BY n DESC, year LIMIT 20",
)
def _(s):
    return profile.year_frequency(filters.filter_price_cap(s.cleaned, P), 20)


@query("nth_most_frequent_make", S.KEEP + f"SELECT {NTH_MAKE_SQL.format(rows='kept', skip=1)} AS make")
def _(s):
    return profile.nth_most_frequent_make(s.kept, 2)


@query(
    "make_share",
    S.KEEP
    + """SELECT make, n, rounded(share, 6) AS share FROM (SELECT make, count(*) AS n,
    count(*) / (SELECT count(*) FROM kept) * 100 AS share FROM kept GROUP BY make) WHERE share > 3""",
)
def _(s):
    return profile.make_share(s.kept_table).withColumn("share", r("share", 6))


@query(
    "count_make_model_year",
    S.KEEP
    + f"""SELECT make, model, year, count(*) AS n FROM kept
    WHERE make = {NTH_MAKE_SQL.format(rows="kept", skip=0)} GROUP BY ALL
    UNION ALL SELECT make, model, year, count(*) AS n FROM kept
    WHERE make = {NTH_MAKE_SQL.format(rows="kept", skip=1)} GROUP BY ALL""",
)
def _(s):
    first, second = (profile.count_make_model_year(s.kept_table, k) for k in (1, 2))
    return first.unionByName(second)


@query(
    "count_by_trim_year",
    S.KEEP
    + f"""SELECT make, model, year, trim, count(*) AS n FROM kept
    WHERE make = {NTH_MAKE_SQL.format(rows="kept", skip=0)} AND model = 'ECONOMY' GROUP BY ALL""",
)
def _(s):
    return profile.count_by_trim_year(s.kept_table, 1, "ECONOMY")


@query(
    "mean_price_by_age",
    S.KEEP + "SELECT CAST(2002 - year AS INT) AS car_age, rounded(avg(price), 2) AS mean_price FROM kept GROUP BY 1",
)
def _(s):
    return profile.mean_price_by_age(s.kept, P).withColumn("mean_price", r("mean_price"))


@query(
    "likes_by_model",
    S.KEEP + "SELECT make, model, CAST(sum(likes) AS BIGINT) AS total_likes FROM kept GROUP BY ALL",
)
def _(s):
    return profile.likes_by_model(s.kept)


def _histogram_sql(rows: str, value: str, bins: int) -> str:
    return f"""
ends AS (SELECT min({value}) AS lo, max({value}) AS hi FROM {rows}),
slots AS (SELECT least(CAST(floor({bins} * ({value} - lo) / (hi - lo)) AS INT) + 1, {bins}) AS bin,
  count(*) AS n FROM {rows}, ends GROUP BY 1),
hist AS (SELECT CAST(g.bin AS INT) AS bin, rounded(lo + (g.bin - 1) * ((hi - lo) / {bins}), 4) AS bin_from,
  rounded(lo + g.bin * ((hi - lo) / {bins}), 4) AS bin_to, coalesce(n, 0) AS n
  FROM range(1, {bins} + 1) g(bin) LEFT JOIN slots USING (bin), ends)"""


def _rounded_bins(df):
    return df.withColumns({k: r(k, 4) for k in ("bin_from", "bin_to")})


@query(
    "price_histogram",
    S.CLEAN
    + """, positive AS (SELECT price FROM cleaned WHERE price > 0),
    capped AS (SELECT price FROM cleaned WHERE price < 365000)"""
    + "".join(
        f", {name} AS (WITH {_histogram_sql(rows, 'price', 40)} SELECT * FROM hist)"
        for name, rows in (("all_hist", "positive"), ("cap_hist", "capped"))
    )
    + """ SELECT 'all' AS chart, * FROM all_hist UNION ALL SELECT 'capped', * FROM cap_hist""",
)
def _(s):
    charts = {"all": c("price") > 0, "capped": c("price") < P.price_cap}
    prices = stored(s.cleaned.select("price"), "prices")
    return _rounded_bins(profile.histograms(prices, "price", 40, charts))


@query(
    "effect_histogram",
    S.MODEL
    + "".join(
        f", {name}_h AS (WITH {_histogram_sql(rows, value, 30)} SELECT * FROM hist)"
        for name, rows, value in (
            ("make", "make_e", "b_make"),
            ("model", "model_e", "b_model"),
            ("trim", "trim_e", "b_trim"),
            ("year", "year_e", "b_year"),
        )
    )
    + " UNION ALL ".join(
        f" SELECT '{k}' AS effect, * FROM {k}_h" for k in ("make", "model", "trim", "year")
    ),
)
def _(s):
    m = s.model
    parts = [
        _rounded_bins(profile.histogram(df, value, 30)).withColumn("effect", F.lit(name))
        for name, df, value in (
            ("make", m.make, "b_make"),
            ("model", m.model, "b_model"),
            ("trim", m.trim, "b_trim"),
            ("year", m.trim_year, "b_year"),
        )
    ]
    return rank.union_rows(*parts)


@query(
    "mileage_boxplot_by_year",
    S.KEEP
    + """, m AS (SELECT year, mileage FROM kept WHERE mileage <= 650000),
    q AS (SELECT year, quantile_cont(mileage, 0.25) AS q1, quantile_cont(mileage, 0.5) AS median,
      quantile_cont(mileage, 0.75) AS q3 FROM m GROUP BY year),
    f AS (SELECT m.*, q1, median, q3,
      mileage BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside FROM m JOIN q USING (year))
    SELECT year, q1, median, q3, min(mileage) FILTER (inside) AS whisker_low,
      max(mileage) FILTER (inside) AS whisker_high, count(*) AS n,
      count(*) FILTER (NOT inside) AS n_outliers FROM f GROUP BY ALL""",
)
def _(s):
    return profile.mileage_boxplot_by_year(s.kept_table, P)


@query(
    "mileage_sketch_by_year",
    S.KEEP
    + """, m AS (SELECT year, mileage FROM kept WHERE mileage <= 650000 OR mileage IS NULL)
    SELECT year, p, count(mileage) AS n, count(*) - count(mileage) AS nulls, min(mileage) AS low, max(mileage) AS high,
      TRUE AS within_error FROM m, (VALUES (0.25::DOUBLE), (0.5), (0.75)) q(p) GROUP BY year, p HAVING count(mileage) > 0""",
)
def _(s):
    # three batches, each read once for its sketches; the exact places are counted beside
    rows = s.kept_table.filter(c("mileage").isNull() | (c("mileage") <= P.mileage_limit)).select("id", "year", "mileage")
    path = new_path(s.spark, "mileage_sketches")
    for batch in range(3):
        sketches.add_batch(path, f"scrape{batch}", rows.filter(F.pmod(F.xxhash64("id"), F.lit(3)) == batch), "mileage", ["year"])
    merged = stored(sketches.merged(s.spark, path, ["year"]), "merged_sketches")
    points = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), sketches.quantile(p).alias("q")) for p in (0.25, 0.5, 0.75)]))
    points = merged.filter("n > 0").select(*("year", "n", "nulls", "low", "high"), points.alias("x"))
    points = stored_lookup(points.select(*("year", "n", "nulls", "low", "high"), "x.p", "x.q"), "sketch_points")
    counts = profile.value_counts(rows, "mileage", ["year"])
    met = counts.withColumnRenamed("n", "k").join(points, "year").groupBy("year", "p", "n", "nulls", "low", "high")
    found = met.agg(F.sum(F.when(c("value") < c("q"), c("k")).otherwise(0)).alias("below"), F.sum(F.when(c("value") <= c("q"), c("k")).otherwise(0)).alias("upto"))
    e = sketches.rank_error()
    within = (c("below") <= (c("p") + e) * c("n")) & (c("upto") >= (c("p") - e) * c("n"))
    return found.select("year", "p", "n", "nulls", "low", "high", within.alias("within_error"))


def _summary_sql(rows: str, value: str, name: str) -> str:
    stats = {
        "min": f"min({value})",
        "q1": f"quantile_cont({value}, 0.25)",
        "median": f"quantile_cont({value}, 0.5)",
        "mean": f"avg({value})",
        "q3": f"quantile_cont({value}, 0.75)",
        "max": f"max({value})",
        "nulls": f"CAST(count(*) FILTER ({value} IS NULL) AS DOUBLE)",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS what, '{k}' AS stat, rounded({v}, 2) AS value FROM {rows}" for k, v in stats.items()
    )


@query(
    "five_number_summary",
    S.SCORED
    + ", typed_prices AS (SELECT price FROM cleaned WHERE price IS NULL OR price < 365000) "
    + _summary_sql("typed_prices", "price", "price")
    + " UNION ALL "
    + _summary_sql("scored", "pred3", "prediction"),
)
def _(s):
    prices = s.cleaned.filter(c("price").isNull() | (c("price") < P.price_cap))
    price = profile.five_number_summary(prices, "price").withColumn("what", F.lit("price"))
    pred = profile.five_number_summary(s.scored, "pred3").withColumn("what", F.lit("prediction"))
    return price.unionByName(pred).withColumn("value", r("value"))


_PROFILED = ["id", "make", "trim_key", "year", "price", "mileage", "mileage_range", "date_sold", "posted_time"]


@query(
    "null_profile",
    S.KEEP
    + " UNION ALL ".join(
        f"SELECT '{k}' AS column_name, count(*) FILTER ({k} IS NULL) AS nulls FROM kept" for k in _PROFILED
    ),
)
def _(s):
    return profile.null_profile(s.kept.select(*_PROFILED))


_TYPES = {"id": "string", "make": "string", "year": "int", "likes": "bigint", "price": "double", "mileage": "double"}


@query(
    "schema_profile",
    S.KEEP
    + " UNION ALL ".join(
        f"SELECT '{k}' AS column_name, '{t}' AS data_type, count({k}) AS filled, "
        f"min(CAST({k} AS VARCHAR)) AS example FROM kept"
        for k, t in _TYPES.items()
    ),
)
def _(s):
    return profile.schema_profile(s.kept.select(*_TYPES))


# --- group statistics --------------------------------------------------------------


@query(
    "trim_mean_year",
    S.KEEP + "SELECT id, rounded(avg(year) OVER (PARTITION BY trim_key), 6) AS avg_ymmt FROM kept",
)
def _(s):
    return groups.with_trim_means(s.kept_table).select("id", r("avg_ymmt", 6).alias("avg_ymmt"))


@query(
    "trim_mean_price",
    S.KEEP + "SELECT id, rounded(avg(price) OVER (PARTITION BY trim_key), 2) AS price_pmmt FROM kept",
)
def _(s):
    return groups.with_trim_means(s.kept_table).select("id", r("price_pmmt").alias("price_pmmt"))


@query(
    "year_mean_mileage",
    S.KEEP
    + """SELECT id, CASE WHEN count(mileage) OVER w = count(*) OVER w
    THEN rounded(avg(mileage) OVER w + 1, 2) END AS avg_mileage FROM kept WINDOW w AS (PARTITION BY year)""",
)
def _(s):
    return groups.with_year_means(s.kept_table).select("id", r("avg_mileage").alias("avg_mileage"))


@query(
    "year_mean_price",
    S.KEEP + "SELECT id, rounded(avg(price) OVER (PARTITION BY year), 2) AS price_pmmty FROM kept",
)
def _(s):
    return groups.with_year_means(s.kept_table).select("id", r("price_pmmty").alias("price_pmmty"))


@query("tbl_trim_mean_year", S.KEEP + "SELECT trim_key, rounded(avg(year), 6) AS avg_ymmt FROM kept GROUP BY 1")
def _(s):
    return groups.trim_mean_year_table(s.kept).withColumn("avg_ymmt", r("avg_ymmt", 6))


_TIER = "CASE WHEN count(mileage_range) {w} = count(*) {w} THEN rounded(avg(mileage_range) {w}, 2) END"


@query(
    "row_mean_mileage_tier",
    S.KEEP
    + f"SELECT id, {_TIER.format(w='OVER w')} AS avg_mileage_range FROM kept WINDOW w AS (PARTITION BY trim_key, year)",
)
def _(s):
    out = groups.with_mean_mileage_tier(s.kept_table)
    return out.select("id", r("avg_mileage_range").alias("avg_mileage_range"))


@query(
    "tbl_mean_mileage_tier",
    S.KEEP + f"SELECT trim_key, year, {_TIER.format(w='')} AS avg_mileage_range FROM kept GROUP BY 1, 2",
)
def _(s):
    return groups.mileage_tier_table(s.kept).withColumn("avg_mileage_range", r("avg_mileage_range"))


@query("tbl_trim_mean_price", S.KEEP + "SELECT trim_key, rounded(avg(price), 2) AS price_pmmt FROM kept GROUP BY 1")
def _(s):
    return groups.trim_mean_price_table(s.kept).withColumn("price_pmmt", r("price_pmmt"))


@query(
    "tbl_trim_year_mean_price",
    S.KEEP + "SELECT trim_key, year, rounded(avg(price), 2) AS price_pmmty FROM kept GROUP BY 1, 2",
)
def _(s):
    return groups.trim_year_price_table(s.kept).withColumn("price_pmmty", r("price_pmmty"))


@query(
    "tbl_trim_year_mean_mileage",
    S.KEEP
    + """SELECT trim_key, year, CASE WHEN count(mileage) = count(*)
    THEN rounded(avg(mileage) + 1, 2) END AS avg_mileage FROM kept GROUP BY 1, 2""",
)
def _(s):
    return groups.trim_year_mileage_table(s.kept).withColumn("avg_mileage", r("avg_mileage"))


@query(
    "pred_mean_by_trim",
    S.SCORED
    + """, means AS (SELECT id, price_pmmt, CASE WHEN count(pred3) OVER w = count(*) OVER w
      THEN avg(pred3) OVER w END AS mean FROM scored WINDOW w AS (PARTITION BY trim_key))
    SELECT id, rounded(mean, 2) AS pred3_pmmt, rounded(price_pmmt - mean, 2) AS pmmt_difference,
      rounded((price_pmmt - mean) / price_pmmt * 100, 4) AS pmmt_absolute FROM means""",
)
def _(s):
    out = groups.with_trim_prediction_mean(s.scored)
    digits = {"pred3_pmmt": 2, "pmmt_difference": 2, "pmmt_absolute": 4}
    return out.select("id", *[r(k, d).alias(k) for k, d in digits.items()])


@query(
    "trim_listing_count",
    S.KEEP + "SELECT id, count(*) OVER (PARTITION BY trim_key) AS listing_count FROM kept",
)
def _(s):
    return groups.with_listing_count(s.kept_table).select("id", "listing_count")


@query("distinct_rows", S.KEEP + "SELECT DISTINCT make, model_key, trim_key, year FROM kept")
def _(s):
    return groups.distinct_rows(s.kept.select("make", "model_key", "trim_key", "year"))


@query(
    "loess_mean_price",
    S.KEEP
    + """, curve AS (SELECT 2002 - year AS car_age, avg(price) AS mean_price FROM kept GROUP BY 1),
    size AS (SELECT greatest(3, CAST(ceil(count(*) * CAST(0.75 AS DOUBLE)) AS INT)) AS q FROM curve),
    near AS (SELECT a.car_age, a.mean_price, b.car_age - a.car_age AS x, b.mean_price AS y,
      abs(b.car_age - a.car_age) AS d,
      row_number() OVER (PARTITION BY a.car_age ORDER BY abs(b.car_age - a.car_age), b.car_age) AS k
      FROM curve a CROSS JOIN curve b),
    used AS (SELECT near.*, max(d) OVER (PARTITION BY car_age) AS h FROM near, size WHERE k <= q),
    weighed AS (SELECT *, CASE WHEN h = 0 THEN 1.0::DOUBLE ELSE pow(1 - pow(CAST(d AS DOUBLE) / h, 3), 3) END AS w FROM used),
    sums AS (SELECT car_age, mean_price, sum(w) AS s, sum(w * x) AS sx, sum(w * y) AS sy,
      sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM weighed GROUP BY 1, 2)
    SELECT CAST(car_age AS INT) AS car_age, rounded(mean_price, 2) AS mean_price,
      rounded(CASE WHEN s * sxx - sx * sx > 1e-9
        THEN (sy - (s * sxy - sx * sy) / (s * sxx - sx * sx) * sx) / s ELSE sy / s END, 2) AS smoothed FROM sums""",
)
def _(s):
    out = profile.loess_mean_price(profile.mean_price_by_age(s.kept_table, P), span=0.75)
    return out.withColumns({k: r(k) for k in ("mean_price", "smoothed")})


@query(
    "mileage_axis_stats",
    S.KEEP + "SELECT count(DISTINCT year) AS n_years, max(mileage) AS max_mileage FROM kept",
)
def _(s):
    return profile.mileage_axis_stats(s.kept)


@query("year_mileage_points", S.KEEP + "SELECT id, year, mileage FROM kept WHERE mileage <= 650000")
def _(s):
    return profile.year_mileage_points(s.kept, P)


# --- sorts, top-k, set operations --------------------------------------------------


@query("sort_trim_gap", S.SCORED + "SELECT trim_key, rounded(l_gap, 4) AS l_gap, id FROM scored ORDER BY 1, 2 DESC, 3")
def _(s):
    rows = s.scored.select("trim_key", r("l_gap", 4).alias("l_gap"), "id")
    return rank.sort_trim_gap(rows, "l_gap")


@query(
    "top_n_per_trim",
    S.KEEP
    + """, gaps AS (SELECT id, trim_key, rounded((avg(price) OVER (PARTITION BY trim_key) - price) / price * 100, 4)
      AS gap FROM kept)
    SELECT * FROM gaps QUALIFY rank() OVER (PARTITION BY trim_key ORDER BY gap DESC) <= 2""",
)
def _(s):
    gap = (c("price_pmmt") - c("price")) / c("price") * 100
    rows = groups.with_trim_means(s.kept_table).select("id", "trim_key", r(gap, 4).alias("gap"))
    return rank.top_n_with_ties(rows, ["trim_key"], "gap", P.top_per_trim)


@query(
    "first_per_trim",
    S.KEEP
    + """SELECT id, trim_key, price FROM kept
    QUALIFY row_number() OVER (PARTITION BY trim_key ORDER BY price DESC, id) = 1""",
)
def _(s):
    return rank.first_per_group(s.kept.select("id", "trim_key", "price"), "trim_key", "price")


_LIKED = """SELECT make || '-' || model AS make_model, CAST(sum(likes) AS BIGINT) AS total_likes FROM kept
  GROUP BY make, model ORDER BY sum(likes) DESC, make, model LIMIT 10"""


@query("top_10_liked_models", S.KEEP + _LIKED)
def _(s):
    return rank.top_liked_models(s.kept, 10)


@query(
    "ordered_labels",
    S.KEEP
    + f"""SELECT make_model, total_likes, CAST(row_number() OVER (ORDER BY total_likes DESC, make_model) AS INT)
    AS place FROM ({_LIKED})""",
)
def _(s):
    return rank.ordered_labels(rank.top_liked_models(s.kept, 10), "make_model", "total_likes")


@query("row_at_end", S.KEEP + "SELECT id, id_num, price FROM kept ORDER BY id_num DESC LIMIT 1")
def _(s):
    return rank.last_row(s.kept.select("id", "id_num", "price"), "id_num")


@query(
    "union_rows",
    S.SPLIT
    + """SELECT split, count(*) AS n, CAST(sum(price) AS DOUBLE) AS total FROM (
    SELECT * FROM split WHERE split = 'train' UNION ALL SELECT * FROM split WHERE split <> 'train') GROUP BY 1""",
)
def _(s):
    train, rest = s.train, s.split.filter(c("split") != "train")
    both = rank.union_rows(train, rest)
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("total"))


def _rmse_sql(column: str, split: str) -> str:
    mean = f"(SELECT avg({column}) FROM scored WHERE split = '{split}')"
    return f"(SELECT sqrt(avg(pow(price - coalesce({column}, {mean}), 2))) FROM scored WHERE split = '{split}')"


_STAGES = [
    ("Make Effect", "stage_make"),
    ("Make + Model Effect", "stage_model"),
    ("Make + Model + Trim Effect", "stage_trim"),
    ("Make + Model + Trim + Year Effect", "stage_year"),
    ("Make + Model + Trim + Year + Mileage Effect", "pred3"),
]
LADDER_SQL = (
    S.SCORED
    + ", errors AS (SELECT 0 AS stage, 'Overall Average' AS method, 'train' AS split, "
    "(SELECT sqrt(avg(pow(price - mu, 2))) FROM fit_rows, mu) AS rmse"
    + "".join(
        f" UNION ALL SELECT {i}, '{label}', 'test', {_rmse_sql(col, 'test')}"
        for i, (label, col) in enumerate(_STAGES, 1)
    )
    + """), ladder AS (SELECT CAST(stage AS INT) AS stage, method AS method_on_train_test, split, rounded(rmse, 2) AS rmse,
    rounded(coalesce(lag(rmse) OVER (ORDER BY stage) - rmse, 0), 2) AS improvement FROM errors),
    validation AS (SELECT 'Method 01 - Linear Regression' AS method_on_validation, 'validation' AS split,
    """
    + f"rounded({_rmse_sql('pred3', 'validation')}, 2) AS rmse, "
    + f"rounded({_rmse_sql('pred3', 'test')} - {_rmse_sql('pred3', 'validation')}, 2) AS improvement) "
)


def _rounded_errors(df):
    return df.withColumns({k: r(k) for k in ("rmse", "improvement")})


@query(
    "union_missing_columns",
    LADDER_SQL + "SELECT * FROM ladder UNION ALL BY NAME SELECT * FROM validation",
)
def _(s):
    return _rounded_errors(metrics_log(stage_errors(s.split, s.model, P)))


@query("rmse_ladder", LADDER_SQL + "SELECT * FROM ladder")
def _(s):
    return _rounded_errors(rmse_ladder(stage_errors(s.split, s.model, P)))


@query("validation_score", LADDER_SQL + "SELECT * FROM validation")
def _(s):
    return _rounded_errors(validation_score(stage_errors(s.split, s.model, P)))


@query(
    "missing_trims",
    S.KNOWN + "SELECT DISTINCT trim_key FROM fresh WHERE trim_key NOT IN (SELECT trim_key FROM known)",
)
def _(s):
    return rank.missing_trims(s.fresh, s.known)


@query(
    "missing_years",
    S.KNOWN + "SELECT DISTINCT year FROM fresh WHERE year NOT IN (SELECT year FROM known WHERE year < 2001)",
)
def _(s):
    # as if trained a year earlier, so that the fresh listings have a year it never saw
    return rank.missing_years(s.fresh, s.known.filter(c("year") < 2001))


@query(
    "mileage_outliers_by_year",
    S.KEEP
    + """, m AS (SELECT year, mileage FROM kept WHERE mileage <= 650000),
    q AS (SELECT year, quantile_cont(mileage, 0.25) AS q1, quantile_cont(mileage, 0.75) AS q3 FROM m GROUP BY year)
    SELECT year, mileage, count(*) AS n FROM m JOIN q USING (year)
    WHERE mileage NOT BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 GROUP BY ALL""",
)
def _(s):
    return profile.mileage_outliers_by_year(s.kept_table, P)


@query(
    "year_mileage_correlation",
    S.KEEP + "SELECT rounded(corr(year, mileage), 6) AS correlation FROM kept WHERE mileage <= 650000",
)
def _(s):
    return profile.year_mileage_correlation(s.kept, P).select(r("correlation", 6).alias("correlation"))


@query("head_rows", S.KEEP + "SELECT id, price FROM kept ORDER BY price, id LIMIT 6")
def _(s):
    return profile.head_rows(s.kept.select("id", "price"), 6, "price", "id")
