"""Lookups, split, fit, prediction, evaluation, forest."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.catalog import sql as S
from lotwise.catalog.registry import query
from lotwise.catalog.sources import CARS, CARS_SQL
from lotwise.catalog.rounding import SNAP, r
from lotwise.catalog.study import P
from lotwise.functions.keys import with_keys
from lotwise.operators import split as split_ops
from lotwise.operators.rank import union_rows
from lotwise.plans import effects, evaluate, forest, scoring
from lotwise.sources import tpch
from lotwise.sources.listings import literal_rows

c = F.col


def _rounded(df, *columns: str, digits: int = 2, snap: int = SNAP):
    return df.select(*[r(k, digits, snap).alias(k) if k in columns else c(k) for k in df.columns])


# --- lookups -----------------------------------------------------------------------


@query(
    "left_join_make_effect",
    S.MODEL + "SELECT id, make, rounded(b_make, 2) AS b_make FROM split LEFT JOIN make_e USING (make)",
)
def _(s):
    return _rounded(scoring.join_make_effect(s.split.select("id", "make"), s.model), "b_make")


@query(
    "left_join_model_effect",
    S.MODEL + "SELECT id, model_key, rounded(b_model, 2) AS b_model FROM split LEFT JOIN model_e USING (model_key)",
)
def _(s):
    return _rounded(scoring.join_model_effect(s.split.select("id", "model_key"), s.model), "b_model")


@query(
    "left_join_trim_effect",
    S.MODEL + "SELECT id, trim_key, rounded(b_trim, 2) AS b_trim FROM split LEFT JOIN trim_e USING (trim_key)",
)
def _(s):
    return _rounded(scoring.join_trim_effect(s.split.select("id", "trim_key"), s.model), "b_trim")


@query(
    "left_join_year_line",
    S.MODEL
    + "SELECT id, trim_key, rounded(a, 1, 2) AS a, rounded(b, 4) AS b FROM split LEFT JOIN year_l USING (trim_key)",
)
def _(s):
    out = scoring.join_year_line(s.split.select("id", "trim_key"), s.model)
    return _rounded(_rounded(out, "a", digits=1, snap=2), "b", digits=4)


@query(
    "left_join_mileage_line",
    S.MODEL
    + "SELECT id, trim_key, rounded(aa, 1, 2) AS aa, rounded(bb, 4) AS bb FROM split LEFT JOIN tier_l USING (trim_key)",
)
def _(s):
    out = scoring.join_mileage_line(s.split.select("id", "trim_key"), s.model)
    return _rounded(_rounded(out, "aa", digits=1, snap=2), "bb", digits=4)


@query(
    "left_join_group_stats",
    S.RECENT
    + """SELECT id, rounded(trim_s.price_pmmt, 2) AS price_pmmt, rounded(trim_s.avg_ymmt, 6) AS avg_ymmt,
    rounded(avg_mileage_range, 2) AS avg_mileage_range
    FROM fresh LEFT JOIN trim_s USING (trim_key) LEFT JOIN tier_e USING (trim_key, year)""",
)
def _(s):
    out = scoring.join_group_stats(s.fresh, s.known_model)
    return out.select(
        "id",
        r("price_pmmt").alias("price_pmmt"),
        r("avg_ymmt", 6).alias("avg_ymmt"),
        r("avg_mileage_range").alias("avg_mileage_range"),
    )


def _first_round(s):
    return split_ops.stratified_holdout(
        s.kept_table, P.validation_share, P, tpch.order_bucket()
    )


@query(
    "semi_join_chain",
    S.SPLIT + "SELECT id, trim_key FROM round_1 WHERE out_1",
)
def _(s):
    held = _first_round(s)
    out = split_ops.semi_join_chain(held.filter("held_out"), held.filter("NOT held_out"))
    return out.select("id", "trim_key")


@query("anti_join_natural", S.SPLIT + "SELECT id, trim_key FROM round_1 WHERE picked_1 AND NOT out_1")
def _(s):
    held = _first_round(s)
    kept = split_ops.semi_join_chain(held.filter("held_out"), held.filter("NOT held_out"))
    removed = split_ops.anti_join_natural(held.filter("held_out"), kept)
    return removed.select("id", "trim_key")


@query("scalar_cross_join", S.MODEL + "SELECT id, rounded(price - mu, 2) AS off_mean FROM split, mu")
def _(s):
    mu = s.train.agg(F.avg("price")).scalar()
    return s.split.select("id", r(c("price") - mu).alias("off_mean"))


# --- split -------------------------------------------------------------------------


@query("stratified_split", S.SPLIT + "SELECT stratum_1 AS stratum, picked_1 AS held_out, id FROM round_1")
def _(s):
    rows = s.kept_table
    breaks, cuts = split_ops.holdout_rule(rows, P.validation_share, P, tpch.order_bucket())
    held = split_ops.in_holdout(rows, breaks, cuts, P, tpch.order_bucket())
    return rows.select(split_ops.stratum(breaks).alias("stratum"), held.alias("held_out"), "id")


@query("split_with_coverage", S.SPLIT + "SELECT id, split FROM split")
def _(s):
    out = split_ops.split_with_coverage(s.kept_table, P, tpch.order_bucket())
    return out.select("id", "split")


@query(
    "random_sample",
    S.KEEP + "SELECT id, price, trim_key FROM kept ORDER BY (id_num * 7919 + 123) % 10007, id LIMIT 1000",
)
def _(s):
    sample = split_ops.random_sample(s.kept, 1000, P, order=tpch.order_bucket())
    return sample.select("id", "price", "trim_key")


@query(
    "random_half",
    S.KEEP + "SELECT id, price FROM kept ORDER BY (id_num * 7919 + 123) % 10007, id LIMIT (SELECT count(*) // 2 FROM kept)",
)
def _(s):
    half = s.kept_table.count() // 2
    return split_ops.random_sample(s.kept_table, half, P, order=tpch.order_bucket()).select("id", "price")


# --- fit ---------------------------------------------------------------------------


@query(
    "overall_mean",
    S.MODEL + "SELECT rounded(mu, 2) AS mu, (SELECT rounded(stddev_pop(price), 2) FROM fit_rows) AS rmse FROM mu",
)
def _(s):
    return _rounded(evaluate.overall_rmse(s.split), "mu", "rmse")


@query("make_effect", S.MODEL + "SELECT make, rounded(b_make, 2) AS b_make FROM make_e")
def _(s):
    return _rounded(s.model.make, "b_make")


@query("model_effect", S.MODEL + "SELECT model_key, rounded(b_model, 2) AS b_model FROM model_e")
def _(s):
    return _rounded(s.model.model, "b_model")


@query("trim_effect", S.MODEL + "SELECT trim_key, rounded(b_trim, 2) AS b_trim FROM trim_e")
def _(s):
    trained = s.model.trim.filter(c("b_trim").isNotNull())
    return _rounded(trained.select("trim_key", "b_trim"), "b_trim")


@query("year_effect", S.MODEL + "SELECT trim_key, year, rounded(b_year, 2) AS b_year FROM year_e")
def _(s):
    trained = s.model.trim_year.filter(c("b_year").isNotNull())
    return _rounded(trained.select("trim_key", "year", "b_year"), "b_year")


@query("year_line", S.MODEL + "SELECT trim_key, rounded(a, 1, 2) AS a, rounded(b, 4) AS b FROM year_l")
def _(s):
    trained = s.model.trim.filter(c("a").isNotNull()).select("trim_key", "a", "b")
    return _rounded(_rounded(trained, "a", digits=1, snap=2), "b", digits=4)


@query(
    "year_line_check",
    S.MODEL
    + """SELECT trim_key, year, rounded(b_year, 2) AS b_year, rounded(a + b * year, 2) AS b_year_line
    FROM year_e JOIN year_l USING (trim_key)""",
)
def _(s):
    out = effects.year_line_check(s.model).drop("a", "b")
    return _rounded(out, "b_year", "b_year_line")


@query("mileage_line", S.MODEL + "SELECT trim_key, rounded(aa, 1, 2) AS aa, rounded(bb, 4) AS bb FROM tier_l")
def _(s):
    lines = s.model.trim.select("trim_key", "aa", "bb")
    return _rounded(_rounded(lines, "aa", digits=1, snap=2), "bb", digits=4)


@query(
    "mileage_line_check",
    S.MODEL
    + """SELECT trim_key, year, rounded(avg_mileage_range, 2) AS avg_mileage_range,
    rounded(CASE WHEN aa + bb * year > 0 THEN aa + bb * year WHEN aa + bb * year <= 0 THEN 0 END, 2)
      AS avg_mileage_range_line FROM tier_e JOIN tier_l USING (trim_key)""",
)
def _(s):
    out = effects.mileage_line_check(s.model).drop("aa", "bb")
    return _rounded(out, "avg_mileage_range", "avg_mileage_range_line")


# --- predict -----------------------------------------------------------------------


@query("year_fallback", S.SCORED + "SELECT id, rounded(price_year_value, 2) AS price_year_value FROM scored")
def _(s):
    return _rounded(s.scored.select("id", "price_year_value"), "price_year_value")


@query("predict_additive", S.SCORED + "SELECT id, rounded(pred1, 2) AS pred1 FROM scored")
def _(s):
    return _rounded(s.scored.select("id", "pred1"), "pred1")


@query("mileage_adjust", S.SCORED + "SELECT id, rounded(pred2, 2) AS pred2 FROM scored")
def _(s):
    return _rounded(s.scored.select("id", "pred2"), "pred2")


@query("price_floor", S.SCORED + "SELECT id, rounded(pred3, 2) AS pred3 FROM scored")
def _(s):
    return _rounded(s.scored.select("id", "pred3"), "pred3")


@query(
    "impute_missing_prediction",
    S.SCORED
    + """, tests AS (SELECT id, pred3 FROM scored WHERE split = 'test')
    SELECT id, rounded(coalesce(pred3, (SELECT avg(pred3) FROM tests)), 2) AS pred3 FROM tests""",
)
def _(s):
    tests = s.scored.filter(c("split") == "test").select("id", "pred3")
    return _rounded(evaluate.impute_missing_prediction(tests, "pred3"), "pred3")


@query(
    "rmse",
    S.SCORED + "SELECT split, rounded(sqrt(avg(pow(price - pred3, 2))), 2) AS rmse FROM scored GROUP BY split",
)
def _(s):
    return s.scored.groupBy("split").agg(r(evaluate.rmse("price", "pred3")).alias("rmse"))


@query(
    "score_user_input",
    S.chain(
        S.LISTINGS, S.CLEANED, S.KEPT, S.split_of("kept"), S.effects_of("kept"), CARS_SQL,
        S.scored_of("keyed_cars"),
    )
    + """SELECT trim_key, year, mileage, rounded(pred3, 2) AS pred3, rounded(year_effect, 2) AS year_effect,
    rounded(mileage_effect, 2) AS mileage_effect FROM scored""",
)
def _(s):
    out = scoring.score(with_keys(literal_rows(s.spark, CARS)), s.model, P)
    out = out.select("trim_key", "year", "mileage", "pred3", "year_effect", "mileage_effect")
    return _rounded(out, "pred3", "year_effect", "mileage_effect")


# --- forest ------------------------------------------------------------------------


@query(
    "rf_features",
    S.KEEP
    + "SELECT price, make, model_key, trim_key, CAST(year AS VARCHAR) AS year2, mileage FROM kept",
)
def _(s):
    return forest.rf_features(s.kept)


@query("rf_train")
def _(s):
    rows = [(t.numNodes, t.depth) for t in s.forest.trees]
    return s.spark.createDataFrame(rows, "nodes int, depth int")


@query("rf_cross_validate")
def _(s):
    cv = forest.rf_cross_validate(s.kept_table, P, trees=(P.rf_trees,), subsets=("onethird",))
    return forest.cross_validation_table(cv)


@query("rf_grid")
def _(s):
    return forest.cross_validation_table(forest.rf_cross_validate(s.kept_table, P))


@query("rf_metrics")
def _(s):
    held_out = forest.rf_train(s.train, P)
    validation = s.split.filter(c("split") == "validation")
    return forest.rf_metrics(forest.rf_predict(s.forest, s.kept_table), "in-sample").unionByName(
        forest.rf_metrics(forest.rf_predict(held_out, validation), "validation")
    )


@query(
    "metrics_of_prediction",
    S.SCORED
    + """SELECT 'Method 02 - Random Forest' AS method_on_validation, 'all' AS split,
    rounded(sqrt(avg(pow(price - stage_make, 2))), 2) AS rmse, rounded(pow(corr(price, stage_make), 2), 6) AS r2,
    rounded(avg(abs(price - stage_make)), 2) AS mae FROM scored""",
)
def _(s):
    # the forest's measures on a prediction that SQL can follow
    out = forest.rf_metrics(s.scored, "all", "stage_make")
    return out.withColumns({"rmse": r("rmse"), "r2": r("r2", 6), "mae": r("mae")})


@query(
    "rf_predict",
    S.KEEP + "SELECT id, price, TRUE AS predicted, TRUE AS within_prices FROM kept",
)
def _(s):
    # which prices come out is the library's matter; that every row has one, within the
    # range of the training prices, is not
    ends = s.kept_table.agg(F.min("price").alias("lo"), F.max("price").alias("hi")).first()
    out = forest.rf_predict(s.forest, s.kept_table)
    y = c(forest.PREDICTION)
    return out.select("id", "price", y.isNotNull().alias("predicted"), y.between(ends["lo"], ends["hi"]).alias("within_prices"))


@query(
    "rf_beats_constant",
    S.KEEP + "SELECT count(*) AS n, TRUE AS in_sample_better FROM kept",
)
def _(s):
    out = forest.rf_predict(s.forest, s.kept_table)
    error = F.avg(F.pow(c("price") - c(forest.PREDICTION), 2))
    return out.agg(F.count(F.lit(1)).alias("n"), (error < F.var_pop("price")).alias("in_sample_better"))


@query(
    "onehot_levels",
    S.KEEP
    + "".join(
        f"""{' UNION ALL ' if i else ''}SELECT DISTINCT '{name}' AS predictor, level,
    CAST(place - 2 AS BIGINT) AS code FROM (SELECT {level} AS level, dense_rank() OVER (ORDER BY {level}) AS place FROM kept
    WHERE {level} IS NOT NULL) WHERE place > 1"""
        for i, (name, level) in enumerate(
            [("make", "make"), ("model_key", "model_key"), ("trim_key", "trim_key"), ("year2", "CAST(year AS VARCHAR)")]
        )
    ),
)
def _(s):
    tables = s.onehot_forest.encoding.tables
    parts = [t.select(F.lit(name).alias("predictor"), "level", c("code").cast("bigint").alias("code")) for name, t in tables.items()]
    return union_rows(*parts)


@query(
    "rf_onehot",
    S.KEEP
    + """, n AS (SELECT count(DISTINCT make) + count(DISTINCT model_key) + count(DISTINCT trim_key) + count(DISTINCT year) - 2 AS k
    FROM kept) SELECT id, price, TRUE AS predicted, TRUE AS within_prices, CAST(k AS INTEGER) AS n_features FROM kept, n""",
)
def _(s):
    # k levels of each text predictor are k - 1 features; beside them the mileage and its flag
    ends = s.kept_table.agg(F.min("price").alias("lo"), F.max("price").alias("hi")).first()
    out = forest.rf_predict(s.onehot_forest, s.kept_table)
    y, n = c(forest.PREDICTION), F.lit(s.onehot_forest.n_features).cast("int")
    return out.select(
        *("id", "price"),
        y.isNotNull().alias("predicted"),
        y.between(ends["lo"], ends["hi"]).alias("within_prices"),
        n.alias("n_features"),
    )


@query("encoded_levels", S.KEEP + """, m AS (SELECT avg(price) AS mu FROM kept)
    SELECT trim_key, rounded((sum(price) + 10 * max(mu)) / (count(*) + 10), 2) AS mean FROM kept, m GROUP BY trim_key""")
def _(s):
    levels = s.forest.encoding.levels["trim_key"].filter("fold IS NULL")
    return levels.select(c("level").alias("trim_key"), r("mean").alias("mean"))
