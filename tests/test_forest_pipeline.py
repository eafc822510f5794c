"""Encodings inside the pipeline, grids scored by prefixes, one-hot features."""

import random
from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from lotwise.catalog.study import P
from lotwise.plans import forest
from lotwise.plans.encoding import LevelCodes, LevelMeans
from lotwise.workspace import new_path, stored

SCHEMA = "id string, make string, model_key string, trim_key string, year int, mileage double, price double"
SMALL = replace(P, rf_trees=4, rf_depth=4, rf_parallel=2)


def _rows(n, price, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        trim, year = rng.randrange(n // 3), 2014 + i % 5
        make = None if i % 41 == 0 else f"m{trim % 4}"
        mileage = None if i % 17 == 0 else float(rng.randrange(200)) * 1000
        out.append((f"r{i}", make, f"m{trim % 4}-{trim % 9}", f"t{trim}", year, mileage, price(trim, year, rng)))
    return out


def test_no_held_out_price_reaches_the_encoding(spark):
    """Prices that depend on nothing: trims of three rows would give each other's price away."""
    df = spark.createDataFrame(_rows(600, lambda t, y, rng: rng.choice([1e4, 1e5])), SCHEMA)
    cv = forest.rf_cross_validate(df, replace(SMALL, rf_repeats=2), trees=(4,), subsets=("onethird",))
    constant = df.agg(F.stddev_pop("price")).first()[0]
    assert len(cv.scores) == 1 and cv.scores[0][2] > 0.98 * constant


def test_prices_that_depend_on_the_predictors_are_found(spark):
    df = spark.createDataFrame(_rows(600, lambda t, y, rng: 3e4 + 2e4 * (t % 4) + 5e3 * (y - 2014)), SCHEMA)
    for encoding in ("means", "onehot"):
        p = replace(SMALL, rf_encoding=encoding, rf_depth=8, rf_trees=10)
        cv = forest.rf_cross_validate(df, p, trees=(10,), subsets=("onethird",))
        assert cv.scores[0][2] < 0.8 * df.agg(F.stddev_pop("price")).first()[0]


def test_prefixes_are_forests_of_the_same_trees(spark, study):
    rows = study.kept_table.limit(800)
    df = stored(forest.with_fold(rows, 3, SMALL, forest.TRAINING_FOLD), "rows")
    features = forest.fit_features(df, SMALL)
    ready = stored(PipelineModel(features).transform(df).select("price", "features"), "ready")
    sizes = forest.block_sizes([2, 6, 3])
    assert sizes == [2, 1, 3]
    blocks = forest._fit_blocks(ready, SMALL, sizes, "2")
    got = forest.prefix_errors(ready, blocks, sizes)
    apart = []
    for place, n in enumerate(sizes):
        grower = RandomForestRegressor(
            labelCol="price", numTrees=n, maxDepth=4, maxBins=P.rf_bins, featureSubsetStrategy="2", seed=P.seed + place
        )
        apart.append(grower.fit(ready))
    for k, trees in enumerate((2, 3, 6)):
        scored = ready
        for i, model in enumerate(apart[: k + 1]):
            scored = model.setPredictionCol(f"p{i}").transform(scored)
        mean = sum(n * F.col(f"p{i}") for i, n in enumerate(sizes[: k + 1])) / trees
        want = scored.agg(F.sqrt(F.avg(F.pow(F.col("price") - mean, 2)))).first()[0]
        assert got[k] == pytest.approx(want, rel=1e-9)


def test_grid_has_every_setting_and_refits_the_best(spark, study):
    rows = study.kept_table.limit(600)
    cv = forest.rf_cross_validate(rows, SMALL, trees=(4, 2, 3), subsets=("2", "3"))
    assert [s[:2] for s in cv.scores] == [(n, s) for n in (2, 3, 4) for s in ("2", "3")]
    best = cv.refit()
    assert len(best.trees) == cv.best[0]
    table = forest.cross_validation_table(cv).collect()
    assert sum(r["best"] for r in table) == 1


@pytest.mark.parametrize("encoding", ["means", "onehot"])
def test_saved_pipeline_scores_raw_rows(spark, encoding):
    df = spark.createDataFrame(_rows(300, lambda t, y, rng: 1e4 * (t % 4) + y), SCHEMA)
    model = forest.rf_train(df, replace(SMALL, rf_encoding=encoding))
    path = new_path(spark, "forest")
    model.save(path)
    again = PipelineModel.load(path)
    raw = df.drop("price").withColumn("make", F.when(F.col("id") == "r5", "never seen").otherwise(F.col("make")))
    want = {r["id"]: r[forest.PREDICTION] for r in forest.rf_predict(model, raw).collect()}
    got = {r["id"]: r[forest.PREDICTION] for r in again.transform(raw).collect()}
    assert got == want and len(want) == 300 and None not in want.values()


def test_one_hot_vectors(spark):
    rows = [("a", "x", "k", "t1", 2014, 1.0, 5.0), ("b", "y", "k", "t2", 2015, None, 6.0), ("c", "z", "k", "t1", 2014, 3.0, 7.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    stages = forest.fit_features(df, replace(P, rf_encoding="onehot"))
    codes = stages[1]
    # k levels are k - 1 features, as in a model formula; one level is none
    assert codes.features() == {"make": 2, "model_key": 0, "trim_key": 1, "year2": 1}
    new = df.union(spark.createDataFrame([("d", "w", None, "t9", 1999, None, 0.0), ("e", None, "k", "t2", 2015, 4.0, 0.0)], SCHEMA))
    got = {r["id"]: r["features"].toArray().tolist() for r in PipelineModel(stages).transform(new).collect()}
    assert got == {
        "a": [0, 0, 0, 0, 1, 1],
        "b": [1, 0, 1, 1, 0, 2],
        "c": [0, 1, 0, 0, 1, 3],
        "d": [0, 0, 0, 0, 0, 2],
        "e": [0, 0, 1, 1, 1, 4],
    }
    model = forest.rf_train(df, replace(SMALL, rf_encoding="onehot"))
    assert model.n_features == 6
    every = LevelCodes(inputCols=["make"], dropFirst=False).fit(df)
    assert every.features() == {"make": 3}


def test_estimators_are_saved_with_their_settings(spark):
    path = new_path(spark, "estimator")
    LevelMeans(inputCols=["make"], foldCol="f", priorRows=3.0).save(path)
    again = LevelMeans.load(path)
    assert again.getOrDefault("inputCols") == ["make"] and again.getOrDefault("priorRows") == 3.0


def test_unknown_encoding_is_an_error(spark):
    df = spark.createDataFrame(_rows(30, lambda t, y, rng: 1.0), SCHEMA)
    with pytest.raises(ValueError, match="encoding"):
        forest.rf_train(df, replace(SMALL, rf_encoding="ordinal"))
