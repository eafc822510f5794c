"""What a forest is grown on does not depend on how many rows there are."""

from dataclasses import replace

import pytest
from paths import SF
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from lotwise.catalog.study import P, Study
from lotwise.plans import forest
from lotwise.workspace import stored

MANY = 2_000_100  # beyond the number from which rows were merged by themselves


@pytest.fixture(scope="module")
def many(spark):
    """One row in a hundred has a mileage, of 1 to 8; from 5 on the price is another."""
    mileage = F.when(F.col("id") % 100 == 0, F.floor(F.col("id") / 100) % 8 + 1).otherwise(0).cast("double")
    rows = spark.range(MANY).select(
        F.concat(F.lit("r"), F.col("id")).alias("id"),
        *[F.lit(x).alias(x) for x in ("make", "model_key", "trim_key")],
        F.lit(2014).alias("year"),
        mileage.alias("mileage"),
    )
    return stored(rows.withColumn("price", F.when(F.col("mileage") >= 5, 9e4).otherwise(1e4)), "many")


@pytest.mark.parametrize("encoding", ["means", "onehot"])
def test_every_row_keeps_its_own_mileage(spark, many, encoding):
    """Steps of the mileage that hold equally many rows would take all these for one."""
    model = forest.rf_train(many, replace(P, rf_trees=2, rf_depth=2, rf_encoding=encoding), "all")
    assert not any(isinstance(s, Bucketizer) for s in model.model.stages)
    asked = many.filter("mileage IN (4, 5)").dropDuplicates(["mileage"])
    got = {r["mileage"]: r[forest.PREDICTION] for r in forest.rf_predict(model, asked).collect()}
    assert got == {4.0: pytest.approx(1e4), 5.0: pytest.approx(9e4)}


def test_no_query_lets_the_size_choose_its_forest(spark, many, monkeypatch):
    met = []
    monkeypatch.setattr(forest, "rf_train", lambda df, p: met.append(p))
    s = Study(spark, SF)
    assert [s.forest, s.onehot_forest, s.known_forest] == [None] * 3 and len(met) == 3
    assert not any(forest._merging(many, p) for p in met)
