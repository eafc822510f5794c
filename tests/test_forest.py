from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lotwise.catalog.study import P
from lotwise.operators.filters import in_trained_keys
from lotwise.plans import deals, forest
from lotwise.workspace import new_path

SMALL = replace(P, rf_trees=5, rf_depth=5)


@pytest.fixture(scope="module")
def trained(study):
    return forest.rf_train(study.train, SMALL)


def test_better_than_the_constant(spark):
    """On prices that depend on trim, year and mileage; the order-line tables' prices do not."""
    rows = []
    for i in range(1200):
        trim, year, mileage = i % 7, 2014 + i % 6, float(i * 37 % 200) * 1000
        price = 50000.0 + 20000 * trim + 8000 * (year - 2014) - 0.2 * mileage
        rows.append((f"r{i}", "M", f"M-{trim % 3}", f"t{trim}", year, mileage, price))
    df = spark.createDataFrame(
        rows, "id string, make string, model_key string, trim_key string, year int, mileage double, price double"
    )
    folds = forest.with_fold(df, 5, replace(P, seed=9))
    model = forest.rf_train(folds.filter("fold > 0").drop("fold"), P)
    held = folds.filter("fold = 0").drop("fold")
    row = forest.rf_metrics(forest.rf_predict(model, held), "held out").first()
    assert row["rmse"] < 0.6 * held.agg(F.stddev_pop("price")).first()[0]
    assert 0.7 < row["r2"] < 1 and row["mae"] < row["rmse"] and row["split"] == "held out"


def test_saved_forest_scores_the_same(spark, study, trained):
    path = new_path(spark, "forest")
    trained.save(path)
    again = forest.Forest.load(spark, path)
    rows = study.fresh
    one, two = (
        {r["id"]: r[forest.PREDICTION] for r in forest.rf_predict(m, rows).collect()} for m in (trained, again)
    )
    assert one == two and len(one) == rows.count() and None not in one.values()


def test_cross_validation_is_not_in_sample(spark, study):
    cv = forest.rf_cross_validate(study.kept_table, SMALL, trees=(2, 4), subsets=("2",))
    rows = forest.cross_validation_table(cv).collect()
    assert len(rows) == 2 and sum(r["best"] for r in rows) == 1


def test_folds_do_not_depend_on_partitions(study):
    one, two = (
        {(r["id"], r["fold"]) for r in forest.with_fold(study.kept_table.repartition(k), 3, P).select("id", "fold").collect()}
        for k in (2, 5)
    )
    assert one == two and {f for _, f in one} == {0, 1, 2}


def test_level_codes_of_any_number(spark, study):
    coded = forest.to_factor(study.kept_table.select("id"), ["id"]).collect()
    order = {x: i for i, x in enumerate(sorted(r["id"] for r in coded))}
    assert all(r["id_code"] == order[r["id"]] for r in coded)
    holes = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "x string")
    assert sorted((r["x"] or "", r["x_code"]) for r in forest.to_factor(holes, ["x"]).collect()) == [
        ("", 2.0), ("a", 0.0), ("b", 1.0), ("b", 1.0)
    ]
    assert forest.to_factor(holes.limit(0), ["x"]).count() == 0


def test_a_row_does_not_see_its_own_price(spark):
    rows = [(f"r{i}", "M", "M-1", f"t{i}", 2014, None if i % 3 else 1.0, float(i)) for i in range(90)]
    df = spark.createDataFrame(
        rows, "id string, make string, model_key string, trim_key string, year int, mileage double, price double"
    )
    ready, e = forest.training_rows(df, P)
    got = ready.collect()
    assert len(got) == 90
    # every trim is met once, so its mean over the other folds is the overall mean
    assert {round(r["trim_key_mean"], 6) for r in got} == {round(e.price, 6)}
    for f in {r["fold"] for r in got}:
        others = [r["price"] for r in got if r["fold"] != f]
        mean = (sum(others) + e.price * P.rf_prior_rows) / (len(others) + P.rf_prior_rows)
        assert all(r["make_mean"] == pytest.approx(mean) for r in got if r["fold"] == f)
    assert {(r["mileage_known"], r["mileage_filled"]) for r in got} == {(0.0, 1.0), (1.0, 1.0)}
    unseen = df.limit(1).selectExpr("id", "'new' AS make", "model_key", "'new' AS trim_key", "year", "mileage", "price")
    (row,) = forest.encoded(forest.with_year2(unseen), e, own_fold=False).collect()
    assert row["make_mean"] == e.price and row["trim_key_mean"] == e.price


def test_dual_deals_agree(study, trained):
    scored = deals.with_both_gaps(forest.rf_predict(trained, in_trained_keys(study.fresh_scored, study.known)), P)
    rows = deals.deals_recent_dual(scored, P).collect()
    assert rows and set(rows[0].asDict()) == set(deals.DUAL_COLUMNS)
    for r in rows:
        assert r["L_Price_Gap_Percentage"] > 10 and r["R_Price_Gap_Percentage"] > 10
        gap = (r["R_Predicted_Price"] - r["Price"]) / r["Price"] * 100
        assert r["R_Price_Gap_Percentage"] == pytest.approx(gap)
    assert deals.deal_short_table_dual(deals.deals_recent_dual(scored, P)).count() == len(rows)
