"""What lets the listing queries grow: prices worked out once, rows not moved, merged forests."""

import random
from dataclasses import replace

import pytest
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from lotwise.catalog.study import P
from lotwise.functions import clean
from lotwise.plans import forest
from lotwise.sources import tpch
from lotwise.workspace import new_path

SCHEMA = "id string, make string, model_key string, trim_key string, year int, mileage double, price double"
MANY = replace(P, rf_trees=6, rf_depth=4, rf_rows=400)


def test_a_number_is_worked_out_from_one_copy_of_its_text(spark):
    df = spark.createDataFrame([("12",)], "t string")
    shown = df.select(clean.clean_price(F.concat(F.col("t"), F.lit("one copy"))).alias("p"))._jdf.queryExecution().analyzed().toString()
    assert shown.count("one copy") == 1
    texts = ["1,234", " 7. ", ".5e1\n", "12 ", "NaN", "1f", "", "x", None, "5 5", "-3\r\n"]
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select(clean.clean_price(F.col("t"))).collect()
    assert [r[0] for r in rows] == [1234.0, 7.0, 5.0, None, None, None, None, None, None, None, -3.0]


def test_rows_are_moved_only_where_files_are_few(spark):
    root = new_path(spark, "tables")
    cores = spark.sparkContext.defaultParallelism
    line = spark.range(2000).selectExpr(
        "id AS l_orderkey", "1 AS l_linenumber", "id % 9 AS l_partkey", "id AS l_suppkey", "1.0D AS l_quantity",
        "2.0D AS l_extendedprice", "0.0D AS l_discount", "0.0D AS l_tax", "'A' AS l_returnflag", "'F' AS l_linestatus",
        "timestamp_ntz'1999-01-01 00:00:00' AS l_shipdate",
    )
    part = spark.range(9).selectExpr("id AS p_partkey", "'b' AS p_brand", "'t' AS p_type", "3 AS p_size")
    for name, files in (("one", 1), ("many", 8 * cores)):
        line.repartition(files).write.parquet(f"{root}/{name}/lineitem.parquet")
        part.write.parquet(f"{root}/{name}/part.parquet")
        df = tpch.listings(spark, f"{root}/{name}", spread_out=True)
        moved = "l_orderkey" in "".join(x for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Repartition" in x)
        few = spark.read.parquet(f"{root}/{name}/lineitem.parquet").rdd.getNumPartitions() < cores
        assert moved == few and df.count() == 2000
        assert few or name == "many"


def _rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        trim, year = rng.randrange(6), 2014 + rng.randrange(3)
        mileage = None if i % 17 == 0 else float(rng.randrange(3)) * 1000
        out.append((f"r{i}", f"m{trim % 2}", f"k{trim % 3}", f"t{trim}", year, mileage, 3e4 + 2e4 * trim + rng.random() * 1e3))
    return out


def test_merged_rows_hold_every_row(spark):
    rows = _rows(3000)
    df = spark.createDataFrame(rows, SCHEMA)
    out = forest.merged(df, forest.mileage_steps(df, MANY), MANY).collect()
    assert len(out) < len(rows) and sum(r["_rows"] for r in out) == len(rows)
    assert sum(r["_rows"] * r["price"] for r in out) == pytest.approx(sum(r[-1] for r in rows))
    squares = sum(r["_rows"] * r["price"] ** 2 + r["_spread"] for r in out)
    assert squares == pytest.approx(sum(r[-1] ** 2 for r in rows))
    assert sum(r["_rows"] for r in out if r["mileage_step"] is None) == sum(r[5] is None for r in rows)


@pytest.mark.parametrize("encoding", ["means", "onehot"])
def test_a_forest_of_many_rows_is_grown_on_merged_ones(spark, encoding):
    df = spark.createDataFrame(_rows(3000), SCHEMA)
    p = replace(MANY, rf_encoding=encoding)
    model, plain = forest.rf_train(df, p), forest.rf_train(df, replace(p, rf_rows=10_000))
    assert isinstance(model.model.stages[0], Bucketizer) and not isinstance(plain.model.stages[0], Bucketizer)
    assert model.n_features == plain.n_features and len(model.trees) == 6
    scores = [forest.rf_metrics(forest.rf_predict(m, df), "all").first()["rmse"] for m in (model, plain)]
    # two draws of six shallow trees: both find the prices, they need not agree closely
    assert all(x < 0.6 * df.agg(F.stddev_pop("price")).first()[0] for x in scores)
    path = new_path(spark, "forest")
    model.save(path)
    again = forest.Forest.load(spark, path)
    want = {r["id"]: r[forest.PREDICTION] for r in forest.rf_predict(model, df).collect()}
    assert {r["id"]: r[forest.PREDICTION] for r in forest.rf_predict(again, df).collect()} == want
    assert len(want) == 3000 and None not in want.values()


def test_errors_of_merged_rows_are_those_of_the_rows(spark):
    df = spark.createDataFrame(_rows(3000), SCHEMA)
    cv = forest.rf_cross_validate(df, MANY, trees=(2, 4), subsets=("3",))
    assert [s[:2] for s in cv.scores] == [(2, "3"), (4, "3")]
    # two or four trees that try three features: the prices are found, if not to the last
    assert all(s[2] < 0.2 * df.agg(F.stddev_pop("price")).first()[0] for s in cv.scores)
    steps = forest.mileage_steps(df, MANY)
    both = [steps.transform(df), forest.merged(df, steps, MANY)]
    rows = [x.withColumn("features", F.expr("1")) for x in both]
    blocks = [_Constant(5e4), _Constant(7e4)]
    errors = [forest.prefix_errors(x, blocks, [1, 2]) for x in rows]
    assert errors[0] == pytest.approx(errors[1])


class _Constant(forest.SQLTransformer):
    made = 0

    def __init__(self, value):
        super().__init__(statement=f"SELECT *, {value}D AS block_{_Constant.made % 2} FROM __THIS__")
        _Constant.made += 1
