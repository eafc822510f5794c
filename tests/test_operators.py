"""Quantiles, ranking and split against brute force, with skewed data."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise import workspace
from lotwise.operators import profile, rank, split
from lotwise.operators.quantiles import exact_quantiles
from lotwise.params import Params

P = Params(order_buckets=17)


@pytest.mark.parametrize("seed, n", [(1, 1), (2, 2), (3, 101), (4, 2000)])
def test_quantiles_match_numpy(spark, seed, n):
    rng = random.Random(seed)
    # one value held by about a third of the rows
    data = {g: [777.0 if rng.random() < 0.34 else round(rng.uniform(0, 5000), 1) for _ in range(n)] for g in (1, 2)}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs] + [(1, None)], "g int, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    # fractions of a unit and millions: ranges follow the data
    for scale in (1e-6, 1.0, 1e6):
        scaled = df.withColumn("v", F.col("v") * scale)
        got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(scaled, "v", probs, ["g"]).collect()}
        for g, vs in data.items():
            for p in probs:
                assert got[g, p] == pytest.approx(np.quantile(vs, p) * scale)
    one = {r["p"]: r["q"] for r in exact_quantiles(df.filter("g = 1"), "v", probs).collect()}
    assert one[0.5] == pytest.approx(np.median(data[1]))


def test_ties_are_kept(spark):
    rows = [("t", "a", 5.0), ("t", "b", 5.0), ("t", "c", 5.0), ("t", "d", 1.0)]
    rows += [("u", "e", 9.0), ("u", "f", 3.0), ("u", "g", 3.0), ("u", "h", 2.0), ("v", "i", 1.0), ("w", "j", None)]
    df = spark.createDataFrame(rows, "trim string, id string, gap double")
    got = {r["id"] for r in rank.top_n_with_ties(df, ["trim"], "gap", 2).collect()}
    assert got == {"a", "b", "c", "e", "f", "g", "i"}


def test_top_n_cuts_rows_before_the_shuffle(spark, study, capsys):
    df = study.kept_table.select("trim_key", "price")
    from pyspark.sql import Window

    w = Window.partitionBy("trim_key").orderBy(F.desc_nulls_last("price"))
    df.withColumn("_n", F.row_number().over(w)).filter("_n <= 2").explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_per_group(spark):
    df = spark.createDataFrame(
        [("t", "b", 5.0), ("t", "a", 5.0), ("t", "c", None), ("u", "z", None)], "trim string, id string, gap double"
    )
    got = {r["trim"]: r["id"] for r in rank.first_per_group(df, "trim", "gap").collect()}
    assert got == {"t": "a", "u": "z"}


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "v double")
    rows = profile.histogram(df, "v", 5).collect()
    assert sum(r["n"] for r in rows) == 4 and len(rows) == 5


def test_loess_is_exact_on_a_line(spark):
    curve = spark.createDataFrame([(a, 10.0 - 2.0 * a) for a in range(8)], "car_age int, mean_price double")
    for r in profile.loess_mean_price(curve, span=0.75).collect():
        assert r["smoothed"] == pytest.approx(r["mean_price"])


def _listings(spark, n, seed=7, duplicated=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        make = "M0" if rng.random() < 0.4 else f"M{rng.randrange(6)}"
        trim = f"{make}-T{rng.randrange(8)}"
        row_id = "copy" if duplicated and rng.random() < 0.34 else f"r{i:05d}"
        tier = None if rng.random() < 0.05 else float(rng.randrange(4) * 10000)
        rows.append(
            (row_id, make, f"{make}-x", trim, 2010 + rng.randrange(6), "auto", None if rng.random() < 0.1 else 6,
             tier, rng.choice(["", "p"]), float(rng.randrange(100, 900)))
        )
    return spark.createDataFrame(
        rows,
        "id string, make string, model_key string, trim_key string, year int, gear_type string,"
        " cylinder int, mileage_range double, personal string, price double",
    )


def test_split_conserves_and_covers(spark):
    df = _listings(spark, 900)
    out = split.split_with_coverage(df, P)
    rows = out.collect()
    assert len(rows) == 900 and {r["id"] for r in rows} == {r["id"] for r in df.collect()}
    parts = {s: [r for r in rows if r["split"] == s] for s in ("train", "test", "validation")}
    assert all(parts.values())
    for key in split.COVERAGE_KEYS:
        def values(which):
            return {tuple(r[k] for k in key) for r in which}

        assert values(parts["test"]) <= values(parts["train"])
        assert values(parts["validation"]) <= values(parts["train"]) | values(parts["test"])
    again = {(r["id"], r["split"]) for r in split.split_with_coverage(df, P).collect()}
    assert again == {(r["id"], r["split"]) for r in rows}


def test_holdout_takes_the_share_of_each_stratum(spark):
    df = _listings(spark, 700)
    held = split.stratified_holdout(df, 0.1, P)
    breaks = split.price_breaks(df, 4)
    assert breaks == pytest.approx(list(np.quantile([r["price"] for r in df.collect()], [0.25, 0.5, 0.75])))
    counts = held.groupBy(split.stratum(breaks).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("held_out").alias("k")
    )
    for r in counts.collect():
        assert r["k"] == math.ceil(r["n"] * 0.1)


def test_rows_with_one_id_stay_together(spark):
    df = _listings(spark, 600, duplicated=True)
    held = split.stratified_holdout(df, 0.2, P)
    breaks = split.price_breaks(df, 4)
    by_id = held.groupBy(split.stratum(breaks).alias("s"), "id").agg(F.count_distinct("held_out").alias("n"))
    assert by_id.filter("n > 1").count() == 0


def test_repair_is_the_same_without_broadcast(spark, monkeypatch):
    df = _listings(spark, 500)
    one = {(r["id"], r["split"]) for r in split.split_with_coverage(df, P).collect()}
    monkeypatch.setattr(workspace, "BROADCAST_BYTES", -1)
    two = {(r["id"], r["split"]) for r in split.split_with_coverage(df, P).collect()}
    assert one == two


def test_repair_equals_the_semi_join_chain(spark):
    df = _listings(spark, 500)
    held = split.stratified_holdout(df, 0.3, P)
    chain = split.semi_join_chain(held.filter("held_out"), held.filter("NOT held_out"))
    repaired = split.return_uncovered(held, "held_out").filter("held_out")
    assert {r["id"] for r in chain.collect()} == {r["id"] for r in repaired.collect()}
    removed = split.anti_join_natural(held.filter("held_out"), chain)
    assert removed.count() + chain.count() == held.filter("held_out").count()


def test_random_sample_is_stable(spark):
    df = _listings(spark, 200)
    a, b = (split.random_sample(df.repartition(k), 50, P) for k in (2, 5))
    ids = {r["id"] for r in a.collect()}
    assert len(ids) == 50 and ids == {r["id"] for r in b.collect()}


def test_missing_ids_and_flags_lose_no_row(spark, monkeypatch):
    rows = [tuple(r) for r in _listings(spark, 400).collect()]
    schema = _listings(spark, 1).schema
    at = schema.names.index("id")
    holed = [r[:at] + (None,) + r[at + 1 :] if i % 10 == 0 else r for i, r in enumerate(rows)]
    df = spark.createDataFrame(holed, schema)
    for bound in (-1, workspace.BROADCAST_BYTES):
        monkeypatch.setattr(workspace, "BROADCAST_BYTES", bound)
        out = split.split_with_coverage(df, Params(order_buckets=1))
        parts = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert sum(parts.values()) == 400 and None not in parts
    held = split.stratified_holdout(df, 0.2, Params(order_buckets=1))
    assert held.filter("held_out IS NULL").count() == 0
    wanted = held.groupBy(split.stratum(split.price_breaks(df, 4)).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("held_out").alias("k")
    )
    assert all(r["k"] == math.ceil(r["n"] * 0.2) for r in wanted.collect())


def test_split_of_no_rows(spark):
    empty = _listings(spark, 5).limit(0)
    assert split.split_with_coverage(empty, P).count() == 0


def test_numbered_is_a_place_in_the_whole_order(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(7)
    got = {r["v"]: r["place"] for r in rank.numbered(df, F.desc("v")).collect()}
    assert got == {v: 999 - v for v in range(1000)}
    assert rank.numbered(df.limit(0), "v").count() == 0


def test_histograms_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,), (9.0,)], "v double")
    charts = {"one": F.col("v") < 6, "none": F.col("v") > 100, "all": F.lit(True)}
    got = {(r["chart"], r["bin"]): r["n"] for r in profile.histograms(df, "v", 4, charts).collect()}
    assert got["one", 1] == 2 and got["all", 1] == 2 and got["all", 4] == 1 and ("none", 1) not in got


def test_shared_folder_and_broadcast_bound(spark, monkeypatch):
    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"master": "spark://x", "getConf": staticmethod(lambda: {}), "applicationId": "a"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_root(Cluster)
    table = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(workspace, "BROADCAST_BYTES", 50_000)
    assert not hinted(workspace.stored_lookup(table, "long"))
    assert hinted(workspace.stored_lookup(table.limit(10), "short"))
    with workspace.temporary_tables(spark):
        kept = workspace.stored(table, "gone")
        path = kept.inputFiles()[0]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|not found"):
        spark.read.parquet(path).count()


def test_bracketed_quantiles_are_exact_or_none(spark):
    import random

    from lotwise.operators import quantiles

    rng = random.Random(8)
    probs = [0.25, 0.5, 0.75]
    for values in (
        [rng.gauss(0, 1e4) for _ in range(5000)],
        [float(rng.randrange(4)) for _ in range(3000)],
        [1.0] * 1000 + [2.0],
        [3.0],
        [1.0, 2.0],
    ):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(3)
        want = [r["q"] for r in quantiles.exact_quantiles(df, "v", probs).orderBy("p").collect()]
        near = quantiles.brackets(df, "v", probs)
        assert quantiles.bracketed_quantiles(df, "v", probs, near.near) == want
        # brackets that miss are noticed
        off = [(max(values) + 1, max(values) + 2)] * 3
        assert quantiles.bracketed_quantiles(df, "v", probs, off) is None
        assert split.price_breaks(df, 4, "v", off) == sorted(set(want))
    assert quantiles.brackets(df.filter("v > 9"), "v", probs) is None
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,)], "v double")
    assert quantiles.brackets(nan, "v", probs) is None
    assert split.price_breaks(nan, 2, "v") == [2.0]


def test_split_needs_few_jobs(spark, study):
    status = spark.sparkContext._jsc.sc().statusTracker()
    rows = study.kept_table
    before = len(status.getJobIdsForGroup(None))
    split.split_with_coverage(rows, P).select("id", "split").write.format("noop").mode("overwrite").save()
    assert len(status.getJobIdsForGroup(None)) - before <= 40


def test_boxplot_keeps_a_missing_year(spark):
    rows = [(y, float(v)) for y in (2014, None) for v in (1, 2, 3, 4, 100)]
    df = spark.createDataFrame(rows, "year int, mileage double")
    got = {r["year"]: r for r in profile.mileage_boxplot_by_year(df, P).collect()}
    assert set(got) == {2014, None}
    assert all((r["median"], r["n"], r["n_outliers"], r["whisker_high"]) == (3.0, 5, 1, 4.0) for r in got.values())
    out = profile.mileage_outliers_by_year(df, P).collect()
    assert sorted(str(r["year"]) for r in out) == ["2014", "None"]
