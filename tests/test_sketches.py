"""Sketches against exact order statistics, and batches that are never read twice."""

import random

import pytest

from lotwise.operators import sketches

NAMES = {0.25: "q1", 0.5: "median", 0.75: "q3"}


def _places(values, q):
    """Share of values below ``q`` and up to it."""
    return sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)


def test_quantiles_are_within_the_stated_rank_error(spark):
    rng = random.Random(1)
    values = {2014: [rng.gauss(0, 1) for _ in range(20_000)], 2015: [float(rng.randrange(3)) for _ in range(5000)], 2016: [7.0]}
    rows = [(y, v) for y, vs in values.items() for v in vs] + [(2017, None), (None, 1.0)]
    df = spark.createDataFrame(rows, "year int, v double").repartition(5)
    for size in (200, 2000):
        got = {r["year"]: r for r in sketches.quantiles(sketches.sketches(df, "v", ["year"], size), NAMES, ["year"]).collect()}
        assert set(got) == {2014, 2015, 2016, 2017, None} and got[2017]["median"] is None and got[None]["q1"] == 1.0
        e = sketches.rank_error(size)
        for year, vs in values.items():
            for p, name in NAMES.items():
                low, high = _places(vs, got[year][name])
                assert low - e <= p <= high + e
    assert sketches.rank_error(2000) < 0.0015 < sketches.rank_error(200)


def test_a_new_batch_does_not_read_the_old_rows(spark, tmp_path):
    rng = random.Random(2)
    path, held = str(tmp_path / "store"), []
    for k in range(4):
        file = str(tmp_path / f"scrape{k}")
        part = [(2014 + i % 3, rng.expovariate(0.1), k) for i in range(3000)]
        spark.createDataFrame(part, "year int, v double, k int").write.parquet(file)
        sketches.add_batch(path, f"b{k}", spark.read.parquet(file), "v", ["year"])
        held += part
        merged = sketches.merged(spark, path, ["year"])
        assert all(file not in f for f in merged.inputFiles()) and len(merged.inputFiles()) <= 4 * (k + 1)
        for r in sketches.five_numbers(merged, ["year"]).collect():
            vs = [v for y, v, _ in held if y == r["year"]]
            assert (r["n"], r["nulls"], r["min"], r["max"]) == (len(vs), 0, min(vs), max(vs))
            e = sketches.rank_error()
            for p, name in NAMES.items():
                low, high = _places(vs, r[name])
                assert low - e <= p <= high + e
    one = sketches.five_numbers(sketches.merged(spark, path, ["year"], ["b0"]), ["year"]).collect()
    assert {r["n"] for r in one} == {1000}
    with pytest.raises(Exception):
        sketches.add_batch(path, "b0", spark.read.parquet(file), "v", ["year"])


def test_boxplot_counts_what_lies_outside(spark):
    values = [float(i) for i in range(1000)] + [1e6] * 30 + [-1e6] * 20
    df = spark.createDataFrame([(v,) for v in values], "v double")
    (r,) = sketches.boxplot(sketches.sketches(df, "v")).collect()
    e = (sketches.rank_error() + 1 / 1000) * len(values)
    assert r["n"] == 1050 and abs(r["n_outliers"] - 50) <= 2 * e + 1
    assert r["fence_low"] < 0 and r["fence_high"] > 999


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "year int, v double")
    assert sketches.sketches(none, "v", ["year"]).count() == 0
    sketches.add_batch(str(tmp_path / "s"), "b", none, "v", ["year"])
    assert sketches.merged(spark, str(tmp_path / "s"), ["year"]).count() == 0
    (r,) = sketches.five_numbers(sketches.sketches(none.select("v"), "v")).collect()
    assert r["n"] == 0 and r["median"] is None
    with pytest.raises(FileNotFoundError):
        sketches.merged(spark, str(tmp_path / "elsewhere"))


def test_missing_values_only(spark, tmp_path):
    path = str(tmp_path / "s")
    empty = spark.createDataFrame([(1, None), (1, None)], "g int, v double")
    sketches.add_batch(path, "a", empty, "v", ["g"])
    sketches.add_batch(path, "b", spark.createDataFrame([(1, 2.0), (2, None)], "g int, v double"), "v", ["g"])
    got = {r["g"]: r for r in sketches.five_numbers(sketches.merged(spark, path, ["g"]), ["g"]).collect()}
    assert (got[1]["n"], got[1]["nulls"], got[1]["median"]) == (1, 2, 2.0)
    assert (got[2]["n"], got[2]["nulls"], got[2]["median"]) == (0, 1, None)
