"""Models that grow by a scrape, and samples of any size."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lotwise.catalog.study import P
from lotwise.operators import split
from lotwise.plans import effects
from lotwise.plans.scoring import score
from lotwise.workspace import new_path, stored


def test_merged_fit_equals_a_fit_over_both(spark, study, tmp_path):
    rows = study.split
    old_path = str(tmp_path / "old")
    rows.filter(F.col("posted_time").isNull()).write.parquet(old_path)
    fresh = stored(rows.filter(F.col("posted_time").isNotNull()), "fresh")
    path = new_path(spark, "model")
    effects.fit(spark.read.parquet(old_path), P).save(path)
    # the old listings are gone
    for f in (tmp_path / "old").iterdir():
        f.unlink()
    merged = effects.refit(effects.PriceModel.load(spark, path), fresh, P)
    whole = effects.fit(rows, P)
    assert merged.mu == pytest.approx(whole.mu, rel=1e-12)
    one, two = ({r["id"]: r["pred3"] for r in score(rows, m, P).collect()} for m in (merged, whole))
    assert set(one) == set(two)
    assert all((one[i] is None) == (two[i] is None) and (one[i] is None or one[i] == pytest.approx(two[i], abs=1e-4)) for i in one)
    again = effects.refit(merged, fresh.limit(0), P)
    assert again.mu == pytest.approx(whole.mu, rel=1e-12)


@pytest.mark.parametrize("n", [0, 1, 17, 499, 500, 501, 9999])
def test_sample_of_any_size(spark, n):
    df = spark.createDataFrame([(f"r{i:03d}", i) for i in range(500)], "id string, v int").repartition(7)
    got = split.random_sample(df, n, P)
    want = [r["id"] for r in df.orderBy(F.xxhash64("id", F.lit(P.seed)), "id").limit(n).collect()] if n else []
    assert sorted(r["id"] for r in got.collect()) == sorted(want) and got.columns == df.columns


def test_sample_with_ties_and_missing_ids(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b", "c"]), rng.randrange(3)) for _ in range(300)] + [("a", 7)] * 100
    df = spark.createDataFrame(rows, "id string, v int").repartition(5)
    size = Counter(r[0] for r in rows)
    for n in (1, 50, 150, 250, 399):
        got = [tuple(r) for r in split.random_sample(df, n, P, order=F.col("v") * 0).collect()]
        assert len(got) == n and not Counter(got) - Counter(rows)
        ids = Counter(i for i, _ in got)
        left = n
        for i in (None, "a", "b", "c"):
            assert ids[i] == min(size[i], left)
            left -= ids[i]
        again = [tuple(r) for r in split.random_sample(df.repartition(3), n, P, order=F.col("v") * 0).collect()]
        assert Counter(got) == Counter(again)


def test_no_task_holds_the_sample(spark):
    df = spark.range(20_000).selectExpr("cast(id AS string) AS id").repartition(6)
    out = split.random_sample(df, 15_000, P)
    tasks = Counter(r["t"] for r in out.select(F.spark_partition_id().alias("t")).collect())
    assert sum(tasks.values()) == 15_000 and max(tasks.values()) < 6_000
