"""Quantiles from mergeable sketches, kept per batch of rows.

Exact quantiles read all rows again whenever some arrive. Here each batch (a scrape, a
file) is read once and leaves one small row per group: a KLL sketch of the values, their
number, ends and missing ones. Groups of any set of batches are merged from these rows
alone. A quantile from a sketch has a rank error: with probability 0.99 the value returned
for p stands between the places ``(p - e) * n`` and ``(p + e) * n``, e from
:func:`rank_error`, however many batches were merged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.workspace import exists

SIZE = 2000  # of a sketch: some 20 kB, whatever the rows


def rank_error(size: int = SIZE) -> float:
    """Bound of the rank error of a KLL sketch of this size, at 99 % confidence.

    Fixed values: the constants of the published fit for single quantiles.
    """
    return 2.296 / size**0.9723


def sketches(df: DataFrame, value: str, by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """(by..., sketch, n, nulls, low, high): one row per group, with map-side combine.

    A group without values has no sketch. A missing group is a group.
    """
    v = F.col(value).cast("double")
    return df.groupBy(*by).agg(
        F.kll_sketch_agg_double(v, size).alias("sketch"),
        F.count(v).alias("n"),
        F.count_if(v.isNull()).alias("nulls"),
        F.min(v).alias("low"),
        F.max(v).alias("high"),
    )


def add_batch(path: str, batch: str, rows: DataFrame, value: str, by: Sequence[str] = (), size: int = SIZE) -> None:
    """Store the sketches of one batch below ``path``; a batch is never stored twice."""
    sketches(rows, value, by, size).write.mode("errorifexists").parquet(f"{path.rstrip('/')}/batch={batch}")


def merged(spark: SparkSession, path: str, by: Sequence[str] = (), batches: Sequence[str] | None = None) -> DataFrame:
    """Sketches of all stored batches, or of the chosen ones, merged group by group."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no batch in {path}")
    kept = spark.read.option("basePath", path).parquet(path)
    if batches is not None:
        kept = kept.filter(F.col("batch").cast("string").isin(list(batches)))
    filled = F.when(F.col("n") > 0, F.col("sketch"))
    return kept.groupBy(*by).agg(
        F.kll_merge_agg_double(filled).alias("sketch"),
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def quantile(p: float) -> Column:
    """The quantile of a row of :func:`sketches`; the ends are exact, no values have none."""
    if p in (0.0, 1.0):
        return F.col("low" if p == 0 else "high")
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))))


def rank(value: Column, steps: int = 1000) -> Column:
    """About the share of values up to ``value``, read off ``steps`` quantiles (1 / steps more error)."""
    points = F.kll_sketch_get_quantile_double("sketch", F.lit([(i + 0.5) / steps for i in range(steps)]))
    return F.when(F.col("n") > 0, F.size(F.filter(points, lambda q: q <= value)) / steps)


def quantiles(of: DataFrame, names: Mapping[float, str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., one column per probability)."""
    return of.select(*by, *[quantile(p).alias(n) for p, n in names.items()])


def boxplot(of: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, 1.5 IQR fences, n and about how many values lie outside the fences."""
    box = of.select(*by, "sketch", "n", "low", "high", *[quantile(p).alias(x) for p, x in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    box = box.withColumns({"fence_low": F.col("q1") - reach, "fence_high": F.col("q3") + reach})
    below = F.when(F.col("fence_low") > F.col("low"), rank(F.col("fence_low"))).otherwise(0.0)
    above = F.when(F.col("fence_high") < F.col("high"), 1 - rank(F.col("fence_high"))).otherwise(0.0)
    outside = F.round((below + above) * F.col("n")).cast("bigint")
    return box.select(*by, "q1", "median", "q3", "fence_low", "fence_high", "n", outside.alias("n_outliers"))


def five_numbers(of: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., min, q1, median, q3, max, n, nulls)."""
    names = {0.0: "min", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "max"}
    return of.select(*by, *[quantile(p).alias(n) for p, n in names.items()], "n", "nulls")
