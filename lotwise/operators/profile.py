"""Profiles of the listings: the data behind every chart and summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.display import car_age
from lotwise.functions.nulls import strict_sum
from lotwise.operators.filters import filter_make_model, filter_mileage_anomaly
from lotwise.operators.groups import left_lookup
from lotwise.operators.quantiles import exact_quantiles, quantiles_wide, value_counts
from lotwise.params import Params
from lotwise.workspace import stored, stored_lookup


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def filter_funnel(cleaned: DataFrame, p: Params) -> DataFrame:
    """Rows left after each filter step, from one scan."""
    cap = F.col("price") < p.price_cap
    year = F.col("year") > p.min_year
    return cleaned.agg(
        F.count(F.lit(1)).alias("rows_raw"),
        F.count_if(cap).alias("rows_under_cap"),
        F.count_if(cap & year).alias("rows_recent_years"),
        F.count_if(cap & year & F.col("price").isNotNull()).alias("rows_kept"),
    )


def year_frequency(df: DataFrame, n: int = 20) -> DataFrame:
    return df.groupBy("year").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "year").limit(n)


def make_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("make").agg(F.count(F.lit(1)).alias("n"))


def nth_most_frequent_make(df: DataFrame, rank: int) -> DataFrame:
    """One row, one column: the rank-th commonest make (ties: by name)."""
    ordered = make_counts(df.filter(F.col("make").isNotNull())).orderBy(F.desc("n"), "make")
    return ordered.limit(rank).offset(rank - 1).select("make")


def make_share(df: DataFrame, over: float = 3.0) -> DataFrame:
    """Share of each make in per cent, where above ``over``."""
    counts = make_counts(df.filter(F.col("make").isNotNull()))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total * 100).filter(F.col("share") > over)


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def count_make_model_year(df: DataFrame, rank: int) -> DataFrame:
    """Listings per model and year of the rank-th commonest make."""
    make = nth_most_frequent_make(df, rank).scalar()
    return count_by(filter_make_model(df, make), "make", "model", "year")


def count_by_trim_year(df: DataFrame, rank: int, model: str) -> DataFrame:
    make = nth_most_frequent_make(df, rank).scalar()
    return count_by(filter_make_model(df, make, model), "make", "model", "year", "trim")


def mean_price_by_age(df: DataFrame, p: Params) -> DataFrame:
    return df.groupBy(car_age(F.col("year"), p.age_year).alias("car_age")).agg(
        F.avg("price").alias("mean_price")
    )


def likes_by_model(df: DataFrame) -> DataFrame:
    return df.groupBy("make", "model").agg(strict_sum("likes").alias("total_likes"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins from the smallest to the largest value; the last bin is closed."""
    return histograms(df, value, bins, {"": F.lit(True)}).drop("chart")


def histograms(df: DataFrame, value: str, bins: int, charts: Mapping[str, Column]) -> DataFrame:
    """(chart, bin, bin_from, bin_to, n): a histogram of the rows of each named condition.

    All charts share two scans: one for the smallest and largest values, one for the
    counts. A chart without values has no bins.
    """
    c = F.col
    v = c(value).cast("double")
    known = df.filter(v.isNotNull()).select(v.alias("v"), *[F.coalesce(x, F.lit(False)).alias(f"in_{i}") for i, x in enumerate(charts.values())])
    ends = known.agg(*[f(F.when(c(f"in_{i}"), c("v"))).alias(f"{n}_{i}") for i in range(len(charts)) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    frames, slots = [], []
    for i, name in enumerate(charts):
        lo, hi = ends[f"lo_{i}"], ends[f"hi_{i}"]
        if lo is None:
            continue
        # one value alone has no width: it lies in the first bin
        slot = F.least(F.width_bucket(c("v"), F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins)) if lo < hi else F.lit(1)
        slots.append(F.when(c(f"in_{i}"), F.struct(F.lit(name).alias("chart"), slot.cast("int").alias("bin"))))
        frames += [(name, b + 1, lo + b * ((hi - lo) / bins), lo + (b + 1) * ((hi - lo) / bins)) for b in range(bins)]
    frame = df.sparkSession.createDataFrame(frames, "chart string, bin int, bin_from double, bin_to double")
    if not slots:
        return frame.withColumn("n", F.lit(0).cast("bigint"))
    hits = known.select(F.explode(F.filter(F.array(*slots), lambda x: x.isNotNull())).alias("h"))
    counts = hits.groupBy("h.chart", "h.bin").agg(F.count(F.lit(1)).alias("n"))
    return frame.join(counts, ["chart", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


_QUARTILES = {0.25: "q1", 0.5: "median", 0.75: "q3"}


def _box_counts(df: DataFrame, p: Params) -> DataFrame:
    """(year, mileage, n) with the quartiles and fences of the year on each pair."""
    # the rows are read once: quartiles and fences both work on their value counts
    counts = stored(value_counts(filter_mileage_anomaly(df, p), "mileage", ["year"]), "value_counts")
    long = exact_quantiles(counts, "value", list(_QUARTILES), ["year"], weight="n")
    quartiles = stored_lookup(quantiles_wide(long, _QUARTILES, ["year"]), "quartiles")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return left_lookup(counts, quartiles, ["year"]).withColumns(
        {"_low": F.col("q1") - reach, "_high": F.col("q3") + reach}
    )


def mileage_boxplot_by_year(df: DataFrame, p: Params) -> DataFrame:
    """Quartiles, whiskers (1.5 IQR) and number of outliers per year."""
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    return (
        _box_counts(df, p)
        .groupBy("year", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum("n").alias("n"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).alias("n_outliers"),
        )
    )


def mileage_outliers_by_year(df: DataFrame, p: Params) -> DataFrame:
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    return _box_counts(df, p).filter(~inside).select(
        "year", F.col("value").alias("mileage"), "n"
    )


_SUMMARY = {0.0: "min", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "max"}


def five_number_summary(df: DataFrame, value: str) -> DataFrame:
    """(stat, value): the five numbers, the mean and the number of missing values."""
    spread = exact_quantiles(df, value, list(_SUMMARY))
    name = F.create_map(*[F.lit(x) for item in _SUMMARY.items() for x in item])
    rest = df.agg(
        F.avg(F.col(value).cast("double")).alias("mean"),
        F.count_if(F.col(value).isNull()).cast("double").alias("nulls"),
    ).select(F.expr("stack(2, 'mean', mean, 'nulls', nulls) AS (stat, value)"))
    return spread.select(name[F.col("p")].alias("stat"), F.col("q").alias("value")).unionByName(rest)


def _one_row_per_column(df: DataFrame, stats: Sequence[tuple[str, str]], cols: list[str]) -> DataFrame:
    """Turn a one-row frame with ``<stat>_<i>`` columns into one row per column."""
    rows = ", ".join(
        f"'{name}', " + ", ".join(f"{s}_{i}" for s, _ in stats) for i, name in enumerate(cols)
    )
    names = ", ".join(alias for _, alias in stats)
    return df.select(F.expr(f"stack({len(cols)}, {rows}) AS (column_name, {names})"))


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, all columns in one pass."""
    wide = df.agg(*[F.count_if(df[c].isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)])
    return _one_row_per_column(wide, [("n", "nulls")], df.columns)


def schema_profile(df: DataFrame) -> DataFrame:
    """Name, type, filled rows and one example (the smallest text) of every column."""
    aggs = []
    for i, c in enumerate(df.columns):
        aggs += [
            F.count(df[c]).alias(f"n_{i}"),
            F.min(df[c].cast("string")).alias(f"e_{i}"),
            F.lit(df.schema[c].dataType.simpleString()).alias(f"t_{i}"),
        ]
    stats = [("t", "data_type"), ("n", "filled"), ("e", "example")]
    return _one_row_per_column(df.agg(*aggs), stats, df.columns)


def head_rows(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def loess_mean_price(curve: DataFrame, span: float = 0.15, min_points: int = 3) -> DataFrame:
    """Local straight-line smooth of (car_age, mean_price), one row per age.

    Each age is fitted on its ``q`` nearest ages with tricube weights. On the ordered
    curve these lie at most ``q - 1`` places away, so every point is sent to the places
    around it and met there by an equi join.
    """
    c = F.col
    points = curve.filter(c("mean_price").isNotNull() & c("car_age").isNotNull())
    # the curve has one row per age, so one ordered pass over it is small
    places = points.withColumn("place", F.row_number().over(Window.orderBy("car_age")))
    q = F.greatest(F.lit(min_points), F.ceil(points.agg(F.count(F.lit(1))).scalar() * span)).cast("int")
    around = places.select(
        c("car_age").alias("x"),
        c("mean_price").alias("y"),
        F.explode(F.sequence(c("place") - q + 1, c("place") + q - 1)).alias("place"),
    )
    pairs = places.join(around, "place").withColumn("d", F.abs(c("x") - c("car_age")))
    nearest = Window.partitionBy("car_age").orderBy("d", "x")
    pairs = pairs.withColumn("k", F.row_number().over(nearest)).filter(c("k") <= q)
    reach = F.max("d").over(Window.partitionBy("car_age"))
    pairs = pairs.withColumn("h", reach).withColumn(
        "w", F.when(c("h") == 0, F.lit(1.0)).otherwise(F.pow(1 - F.pow(c("d") / c("h"), 3), 3))
    )
    w, x, y = c("w"), c("x") - c("car_age"), c("y")
    sums = pairs.groupBy("car_age", "mean_price").agg(
        F.sum(w).alias("s"),
        F.sum(w * x).alias("sx"),
        F.sum(w * y).alias("sy"),
        F.sum(w * x * x).alias("sxx"),
        F.sum(w * x * y).alias("sxy"),
    )
    spread = c("s") * c("sxx") - c("sx") * c("sx")
    slope = (c("s") * c("sxy") - c("sx") * c("sy")) / spread
    fitted = F.when(spread > 1e-9, (c("sy") - slope * c("sx")) / c("s")).otherwise(c("sy") / c("s"))
    return sums.select("car_age", "mean_price", fitted.alias("smoothed"))


def mileage_axis_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("year").alias("n_years"), F.max("mileage").alias("max_mileage"))


def year_mileage_points(df: DataFrame, p: Params) -> DataFrame:
    return filter_mileage_anomaly(df, p).select("id", "year", "mileage")


def year_mileage_correlation(df: DataFrame, p: Params) -> DataFrame:
    return filter_mileage_anomaly(df, p).agg(F.corr("year", "mileage").alias("correlation"))
