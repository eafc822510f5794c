"""Random-forest price model on the ML library.

A forest is a pipeline from raw rows to a price: the year as a category, an encoding of the
text predictors (``encoding.py``), and blocks of trees whose mean is the prediction. The
mean of the first blocks is a smaller forest, so one fit answers for every number of trees
of a grid. Text predictors are level means by default, which any number of levels bears;
one-hot vectors, as a model formula has them, are the choice where levels are thousands:
the library holds a training row as one number for each feature.

Every row is a training row of its own, with its own mileage and its own draws of the
bootstrap, whatever the number of rows. Merging rows that trees hardly tell apart
(:func:`merged`) is another forest, not the same one faster: it is grown only for a caller who
sets ``rf_rows``, never by the size of the input alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from itertools import pairwise
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.operators.groups import left_lookup
from lotwise.operators.rank import numbered
from lotwise.params import Params
from lotwise.plans.encoding import LevelCodes, LevelCodesModel, LevelMeans, LevelMeansModel
from lotwise.plans.evaluate import FOREST
from lotwise.workspace import stored, stored_lookup

PREDICTION = "predicted_price_rf"

CATEGORIES = ["make", "model_key", "trim_key", "year2"]
FEATURES = [*(f"{c}_mean" for c in CATEGORIES), "mileage_known", "mileage_filled"]
TRAINING_FOLD = "_training_fold"
# columns of merged rows: the mileage's step, how many rows there are, the squares within them
STEP, WEIGHT, SPREAD = "mileage_step", "_rows", "_spread"


@dataclass(frozen=True)
class Forest:
    """A fitted pipeline that scores raw rows (make, model_key, trim_key, year, mileage)."""

    model: PipelineModel

    @property
    def encoding(self) -> LevelMeansModel | LevelCodesModel:
        return next(s for s in self.model.stages if isinstance(s, (LevelMeansModel, LevelCodesModel)))

    @property
    def blocks(self) -> list[RandomForestRegressionModel]:
        return [s for s in self.model.stages if isinstance(s, RandomForestRegressionModel)]

    @property
    def trees(self) -> list:
        return [t for b in self.blocks for t in b.trees]

    @property
    def n_features(self) -> int:
        return self.blocks[0].numFeatures

    def save(self, path: str) -> None:
        self.model.write().save(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        return Forest(PipelineModel.load(path))


def with_year2(df: DataFrame) -> DataFrame:
    return df.withColumn("year2", F.col("year").cast("string"))


def rf_features(df: DataFrame) -> DataFrame:
    """Price, predictors and nothing else; the year is a category. Every row stays."""
    return with_year2(df).select("price", *CATEGORIES, "mileage")


def with_fold(df: DataFrame, folds: int, p: Params, name: str = "fold") -> DataFrame:
    """Fold from a hash of the id: a recomputed partition lands in the same fold."""
    fold = F.pmod(F.xxhash64(F.col("id"), F.lit(p.seed)), F.lit(folds)).cast("int")
    return df.withColumn(name, fold)


def to_factor(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Level codes for text columns, levels in byte order.

    The levels of a column are numbered by ranges, then joined back: no level passes
    through the driver. A missing value gets the code after the last level.
    """
    for c in columns:
        levels = df.select(F.col(c).alias("level")).filter("level IS NOT NULL").distinct()
        codes = stored_lookup(numbered(levels, "level", name=f"{c}_code"), "levels")
        after = codes.agg(F.count(F.lit(1))).scalar()
        df = left_lookup(df, codes.withColumnRenamed("level", c), [c])
        df = df.withColumn(f"{c}_code", F.coalesce(f"{c}_code", after).cast("double"))
    return df


# --- features ----------------------------------------------------------------------


def _year_stage() -> SQLTransformer:
    return SQLTransformer(statement="SELECT *, CAST(year AS STRING) AS year2 FROM __THIS__")


def mileage_steps(df: DataFrame, p: Params) -> Bucketizer:
    """The mileage as one of ``rf_bins`` steps that hold about equally many rows."""
    edges = sorted(set(df.approxQuantile("mileage", [i / p.rf_bins for i in range(1, p.rf_bins)], 0.001)))
    splits = [-float("inf"), *(edges or [0.0]), float("inf")]
    return Bucketizer(splits=splits, inputCol="mileage", outputCol=STEP, handleInvalid="keep")


def merged(rows: DataFrame, steps: Bucketizer, p: Params) -> DataFrame:
    """One row for all rows alike in keys, mileage step and folds: their number, mean price,
    and the sum of squares around it.

    A bootstrap draws whole rows of this table. So the rows of a set are dealt out at random
    to several such rows, as many as ``rf_rows``, which must be set, allows: a draw then varies a mean as much
    as one of single rows would.
    """
    keys = [c for c in rows.columns if c not in ("id", "price", "mileage")] + [STEP]
    stepped = steps.transform(rows)
    sets = stepped.agg(F.approx_count_distinct(F.xxhash64(*keys))).first()[0]
    parts = max(1, p.rf_rows // max(1, sets))
    part = F.pmod(F.xxhash64(F.col("id"), F.lit(p.seed + 1)), F.lit(parts)).alias("_part")
    squares = (F.var_pop("price") * F.count("price")).alias(SPREAD)
    found = stepped.groupBy(*keys, part).agg(F.avg("price").alias("price"), F.count("price").alias(WEIGHT), squares)
    # small as it is now, it would be read by few tasks
    wide = 3 * rows.sparkSession.sparkContext.defaultParallelism
    return stored(found.filter(F.col(WEIGHT) > 0).repartition(wide, *keys, "_part").drop("_part"), "merged_rows")


def fit_level_means(rows: DataFrame, p: Params, fold: str) -> LevelMeansModel:
    return LevelMeans(inputCols=CATEGORIES, foldCol=fold, priorRows=p.rf_prior_rows, **_weighted(rows)).fit(rows)


def _weighted(rows: DataFrame) -> dict[str, str]:
    return {"numberCol": STEP, "weightCol": WEIGHT} if WEIGHT in rows.columns else {}


def _numbers(rows: DataFrame) -> list[str]:
    name = _weighted(rows).get("numberCol", "mileage")
    return [f"{name}_known", f"{name}_filled"]


def _one_hot(spark: SparkSession, codes: LevelCodesModel, numbers: list[str]) -> tuple[list, list[str]]:
    """Stages that turn codes into sparse vectors, and the columns to assemble."""
    used = {n: k for n, k in codes.features().items() if k > 0}
    assembled = numbers
    if not used:
        return [], assembled
    encoder = OneHotEncoder(
        inputCols=[f"{n}_code" for n in used], outputCols=[f"{n}_hot" for n in used], handleInvalid="keep"
    )
    # one row of the largest codes tells the encoder all it has to know
    largest = spark.range(1).select(*[F.lit(float(k - 1)).alias(f"{n}_code") for n, k in used.items()])
    return [encoder.fit(largest)], [f"{n}_hot" for n in used] + assembled


def fit_features(rows: DataFrame, p: Params) -> list:
    """Fitted stages from raw rows (and ``TRAINING_FOLD``) to a vector of features."""
    year = _year_stage()
    ready = year.transform(rows)
    if p.rf_encoding == "onehot":
        codes = LevelCodes(inputCols=CATEGORIES, **_weighted(rows)).fit(ready)
        stages, assembled = _one_hot(rows.sparkSession, codes, _numbers(rows))
        return [year, codes, *stages, VectorAssembler(inputCols=assembled, outputCol="features")]
    if p.rf_encoding != "means":
        raise ValueError(f"unknown encoding {p.rf_encoding!r}: means or onehot")
    means = fit_level_means(ready, p, TRAINING_FOLD)
    assembled = [f"{c}_mean" for c in CATEGORIES] + _numbers(rows)
    return [year, means, VectorAssembler(inputCols=assembled, outputCol="features")]


def training_rows(df: DataFrame, p: Params) -> tuple[DataFrame, LevelMeansModel]:
    """Rows with their level means over the other folds, each with its fold, and the encoding."""
    rows = with_year2(with_fold(df, p.rf_folds, p)).select("price", *CATEGORIES, "mileage", "fold")
    e = fit_level_means(rows, p, "fold")
    return e.transform(rows).select("price", *FEATURES, "fold"), e


def encoded(df: DataFrame, e: LevelMeansModel, own_fold: bool) -> DataFrame:
    """``df`` (with year2) and :data:`FEATURES`; ``own_fold``: by the other folds of a row's ``fold``."""
    return e.transform(df if own_fold else df.drop("fold"))


# --- trees -------------------------------------------------------------------------


def block_sizes(trees: Sequence[int]) -> list[int]:
    """Trees of each block, so that the first blocks make up every number of trees asked for."""
    counts = sorted(set(trees))
    return [b - a for a, b in pairwise([0, *counts])]


def _fit_blocks(ready: DataFrame, p: Params, sizes: Sequence[int], subset: str) -> list[RandomForestRegressionModel]:
    def block(place: int) -> RandomForestRegressionModel:
        grower = RandomForestRegressor(
            featuresCol="features",
            labelCol="price",
            predictionCol=f"block_{place}",
            numTrees=sizes[place],
            maxDepth=p.rf_depth,
            maxBins=p.rf_bins,
            featureSubsetStrategy=subset,
            seed=p.seed + place,
        )
        if WEIGHT in ready.columns:
            grower.setWeightCol(WEIGHT)
        return grower.fit(ready)

    return [block(i) for i in range(len(sizes))]


def _mean_of_blocks(sizes: Sequence[int]) -> str:
    """SQL text of the mean over all trees of the blocks."""
    return f"({' + '.join(f'{n} * block_{i}' for i, n in enumerate(sizes))}) / {float(sum(sizes))}"


def _forest(features: list, blocks: list, sizes: Sequence[int]) -> Forest:
    mean = SQLTransformer(statement=f"SELECT *, {_mean_of_blocks(sizes)} AS {PREDICTION} FROM __THIS__")
    return Forest(PipelineModel([*features, *blocks, mean]))


def _raw(df: DataFrame) -> DataFrame:
    return df.select("id", "price", "make", "model_key", "trim_key", "year", "mileage")


def rf_train(df: DataFrame, p: Params = Params(), subset: str = "onethird") -> Forest:
    """Fit on rows with id, price, keys and mileage; no row is left out."""
    return _rf_train(df, p, block_sizes([p.rf_trees]), subset)


def _rf_train(df: DataFrame, p: Params, sizes: Sequence[int], subset: str) -> Forest:
    rows = with_fold(_raw(df), p.rf_folds, p, TRAINING_FOLD)
    rows, first = _merged_if_asked(rows, p)
    features = fit_features(rows, p)
    ready = stored(PipelineModel(features).transform(rows).select("price", "features", *_counts(rows)), "training_rows")
    return _forest([*first, *features], _fit_blocks(ready, p, sizes, subset), sizes)


def _merging(rows: DataFrame, p: Params) -> bool:
    """Whether the caller set a number of rows to merge beyond, and there are more."""
    return p.rf_rows is not None and rows.count() > p.rf_rows


def _merged_if_asked(rows: DataFrame, p: Params) -> tuple[DataFrame, list]:
    """``rows``, or if the caller wants it :func:`merged` ones and the stage that raw rows need before."""
    if not _merging(rows, p):
        return rows, []
    steps = mileage_steps(rows, p)
    if p.rf_encoding == "onehot":  # its codes know no folds, and a row is many numbers wide
        return merged(rows.drop(TRAINING_FOLD), steps, replace(p, rf_rows=p.rf_rows // 10)), [steps]
    return merged(rows, steps, p), [steps]


def _counts(rows: DataFrame) -> list[str]:
    return [c for c in (WEIGHT, SPREAD) if c in rows.columns]


def rf_predict(forest: Forest, df: DataFrame) -> DataFrame:
    """Adds ``predicted_price_rf`` to every row."""
    return forest.model.transform(df).select(*[F.col(f"`{x}`") for x in df.columns], PREDICTION)


# --- cross-validation --------------------------------------------------------------


@dataclass(frozen=True)
class CrossValidation:
    """Mean held-out RMSE of each setting, and how to fit the best one on all rows."""

    scores: list[tuple[int, str, float]]  # trees, features tried at a split, rmse
    rows: DataFrame
    params: Params

    @property
    def best(self) -> tuple[int, str, float]:
        """Least error; of equals the smaller forest."""
        return min(self.scores, key=lambda s: (s[2], s[0], s[1]))

    def refit(self) -> Forest:
        """The best setting on all rows, with the blocks that were scored."""
        trees, subset, _ = self.best
        sizes = block_sizes([n for n, *_ in self.scores if n <= trees])
        return _rf_train(self.rows, self.params, sizes, subset)


def rf_cross_validate(
    df: DataFrame, p: Params = Params(), trees: Sequence[int] | None = None, subsets: Sequence[str] | None = None
) -> CrossValidation:
    """k-fold cross-validation over the grid of trees and features tried at a split.

    For each fold the whole pipeline, encoding included, is fitted on the other folds alone,
    once for each number of features tried: the largest number of trees is grown in blocks,
    and the error of every smaller number is read off the same predictions. ``rf_repeats``
    repeats it with other folds. Fits of one fold run ``rf_parallel`` at a time.
    """
    counts = sorted(set(trees or p.rf_grid_trees))
    subsets = list(subsets or p.rf_grid_subsets)
    sizes = block_sizes(counts)
    rows = stored(_raw(df), "validated_rows")
    merging = _merging(rows, p)
    errors: dict[tuple[int, str], list[float]] = {}
    for repeat in range(p.rf_repeats):
        folded = with_fold(rows, p.rf_folds, replace(p, seed=p.seed + 1000 * repeat + 500), "fold")
        if merging:
            folded, _ = _merged_if_asked(with_fold(folded, p.rf_folds, p, TRAINING_FOLD), p)
        for fold in range(p.rf_folds):
            met = folded.filter(F.col("fold") != fold).drop("fold")
            met = met if merging else with_fold(met, p.rf_folds, p, TRAINING_FOLD)
            features = fit_features(met, p)
            encode = PipelineModel(features)
            ready = stored(encode.transform(met).select("price", "features", *_counts(met)), "training_rows")
            held_out = encode.transform(folded.filter(F.col("fold") == fold).drop("fold", TRAINING_FOLD))
            held_out = stored(held_out.select("price", "features", *_counts(met)), "held_out_rows")

            def fitted(subset: str) -> list[float | None]:
                return prefix_errors(held_out, _fit_blocks(ready, p, sizes, subset), sizes)

            with ThreadPool(min(p.rf_parallel, len(subsets))) as pool:
                found = pool.map(inheritable_thread_target(rows.sparkSession)(fitted), subsets)
            for subset, of_counts in zip(subsets, found):
                for n, error in zip(counts, of_counts):
                    if error is not None:  # a fold without rows tells nothing
                        errors.setdefault((n, subset), []).append(error)
    scores = [(n, subset, sum(e) / len(e)) for (n, subset), e in errors.items()]
    return CrossValidation(sorted(scores), rows, p)


def prefix_errors(rows: DataFrame, blocks: list[RandomForestRegressionModel], sizes: Sequence[int]) -> list[float | None]:
    """RMSE of the first block, the first two and so on, every tree asked once for each row."""
    scored = PipelineModel(blocks).transform(rows)
    ends = range(1, len(sizes) + 1)
    wrong = [F.expr(f"price - {_mean_of_blocks(sizes[:k])}") for k in ends]
    if WEIGHT in rows.columns:  # squares around the mean of merged rows, and of the mean itself
        total = lambda e: F.sum(e * e * F.col(WEIGHT) + F.col(SPREAD))
        mean = lambda e: F.try_divide(total(e), F.sum(WEIGHT))
    else:
        mean = lambda e: F.avg(e * e)
    found = scored.agg(*[F.sqrt(mean(e)).alias(f"e{k}") for k, e in zip(ends, wrong)]).first()
    return list(found)


def cross_validation_table(cv: CrossValidation) -> DataFrame:
    """One row per setting of the grid with its mean RMSE over the folds."""
    rows = [(n, subset, float(rmse), (n, subset, rmse) == cv.best) for n, subset, rmse in cv.scores]
    return SparkSession.getActiveSession().createDataFrame(
        rows, "num_trees int, feature_subset string, cv_rmse double, best boolean"
    )


def rf_metrics(predicted: DataFrame, scope: str, prediction: str = PREDICTION) -> DataFrame:
    """RMSE, R squared and mean absolute error; ``scope`` says on which rows.

    The in-sample and the held-out figure are different things and are labelled so.
    """
    y, f = F.col("price"), F.col(prediction)
    error = predicted.agg(
        F.sqrt(F.avg(F.pow(y - f, 2))).alias("rmse"),
        F.avg(F.abs(y - f)).alias("mae"),
        F.corr("price", prediction).alias("_r"),
    )
    return error.select(
        F.lit(FOREST).alias("method_on_validation"),
        F.lit(scope).alias("split"),
        "rmse",
        (F.col("_r") * F.col("_r")).alias("r2"),
        "mae",
    )
