"""Text predictors as numbers: two estimators for an ML pipeline, saved with it.

:class:`LevelMeans` lets a level stand for the mean price of its rows, :class:`LevelCodes`
numbers the levels for one-hot vectors. What either learns are lookup tables joined to the
rows, so no level passes through the driver and any number of levels is told apart. Both
are fitted inside the pipeline: a cross-validation that fits the pipeline anew on the
training rows of a fold learns nothing from the rows it is tested on.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.operators.groups import left_lookup
from lotwise.operators.rank import numbered
from lotwise.workspace import measured, stored_lookup


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "text predictors", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "the price", TypeConverters.toString)
    numberCol = Param(Params._dummy(), "numberCol", "number with missing values", TypeConverters.toString)
    foldCol = Param(Params._dummy(), "foldCol", "fold of a training row", TypeConverters.toString)
    priorRows = Param(Params._dummy(), "priorRows", "rows at the overall mean added to a level", TypeConverters.toFloat)
    weightCol = Param(Params._dummy(), "weightCol", "how many rows a row stands for", TypeConverters.toString)
    dropFirst = Param(Params._dummy(), "dropFirst", "the first level is the base", TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="price", numberCol="mileage", foldCol="fold", priorRows=10.0, dropFirst=True)

    def _of(self, name: str):
        return self.getOrDefault(name)

    def _weight(self):
        return F.col(self._of("weightCol")) if self.isDefined("weightCol") else F.lit(1)

    def _mean(self, rows: DataFrame, name: str) -> float | None:
        if not self.isDefined("weightCol"):
            return rows.agg(F.avg(name)).first()[0]
        weight, value = self._weight(), F.col(name)
        known = F.sum(F.when(value.isNotNull(), weight))
        return rows.agg(F.try_divide(F.sum(value * weight), known)).first()[0]

    def _filled(self, df: DataFrame, mean: float) -> DataFrame:
        """The number with missing values at the training mean, and a flag beside."""
        name = self._of("numberCol")
        return df.withColumns(
            {
                f"{name}_known": F.col(name).isNotNull().cast("double"),
                f"{name}_filled": F.coalesce(F.col(name).cast("double"), F.lit(mean)),
            }
        )


class _TableWriter(MLWriter):
    def __init__(self, instance: _TableModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        extra = {"numbers": self.instance.numbers, "tables": sorted(self.instance.tables)}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extra)
        for name, table in self.instance.tables.items():
            table.write.parquet(f"{path}/levels/{name}")


class _TableReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        tables = {t: measured(spark.read.parquet(f"{path}/levels/{t}")) for t in metadata["tables"]}
        model = self.kind(tables, metadata["numbers"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _TableModel(Model, _Columns, MLReadable, MLWritable):
    """A fitted encoding: one table of levels for each predictor, and a few numbers."""

    def __init__(self, tables: dict[str, DataFrame] | None = None, numbers: dict[str, float] | None = None):
        super().__init__()
        self.tables, self.numbers = tables or {}, numbers or {}

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class LevelMeans(Estimator, _Columns, DefaultParamsWritable, DefaultParamsReadable):
    """Mean price of each level, drawn towards the overall mean where its rows are few.

    Where rows have ``foldCol`` (training), the model gives a row the mean over the other
    folds, or its own price would leak into its predictor; where they have not (scoring),
    the mean over all. Levels never seen stand for the overall mean.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, numberCol=None, foldCol=None, priorRows=None, weightCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, rows: DataFrame) -> LevelMeansModel:
        c, fold, label, prior = F.col, self._of("foldCol"), self._of("labelCol"), self._of("priorRows")
        price, number = self._mean(rows, label) or 0.0, self._mean(rows, self._of("numberCol")) or 0.0
        weight = self._weight()
        s, n = F.sum(c(label) * weight), F.coalesce(F.sum(F.when(c(label).isNotNull(), weight)), F.lit(0))
        tables = {}
        for name in self._of("inputCols"):
            parts = rows.groupBy(c(name).alias("level"), c(fold).alias("fold"))
            parts = stored_lookup(parts.agg(s.alias("s"), n.alias("n")), "level_parts")
            whole = parts.groupBy("level").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
            others = left_lookup(parts, whole.withColumnsRenamed({"s": "all_s", "n": "all_n"}), ["level"])
            both = others.select("level", "fold", (c("all_s") - c("s")).alias("s"), (c("all_n") - c("n")).alias("n"))
            both = both.unionByName(whole.select("level", F.lit(None).cast("int").alias("fold"), "s", "n"))
            drawn = (F.coalesce("s", F.lit(0.0)) + price * prior) / (c("n") + prior)
            tables[name] = stored_lookup(both.select("level", "fold", drawn.alias("mean")), "level_means")
        model = LevelMeansModel(tables, {"price": price, "number": number})
        return self._copyValues(model)


class LevelMeansModel(_TableModel):
    """Adds ``<predictor>_mean``, and the number filled with its flag."""

    @property
    def price(self) -> float:
        """What levels never seen stand for."""
        return self.numbers["price"]

    @property
    def levels(self) -> dict[str, DataFrame]:
        """(level, fold, mean) of each predictor; without a fold: over all rows."""
        return self.tables

    def _transform(self, df: DataFrame) -> DataFrame:
        fold = self._of("foldCol")
        for name, table in self.tables.items():
            means = table.select(F.col("level").alias(name), F.col("fold").alias(fold), F.col("mean").alias(f"{name}_mean"))
            if fold in df.columns:
                df = left_lookup(df, means, [name, fold])
            else:
                df = left_lookup(df, means.filter(F.col(fold).isNull()).drop(fold), [name])
            df = df.withColumn(f"{name}_mean", F.coalesce(f"{name}_mean", F.lit(self.price)))
        return self._filled(df, self.numbers["number"])


class LevelCodes(Estimator, _Columns, DefaultParamsWritable, DefaultParamsReadable):
    """Levels numbered in byte order, for one-hot vectors.

    The base level (the first, unless ``dropFirst`` is off), levels never seen and missing
    values get the number after the last, which a one-hot encoder told to keep invalid values
    turns into zeros. So k levels are k - 1 features, as in a model formula.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, numberCol=None, dropFirst=None, weightCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, rows: DataFrame) -> LevelCodesModel:
        tables, numbers = {}, {}
        base = int(self._of("dropFirst"))
        for name in self._of("inputCols"):
            levels = rows.select(F.col(name).alias("level")).filter("level IS NOT NULL").distinct()
            codes = numbered(levels, "level", name="code").select("level", (F.col("code") - base).alias("code"))
            tables[name] = stored_lookup(codes.filter("code >= 0"), "level_codes")
            numbers[name] = float(tables[name].count())
        numbers["number"] = self._mean(rows, self._of("numberCol")) or 0.0
        return self._copyValues(LevelCodesModel(tables, numbers))


class LevelCodesModel(_TableModel):
    """Adds ``<predictor>_code``, and the number filled with its flag."""

    def features(self) -> dict[str, int]:
        """How many one-hot features each predictor has; the base level has none."""
        return {name: int(self.numbers[name]) for name in self.tables}

    def _transform(self, df: DataFrame) -> DataFrame:
        for name, table in self.tables.items():
            codes = table.select(F.col("level").alias(name), F.col("code").cast("double").alias(f"{name}_code"))
            df = left_lookup(df, codes, [name])
            df = df.withColumn(f"{name}_code", F.coalesce(f"{name}_code", F.lit(self.numbers[name])))
        return self._filled(df, self.numbers["number"])
