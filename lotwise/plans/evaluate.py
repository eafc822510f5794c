"""Accuracy of the additive model, stage by stage, from one scan of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.params import Params
from lotwise.plans.effects import PriceModel
from lotwise.plans.scoring import score

# fixed values: labels of the published accuracy table, with our column for each
STAGES = [
    ("stage_make", "Make Effect"),
    ("stage_model", "Make + Model Effect"),
    ("stage_trim", "Make + Model + Trim Effect"),
    ("stage_year", "Make + Model + Trim + Year Effect"),
    ("pred3", "Make + Model + Trim + Year + Mileage Effect"),
]
OVERALL = "Overall Average"
LINEAR = "Method 01 - Linear Regression"
FOREST = "Method 02 - Random Forest"


def rmse(y: Column | str, prediction: Column | str) -> Column:
    """Root mean squared error as an aggregate."""
    y = F.col(y) if isinstance(y, str) else y
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.sqrt(F.avg(F.pow(y - prediction, 2)))


def impute_missing_prediction(df: DataFrame, prediction: str) -> DataFrame:
    """Missing predictions become the mean of the others. For evaluation only."""
    mean = df.agg(F.avg(prediction)).scalar()
    return df.withColumn(prediction, F.coalesce(F.col(prediction), mean))


def imputed_rmse(y: str, prediction: str, where: Column) -> Column:
    """RMSE with missing predictions set to the mean of the others, in a single pass.

    The missing rows' share follows from their count, sum and sum of squares:
    sum (y - m)^2 = sum y^2 - 2 m sum y + n m^2.
    """
    known = where & F.col(prediction).isNotNull()
    missing = where & F.col(prediction).isNull()
    y, pred = F.col(y), F.col(prediction)
    mean = F.avg(F.when(known, pred))
    error = F.sum(F.when(known, F.pow(y - pred, 2)).otherwise(0.0))
    n = F.count_if(missing)
    s1 = F.sum(F.when(missing, y).otherwise(0.0))
    s2 = F.sum(F.when(missing, y * y).otherwise(0.0))
    rest = F.when(n > 0, s2 - 2 * mean * s1 + n * mean * mean).otherwise(0.0)
    return F.sqrt((error + rest) / F.count_if(where))


def _metric_row(df: DataFrame, method_column: str, label: str, split: str, value: Column, before: Column) -> DataFrame:
    return df.select(
        F.lit(label).alias(method_column),
        F.lit(split).alias("split"),
        value.alias("rmse"),
        (before - value).alias("improvement"),
    )


def overall_rmse(split_rows: DataFrame) -> DataFrame:
    """Mean training price, and the error of predicting it everywhere."""
    return split_rows.filter(F.col("split") == "train").agg(
        F.avg("price").alias("mu"), F.stddev_pop("price").alias("rmse")
    )


def stage_errors(split_rows: DataFrame, m: PriceModel, p: Params = Params()) -> DataFrame:
    """One row: the error of the constant on train, of each stage on test, of the last
    stage on validation."""
    scored = score(split_rows.filter(F.col("split") != "train"), m, p)
    test, validation = F.col("split") == "test", F.col("split") == "validation"
    errors = scored.agg(
        *[imputed_rmse("price", c, test).alias(f"rmse_{c}") for c, _ in STAGES],
        imputed_rmse("price", "pred3", validation).alias("rmse_validation"),
    )
    naive = overall_rmse(split_rows).select("rmse").scalar()
    return errors.withColumn("rmse_overall", naive)


def rmse_ladder(errors: DataFrame) -> DataFrame:
    """(stage, method, split, rmse, improvement over the stage before)."""
    columns = ["rmse_overall"] + [f"rmse_{c}" for c, _ in STAGES]
    labels = [OVERALL] + [label for _, label in STAGES]
    parts = []
    for i, (column, label) in enumerate(zip(columns, labels)):
        before = columns[max(i - 1, 0)]
        split = "test" if i else "train"
        parts.append(f"{i}, '{label}', '{split}', {column}, {before} - {column}")
    return errors.select(
        F.expr(
            f"stack({len(parts)}, {', '.join(parts)}) "
            "AS (stage, method_on_train_test, split, rmse, improvement)"
        )
    )


def validation_score(errors: DataFrame) -> DataFrame:
    """The full model on the validation rows, against the same model on the test rows."""
    return _metric_row(
        errors,
        "method_on_validation",
        LINEAR,
        "validation",
        F.col("rmse_validation"),
        F.col(f"rmse_{STAGES[-1][0]}"),
    )


def metrics_log(errors: DataFrame, *more: DataFrame) -> DataFrame:
    """Ladder, validation and any further metric rows in one table; columns that a
    row does not have are null."""
    out = rmse_ladder(errors)
    for rows in (validation_score(errors), *more):
        out = out.unionByName(rows, allowMissingColumns=True)
    return out
