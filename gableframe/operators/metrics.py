"""Regression metrics as aggregates, long metric tables, model choice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("mae", "rmse", "r2")


def regression_metrics(actual: Column, predicted: Column) -> dict[str, Column]:
    """MAE, RMSE and R2 as aggregate expressions over rows that have both values.

    R2 is 1 - SS_res / SS_tot. A constant target gives 1 when every error is 0
    and 0 otherwise; fewer than two rows give NaN.
    """
    error = (predicted - actual).cast("double")
    error = F.when(~F.isnan(error), error)
    known = F.when(error.isNotNull(), actual.cast("double"))
    n, squares = F.count(error), F.sum(error * error)
    total = F.var_pop(known) * n
    r2 = (
        F.when(n < 2, F.lit(float("nan")))
        .when(total > 0, 1 - squares / F.nullif(total, F.lit(0.0)))
        .when(squares == 0, 1.0)
        .otherwise(0.0)
    )
    return {"mae": F.avg(F.abs(error)), "rmse": F.sqrt(F.avg(error * error)), "r2": r2}


def evaluate(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """One row of metrics per group; one row in all without ``by``."""
    metrics = regression_metrics(F.col(actual), F.col(predicted))
    return df.groupBy(*by).agg(*[value.alias(name) for name, value in metrics.items()])


def evaluate_candidates(
    df: DataFrame, actual: str, predicted: Mapping[str, str], split_column: str = "split"
) -> DataFrame:
    """Long table (model, split, metric, value) for many models in one pass.

    ``predicted`` maps each model to its prediction column.
    """
    exprs = []
    for model, column in predicted.items():
        metrics = regression_metrics(F.col(actual), F.col(column))
        exprs.append(F.struct(*[metrics[m].alias(m) for m in METRICS]).alias(f"m_{model}"))
    wide = df.groupBy(split_column).agg(*exprs)
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(metric).alias("metric"),
            F.col(f"m_{model}.{metric}").alias("value"),
        )
        for model in predicted
        for metric in METRICS
    ]
    long = wide.select(F.col(split_column).alias("split"), F.inline(F.array(*rows)))
    return long.select("model", "split", "metric", "value")


def with_gap(metrics: DataFrame) -> DataFrame:
    """Train and eval values plus ``gap`` = eval - train, for metrics on both."""
    wide = metrics.groupBy("model", "metric").pivot("split", ["train", "eval"]).agg(F.max("value"))
    rows = [
        F.struct(F.lit(name).alias("split"), value.alias("value"))
        for name, value in (
            ("train", F.col("train")),
            ("eval", F.col("eval")),
            ("gap", F.col("eval") - F.col("train")),
        )
    ]
    long = wide.select("model", "metric", F.inline(F.array(*rows)))
    return long.where("value is not null").select("model", "split", "metric", "value")


def scored_rows(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows that have both values, with the absolute error."""
    error = F.abs(F.col(predicted) - F.col(actual))
    return df.dropna(subset=[actual, predicted]).withColumn("absolute_error", error)


def scored_error(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Count, MAE and RMSE over the scored rows."""
    rows = scored_rows(df, actual, predicted)
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.avg("absolute_error").alias("mae"),
        F.sqrt(F.avg(F.col("absolute_error") * F.col("absolute_error"))).alias("rmse"),
    )


def best_model(
    metrics: DataFrame,
    candidates: Sequence[str],
    primary_metric: str = "rmse",
    direction: str = "min",
) -> DataFrame:
    """One row: the model with the lowest eval value; the earlier candidate wins
    a tie. A candidate without the metric is an error."""
    if not candidates:
        raise ValueError("There are no candidate models.")
    if direction not in ("min", "max"):
        raise ValueError("direction is min or max")
    of_eval = metrics.where((F.col("split") == "eval") & (F.col("metric") == primary_metric))
    rank = F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col("model"))
    found = of_eval.where(F.col("value").isNotNull() & (rank > 0))
    absent = F.array_except(
        F.array(*[F.lit(c) for c in candidates]), F.coalesce(F.collect_set("model"), F.array().cast("array<string>"))
    )
    guard = found.agg(
        F.when(
            F.size(absent) > 0,
            F.raise_error(
                F.concat(F.lit(f"Missing metric '{primary_metric}' for models: "), F.array_join(absent, ", "))
            ),
        ).otherwise(F.lit(True))
    )
    value = F.col("value") if direction == "min" else -F.col("value")
    return (
        found.where(guard.scalar())
        .orderBy(value, rank)
        .limit(1)
        .select("model", F.lit(primary_metric).alias("metric"), "value")
    )
