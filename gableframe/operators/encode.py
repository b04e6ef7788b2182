"""Frequency and target encoders, held as tables and fitted on train only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BroadcastBound, FeatureSettings
from ..functions.numbers import missing_as_null
from ..schema import require_columns
from ..sources.workspace import materialize, path_exists
from .lookup import lookup_join


@dataclass(frozen=True)
class TargetEncoding:
    """Per key the count, mean and smoothed encoding; ``prior`` for other keys."""

    table: DataFrame
    prior: float | None


@dataclass(frozen=True)
class Encoders:
    frequency: DataFrame | None = None
    target: TargetEncoding | None = None


def fit_frequency(train: DataFrame, column: str) -> DataFrame:
    """Rows per value on train; null is a value. Counts are combined in each
    task before the shuffle, so a hot value costs one row per task."""
    require_columns(train, [column], "Train data")
    key = missing_as_null(train, column).alias(column)
    return train.groupBy(key).agg(F.count("*").alias(f"{column}_freq"))


def apply_frequency(
    df: DataFrame, column: str, table: DataFrame, bound: BroadcastBound
) -> DataFrame:
    """Adds ``{column}_freq``; 0 for values not seen on train."""
    if column not in df.columns:
        return df
    name = f"{column}_freq"
    joined = lookup_join(df.drop(name), table, column, column, [name], bound)
    return joined.withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))


def fit_target(
    train: DataFrame, column: str, target: str, cfg: FeatureSettings
) -> TargetEncoding:
    """Smoothed mean of the target per value, fitted in one scan of train.

    w = 1 / (1 + exp(-(n - midpoint) / width)); encoding = prior * (1 - w) +
    mean * w; prior = mean of the target. Rows without a target do not count.
    """
    require_columns(train, [column, target], "Train data")
    label = F.col(target).cast("double")
    known = train.where(label.isNotNull() & ~F.isnan(label))
    sums = known.groupBy(missing_as_null(known, column).alias(column)).agg(F.count("*").alias("n"), F.sum(label).alias("total"))
    sums = materialize(sums, "target-sums")
    prior = sums.agg(F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).first()[0]
    mean = F.col("total") / F.col("n")
    weight = 1 / (1 + F.exp((F.lit(cfg.smoothing_midpoint) - F.col("n")) / F.lit(cfg.smoothing_width)))
    table = sums.select(
        column,
        "n",
        mean.alias("mean"),
        (F.lit(prior) * (1 - weight) + mean * weight).alias(f"{column}_encoded"),
    )
    return TargetEncoding(table, prior)


def apply_target(
    df: DataFrame, column: str, encoding: TargetEncoding, bound: BroadcastBound
) -> DataFrame:
    """Adds ``{column}_encoded``; the prior for values not seen on train."""
    if column not in df.columns:
        return df
    name = f"{column}_encoded"
    joined = lookup_join(df.drop(name), encoding.table, column, column, [name], bound)
    return joined.withColumn(name, F.coalesce(name, F.lit(encoding.prior)))


def fit_encoders(train: DataFrame, cfg: FeatureSettings) -> Encoders:
    """Both encoders; each is skipped when train lacks its column."""
    frequency = target = None
    if cfg.frequency_column in train.columns:
        frequency = materialize(fit_frequency(train, cfg.frequency_column), "frequency")
    if cfg.target_encode_column in train.columns:
        target = fit_target(train, cfg.target_encode_column, cfg.target_column, cfg)
    return Encoders(frequency, target)


def apply_encoders(
    df: DataFrame, encoders: Encoders, cfg: FeatureSettings, bound: BroadcastBound
) -> DataFrame:
    if encoders.frequency is not None:
        df = apply_frequency(df, cfg.frequency_column, encoders.frequency, bound)
    if encoders.target is not None:
        df = apply_target(df, cfg.target_encode_column, encoders.target, bound)
    return df


def save_encoders(encoders: Encoders, folder: str) -> None:
    """Each encoder as a Parquet table, only when fitted."""
    if encoders.frequency is not None:
        encoders.frequency.write.mode("overwrite").parquet(f"{folder}/frequency")
    if encoders.target is not None:
        table = encoders.target.table.withColumn("prior", F.lit(encoders.target.prior).cast("double"))
        table.write.mode("overwrite").parquet(f"{folder}/target")


def load_encoders(spark: SparkSession, folder: str) -> Encoders:
    """Fitted encoders; one that was not saved is absent and its step is skipped."""
    frequency = target = None
    if path_exists(spark, f"{folder}/frequency"):
        frequency = spark.read.parquet(f"{folder}/frequency")
    if path_exists(spark, f"{folder}/target"):
        table = spark.read.parquet(f"{folder}/target")
        row = table.select("prior").first()
        target = TargetEncoding(table.drop("prior"), row[0] if row else None)
    return Encoders(frequency, target)
