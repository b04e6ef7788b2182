"""Scoring: files (cleaned like training data) and single records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ScoreSettings, Settings
from ..operators.clean import clean, merge_locations, within_price_limit
from ..operators.encode import Encoders
from ..operators.features import align_features, build_features
from ..operators.metrics import evaluate
from ..operators.requests import missing_fields, to_raw_names
from ..schema import DEMOGRAPHIC_NAMES, OPTIONAL_FIELDS, REQUIRED_FIELDS, require_columns
from .candidates import FEATURES, SCALED, used_columns


@dataclass(frozen=True)
class Artifacts:
    """All that scoring needs, loaded once per job."""

    model: PipelineModel
    encoders: Encoders
    train_columns: tuple[str, ...]
    version: str = "unversioned"
    source: str = "local"


def apply_model(features: DataFrame, model: PipelineModel, cfg: ScoreSettings) -> DataFrame:
    """The prediction as a column; the model's helper columns are dropped."""
    helpers = [f"{c}__filled" for c in used_columns(model)]
    scored = model.transform(features).drop(*helpers, FEATURES, SCALED)
    return scored.withColumnRenamed("prediction", cfg.prediction_column)


def with_actuals(scored: DataFrame, target: str, cfg: ScoreSettings) -> DataFrame:
    """Actual value and error (prediction - actual) next to the prediction."""
    error = F.col(cfg.prediction_column) - F.col(target)
    return scored.withColumn(cfg.actual_column, F.col(target)).withColumn(cfg.error_column, error).drop(target)


def score_table(
    df: DataFrame,
    artifacts: Artifacts,
    lookup: DataFrame | None,
    cfg: Settings,
    carry: Sequence[str] = ("row_id",),
) -> DataFrame:
    """Score a raw table the way training data is treated: it is cleaned first, so
    duplicates and price outliers are missing from the output.

    What comes first among duplicates is the row order of the input.
    """
    target = cfg.features.target_column
    cleaned = clean(df, lookup, cfg.clean, cfg.broadcast, order=cfg.clean.row_order)
    built = build_features(cleaned, artifacts.encoders, cfg)
    kept = [c for c in carry if c in built.columns]
    if target in built.columns:
        actual = "__actual"
        built = built.withColumnRenamed(target, actual)
        aligned = align_features(built, artifacts.train_columns, [*kept, actual])
        scored = apply_model(aligned, artifacts.model, cfg.score)
        return with_actuals(scored, actual, cfg.score)
    aligned = align_features(built, artifacts.train_columns, kept)
    return apply_model(aligned, artifacts.model, cfg.score)


def scoring_metrics(scored: DataFrame, cfg: ScoreSettings) -> DataFrame | None:
    """MAE, RMSE and R2 in one row, or None when there are no actual values."""
    if cfg.actual_column not in scored.columns:
        return None
    return evaluate(scored, cfg.actual_column, cfg.prediction_column)


def score_records(
    requests: DataFrame,
    artifacts: Artifacts,
    lookup: DataFrame | None,
    cfg: Settings,
    carry: Sequence[str] = ("request_id",),
) -> DataFrame:
    """Score typed requests, each on its own terms, in one narrow plan.

    No duplicate removal, so every request gives one row. An optional field
    without a value counts as absent and becomes 0; an unmatched place stays
    missing and is imputed. A request above the price limit, without a required
    field or with a date that is none gets no prediction but a reason; it never
    fails the others. Works on a stream: there is no aggregation or state.
    """
    require_columns(requests, REQUIRED_FIELDS, "Request")
    target = cfg.features.target_column
    raw_optional = [DEMOGRAPHIC_NAMES.get(n, n) for n in OPTIONAL_FIELDS]
    present = [n for n in raw_optional if n in artifacts.train_columns]
    rows = requests.withColumn("missing_features", missing_fields(requests))
    date = cfg.features.date_column
    parsed = F.col(date)
    if isinstance(requests.schema[date].dataType, T.StringType):
        parsed = F.try_to_timestamp(date)
    absent = reduce(Column.__or__, [F.col(c).isNull() for c in REQUIRED_FIELDS])
    reason = F.when(absent, "missing_required").when(parsed.isNull(), "invalid_date")
    if cfg.clean.outlier_column in requests.columns:
        reason = reason.when(~within_price_limit(requests, cfg.clean), "price_above_limit")
    rows = to_raw_names(rows.withColumns({"reject_reason": reason, date: parsed}))
    placed = merge_locations(rows, lookup, cfg.clean, cfg.broadcast)
    extra = [target] if target in requests.columns else []
    kept = [*carry, *extra, "missing_features", "reject_reason"]
    built = build_features(placed, artifacts.encoders, cfg)
    aligned = align_features(built, artifacts.train_columns, kept, fill_nulls=present)
    scored = apply_model(aligned, artifacts.model, cfg.score)
    price = F.when(F.col("reject_reason").isNull(), F.col(cfg.score.prediction_column))
    return scored.select(
        *carry,
        *extra,
        price.alias(cfg.score.prediction_column),
        F.lit(artifacts.version).alias("model_version"),
        "missing_features",
        F.size("missing_features").alias("missing_optional_count"),
        "reject_reason",
    )


def rows_predicted(scored: DataFrame, batch_column: str, cfg: ScoreSettings) -> DataFrame:
    """Predictions per batch."""
    return scored.groupBy(batch_column).agg(F.count(cfg.prediction_column).alias("rows_predicted"))


