"""Descriptions, tags, aliases and metric keys of registered models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BEST_TEXT = "Lowest error of the compared regressors: %s (%s=%.4f). Saved with the errors of all that took part."
TUNED_TEXT = "Settings of %s after a seeded search; no other trial had a lower error on the eval rows (%s=%.4f)."
# Tags and aliases of the registered model artifacts.
BEST_TAGS = ("model", "best-model", "regression", "housing-price-prediction", "baseline-comparison")
TUNED_TAGS = ("model", "tuned-model", "gbt", "random-search", "regression", "housing-price-prediction")
BEST_ALIASES = ("latest", "best")
TUNED_ALIASES = ("latest", "tuned", "gbt")


def _texts(values: tuple[str, ...]) -> list[Column]:
    return [F.lit(v) for v in values]


def best_description(model: Column, metric: Column, value: Column) -> Column:
    return F.format_string(BEST_TEXT, model, metric, value)


def best_tags(model: Column, metric: Column) -> Column:
    return F.array(
        *_texts(BEST_TAGS), F.concat(F.lit("selected-"), model), F.concat(F.lit("metric-"), metric)
    )


def best_aliases(model: Column, metric: Column) -> Column:
    return F.array(*_texts(BEST_ALIASES), model, F.concat(F.lit("best-"), metric))


def tuned_description(model: Column, metric: Column, value: Column) -> Column:
    return F.format_string(TUNED_TEXT, model, metric, value)


def tuned_tags(metric: Column) -> Column:
    return F.array(*_texts(TUNED_TAGS), F.concat(F.lit("metric-"), metric))


def tuned_aliases(metric: Column) -> Column:
    return F.array(*_texts(TUNED_ALIASES), F.concat(F.lit("tuned-"), metric))


def metric_key(model: Column, split: Column, metric: Column) -> Column:
    """``model/split/metric``, the name a logged value goes by."""
    return F.concat_ws("/", model, split, metric)
