"""Mean imputation and standardisation fitted on train, as one projection each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _number(name: str):
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def column_means(train: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Mean per column without missing values; None when a column has no value."""
    row = train.agg(*[F.avg(_number(c)).alias(c) for c in columns]).first()
    return row.asDict()


def impute_means(df: DataFrame, means: dict[str, float | None]) -> DataFrame:
    """Missing values replaced by the train mean. Columns without a mean go."""
    empty = [c for c, mean in means.items() if mean is None]
    filled = {c: F.coalesce(_number(c), F.lit(mean)) for c, mean in means.items() if mean is not None}
    return df.drop(*empty).withColumns(filled)


def standardize(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(value - mean) / population deviation of train; a constant column is only
    centred. Missing values stay missing."""
    row = train.agg(
        *[F.avg(_number(c)).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(_number(c)).alias(f"dev_{c}") for c in columns],
    ).first()
    scaled = {}
    for c in columns:
        mean, deviation = row[f"mean_{c}"], row[f"dev_{c}"]
        scaled[c] = (_number(c) - F.lit(mean)) / F.lit(deviation or 1.0)
    return df.withColumns(scaled)
