"""Date features, column drops, schema alignment and the feature frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Settings
from ..functions.dates import as_timestamp, date_parts
from ..schema import require_columns
from .encode import Encoders, apply_encoders, fit_encoders


def add_date_features(df: DataFrame, date_column: str = "date") -> DataFrame:
    """Year, quarter and month right after the date; existing ones are replaced."""
    require_columns(df, [date_column])
    parsed = as_timestamp(df, date_column)
    parts = date_parts(parsed)
    out = []
    for name in df.columns:
        if name == date_column:
            out.append(parsed.alias(name))
            out += [value.alias(part) for part, value in parts.items()]
        elif name not in parts:
            out.append(F.col(f"`{name}`"))
    return df.select(*out)


def drop_unused(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without the raw key, date and leaking columns; absent names are ignored."""
    return df.drop(*columns)


def build_features(df: DataFrame, encoders: Encoders, cfg: Settings) -> DataFrame:
    """Date features, then each fitted encoder, then the drops."""
    dated = add_date_features(df, cfg.features.date_column)
    encoded = apply_encoders(dated, encoders, cfg.features, cfg.broadcast)
    return drop_unused(encoded, cfg.features.drop_columns)


def engineer_features(df: DataFrame, cfg: Settings) -> tuple[DataFrame, Encoders]:
    """Fit on the train rows of a tagged table, apply to all of it."""
    split = F.col(cfg.split.split_column)
    encoders = fit_encoders(df.where(split == "train"), cfg.features)
    return build_features(df, encoders, cfg), encoders


def align_features(
    df: DataFrame, train_columns: Sequence[str], carry: Sequence[str] = (), fill_nulls: Sequence[str] = ()
) -> DataFrame:
    """Exactly the train columns in train order, after the ``carry`` columns.

    A column that is absent becomes 0; a missing value in a column that is there
    stays missing, except in ``fill_nulls`` (single-record scoring, where a
    field that was not sent counts as an absent column).
    """
    filled = set(fill_nulls)

    def one(name: str):
        if name not in df.columns:
            return F.lit(0).alias(name)
        value = F.col(f"`{name}`")
        if name not in filled:
            return value
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            value = F.nanvl(value, F.lit(0.0))
        return F.coalesce(value, F.lit(0)).alias(name)

    return df.select(*[F.col(f"`{c}`") for c in carry], *[one(c) for c in train_columns])
