"""Temporal split: one tagged table instead of three."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SplitSettings
from ..functions.dates import as_timestamp
from ..schema import require_columns


def split_by_date(df: DataFrame, cfg: SplitSettings) -> DataFrame:
    """Tag every row train, eval or holdout by its date, in one narrow pass.

    Train ends before ``eval_start``; eval ends before ``holdout_start``. Rows
    without a date belong to no split and are dropped.
    """
    require_columns(df, [cfg.date_column])
    eval_start = datetime.fromisoformat(cfg.eval_start)
    holdout_start = datetime.fromisoformat(cfg.holdout_start)
    if eval_start >= holdout_start:
        raise ValueError("eval_start must be earlier than holdout_start.")
    date = F.col(cfg.date_column)
    kind = df.withColumn(cfg.date_column, as_timestamp(df, cfg.date_column))
    type_name = kind.schema[cfg.date_column].dataType.simpleString()
    first_eval, first_holdout = (
        F.lit(day.isoformat(sep=" ")).cast(type_name) for day in (eval_start, holdout_start)
    )
    return kind.where(date.isNotNull()).withColumn(
        cfg.split_column,
        F.when(date < first_eval, "train").when(date < first_holdout, "eval").otherwise("holdout"),
    )


def rows_of_split(df: DataFrame, cfg: SplitSettings, name: str) -> DataFrame:
    """The rows of one split, by a plain range of the date column as it is stored, so
    that files and row groups of the other periods are not read. Dates that are text
    are read by value and give the same rows without that saving."""
    bounds = {"train": (None, cfg.eval_start), "eval": (cfg.eval_start, cfg.holdout_start), "holdout": (cfg.holdout_start, None)}
    if name not in bounds:
        raise ValueError(f"Unknown split: {name}")
    require_columns(df, [cfg.date_column])
    kind = df.schema[cfg.date_column].dataType
    if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return split_by_date(df, cfg).where(F.col(cfg.split_column) == name)
    rows, date = df, F.col(cfg.date_column)
    first, after = (b and datetime.fromisoformat(b) for b in bounds[name])
    # a date is compared as a date: the first moment of a day decides, as it does there
    bound = lambda day: F.lit(day.date() if isinstance(kind, T.DateType) else day.isoformat(sep=" ")).cast(kind)
    if first is not None:
        rows = rows.where(date >= bound(first))
    rows = rows.where(date < bound(after)) if after is not None else rows.where(date.isNotNull())
    tagged = rows.withColumn(cfg.split_column, F.lit(name))
    return tagged.withColumn(cfg.date_column, as_timestamp(tagged, cfg.date_column))


def split_profile(df: DataFrame, cfg: SplitSettings) -> DataFrame:
    """Rows, columns, first and last date of every split."""
    data_columns = len([c for c in df.columns if c != cfg.split_column])
    return df.groupBy(cfg.split_column).agg(
        F.count("*").alias("n_rows"),
        F.lit(data_columns).cast("bigint").alias("n_columns"),
        F.min(cfg.date_column).alias("first_date"),
        F.max(cfg.date_column).alias("last_date"),
    )
