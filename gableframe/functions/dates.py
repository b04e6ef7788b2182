"""Date parsing and parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_timestamp(df: DataFrame, column: str) -> Column:
    """Text becomes a timestamp (bad text raises under ANSI); dates and
    timestamps are kept as they are, so that filters on them still reach the scan."""
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.to_timestamp(value)
    return value


def date_parts(value: Column) -> dict[str, Column]:
    return {"year": F.year(value), "quarter": F.quarter(value), "month": F.month(value)}
