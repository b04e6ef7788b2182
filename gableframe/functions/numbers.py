"""Lenient numbers, missing values, and seeded keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings that count as a number. Spark alone would also take '1d' and '1f'.
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def number_in_text(value: Column) -> Column:
    """Text as a double; null when it is not a number. The pattern runs only on
    the few texts that Spark reads as a number and others do not."""
    number = value.try_cast("double")
    ends = F.substring(F.trim(value), -1, 1).isin("d", "D", "f", "F")
    doubtful = number.isNotNull() & (ends | F.contains(F.lower(value), F.lit("x")))
    return F.when(~doubtful | value.rlike(_NUMBER), number)


def lenient_double(df: DataFrame, column: str) -> Column:
    """The column as a double; text that is not a number becomes null."""
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, T.StringType):
        return number_in_text(value)
    return value.cast("double")


def missing_as_null(df: DataFrame, column: str) -> Column:
    """The column with NaN as null: in a floating column both are a missing value."""
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to null in every floating column, in one projection."""
    return df.select(*[missing_as_null(df, c).alias(c) for c in df.columns])


def seeded_key(seed: int, *columns: Column) -> Column:
    """32 hexadecimal digits that depend on the seed and the columns only."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def uniform_from(key: Column) -> Column:
    """A number in [0, 1) from the first 13 digits (52 bits) of a key."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
