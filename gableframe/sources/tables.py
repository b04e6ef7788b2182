"""Readers and writers of the raw, split, cleaned and feature tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SPLITS, CleanSettings
from ..schema import (
    LOOKUP_TYPES,
    RAW_TYPES,
    REQUEST_FIELDS,
    REQUIRED_FIELDS,
    SAMPLE_REQUEST,
    require_columns,
)
from .workspace import path_exists

# Spellings of a missing value in CSV files.
MISSING_TEXT = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
# A header line, and quotes doubled inside quoted text.
_CSV = {"header": True, "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] = RAW_TYPES,
    keep_text: Sequence[str] = (),
    row_id: str | None = "row_id",
) -> DataFrame:
    """CSV with a header, typed by column *name*, in whatever order the file has.

    The usual spellings of a missing value are null. Unknown columns and ``keep_text`` stay text. Other columns are cast strictly:
    bad text fails the job instead of turning into nulls. ``row_id`` adds the
    place of the row in the files (path, block, row), which orders rows as they
    were written without a shuffle.
    """
    with _missing_is_an_error(path):
        raw = spark.read.options(**_CSV, enforceSchema=False).csv(path)
    out = []
    for name in raw.columns:
        text = F.col(f"`{name}`")
        value = F.when(~text.isin(*MISSING_TEXT), text)
        if name in types and name not in keep_text:
            if types[name] in ("int", "bigint"):  # 30301.0 is written where a column has gaps
                value = F.regexp_replace(value, r"^(\s*[+-]?\d+)\.0*\s*$", "$1")
            value = value.cast(types[name])
        out.append(value.alias(name))
    if row_id and row_id not in raw.columns:
        out.append(_place().alias(row_id))
    return raw.select(*out)


def read_parquet(spark: SparkSession, path: str, row_id: str | None = None) -> DataFrame:
    with _missing_is_an_error(path):
        df = spark.read.parquet(path)
    if row_id and row_id not in df.columns:
        df = df.withColumn(row_id, _place())
    return df


@contextmanager
def _missing_is_an_error(path: str):
    """A missing input under its usual Python error; the files are listed once."""
    try:
        yield
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Input not found: {path}") from error
        raise


def _place():
    return F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_table(
    spark: SparkSession, path: str, types: Mapping[str, str] = RAW_TYPES
) -> DataFrame:
    """CSV by its file ending, Parquet otherwise; always with row ids."""
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        return read_csv(spark, path, types)
    return read_parquet(spark, path, row_id="row_id")


def read_lookup(spark: SparkSession, path: str | None, cfg: CleanSettings) -> DataFrame | None:
    """The location lookup, or None when no path is given, it does not exist or
    it lacks one of its three columns."""
    if path is None or not path_exists(spark, path):
        return None
    df = read_table(spark, path, types=LOOKUP_TYPES)
    needed = {cfg.metro_column, cfg.latitude_column, cfg.longitude_column}
    return df if needed <= set(df.columns) else None


def read_upload(spark: SparkSession, path: str) -> DataFrame:
    """CSV for batch scoring; the four required columns must be there."""
    df = read_csv(spark, path, types={**RAW_TYPES, **REQUEST_FIELDS})
    require_columns(df, REQUIRED_FIELDS, "Upload")
    return df


def write_splits(
    df: DataFrame, path: str, split_column: str = "split", produced: Sequence[str] = ()
) -> None:
    """One folder per split. The splits in ``produced`` are replaced whole: one
    without rows becomes a folder with an empty table, so that no rows of an
    earlier write stay. Of other splits only those that occur are replaced."""
    spark = df.sparkSession
    empty = spark.createDataFrame([], df.drop(split_column).schema)
    for name in produced:
        empty.write.mode("overwrite").parquet(f"{path}/{split_column}={name}")
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(split_column)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**_CSV, **spaces).csv(path)


def read_splits(
    spark: SparkSession,
    path: str,
    splits: Sequence[str] = SPLITS,
    split_column: str = "split",
) -> DataFrame:
    """The named splits of a stage (partition pruning); all that are absent are
    listed in the error. A split that was written without rows is there."""
    df = read_parquet(spark, path)
    absent = [s for s in splits if not path_exists(spark, f"{path}/{split_column}={s}")]
    if absent:
        raise FileNotFoundError(f"Split not found in {path}: {absent}")
    return df.where(F.col(split_column).isin(*splits))


def sample_requests(spark: SparkSession) -> DataFrame:
    """Two complete example requests, for a sample file."""
    second = {**SAMPLE_REQUEST, "zipcode": 80211, "homes_sold": 96.0, "inventory": 143.0}
    types = ", ".join(f"{name} {REQUEST_FIELDS[name]}" for name in SAMPLE_REQUEST)
    return spark.createDataFrame([tuple(r.values()) for r in (SAMPLE_REQUEST, second)], types)


def read_feature_names(
    spark: SparkSession, path: str, target: str = "price", not_features: Sequence[str] = ("split", "row_id")
) -> list[str]:
    """Train feature names in order, from the schema alone."""
    df = read_parquet(spark, path)
    return [c for c in df.columns if c != target and c not in not_features]
