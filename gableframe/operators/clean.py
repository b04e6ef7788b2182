"""Cleaning: location lookup, duplicate removal, price outliers, audit."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import BroadcastBound, CleanSettings
from ..functions.numbers import lenient_double, missing_as_null
from ..functions.text import normalize_city, normalize_metro, replace_mapped
from ..sources.workspace import materialize
from .lookup import lookup_join


def _keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every group of equal keys (missing equals missing).

    ``row_number() = 1`` lets Spark keep one row per group in every task before
    the shuffle, so a group holding a third of the table sends one row per task.
    The hash in front makes the two sorts compare one long instead of all keys;
    equality is still decided by the keys themselves.
    """
    columns = [missing_as_null(df, k) for k in keys]
    window = W.partitionBy(F.xxhash64(*columns), *columns).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def normalize_cities(df: DataFrame, cfg: CleanSettings) -> DataFrame:
    """Normalised and mapped city names; unchanged when the column is absent."""
    if cfg.city_column not in df.columns:
        return df
    city = replace_mapped(normalize_city(F.col(cfg.city_column)), cfg.city_mapping)
    return df.withColumn(cfg.city_column, city)


def lookup_keep_first(lookup: DataFrame, cfg: CleanSettings) -> DataFrame:
    """One row per normalised metro name: the first in file order."""
    order = [F.col(c).asc_nulls_last() for c in cfg.row_order if c in lookup.columns]
    named = lookup.withColumn(cfg.metro_column, normalize_metro(F.col(cfg.metro_column)))
    if not order:
        raise ValueError(f"The lookup needs its row order in {cfg.row_order}.")
    first = _keep_first(named, [cfg.metro_column], order)
    return first.select(cfg.metro_column, cfg.latitude_column, cfg.longitude_column)


def lookup_usable(df: DataFrame, lookup: DataFrame | None, cfg: CleanSettings) -> bool:
    """Whether the location join applies: there is a city, there is a complete
    lookup, and the table does not have both coordinates already."""
    places = {cfg.latitude_column, cfg.longitude_column}
    if cfg.city_column not in df.columns or lookup is None:
        return False
    if places <= set(df.columns):
        return False
    if not places.isdisjoint(df.columns):
        raise ValueError(f"Table has only one of {sorted(places)}; give both or none.")
    return {cfg.metro_column, *places} <= set(lookup.columns)


def join_locations(
    df: DataFrame, lookup: DataFrame | None, cfg: CleanSettings, bound: BroadcastBound
) -> DataFrame:
    """Coordinates for normalised city names by null-safe left join. The reduced
    lookup is written once: it is counted, then joined, on a stream many times."""
    if not lookup_usable(df, lookup, cfg):
        return df
    return lookup_join(
        df,
        materialize(lookup_keep_first(lookup, cfg), "lookup"),
        cfg.city_column,
        cfg.metro_column,
        [cfg.latitude_column, cfg.longitude_column],
        bound,
    )


def merge_locations(
    df: DataFrame, lookup: DataFrame | None, cfg: CleanSettings, bound: BroadcastBound
) -> DataFrame:
    """Normalise the city, then join its coordinates."""
    return join_locations(normalize_cities(df, cfg), lookup, cfg, bound)


def unmatched_cities(df: DataFrame, cfg: CleanSettings) -> DataFrame:
    """Sorted distinct cities that have no latitude."""
    missing = df.where(F.col(cfg.latitude_column).isNull()).select(cfg.city_column)
    return missing.distinct().orderBy(cfg.city_column)


def compared_columns(df: DataFrame, cfg: CleanSettings, group: Sequence[str] = ()) -> list[str]:
    """Columns that decide whether two rows are duplicates; empty when only
    ignored columns exist."""
    skip = {*cfg.duplicate_ignore, *cfg.row_order}
    data = [c for c in df.columns if c not in skip and c not in group]
    return [*group, *data] if data else []


def drop_duplicates_keep_first(
    df: DataFrame,
    cfg: CleanSettings,
    group: Sequence[str] = (),
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the first of rows equal in everything but date and year.

    ``group`` (the split) bounds the comparison. ``order`` says what first
    means; the default is the date, then the row order. Scoring input keeps its
    file order instead, as its dates may be missing.
    """
    keys = compared_columns(df, cfg, group)
    if not keys:
        return df
    default = [c for c in (*cfg.duplicate_ignore[:1], *cfg.row_order) if c in df.columns]
    names = list(order) if order is not None else default
    if not set(names) & set(cfg.row_order):
        raise ValueError(f"Keeping the first row needs the row order in {cfg.row_order}.")
    return _keep_first(df, keys, [F.col(c).asc_nulls_last() for c in names])


def within_price_limit(df: DataFrame, cfg: CleanSettings) -> Column:
    """True for rows to keep: missing, not-a-number and unreadable prices stay."""
    price = lenient_double(df, cfg.outlier_column)
    return price.isNull() | F.isnan(price) | (price <= F.lit(float(cfg.outlier_limit)))


def drop_price_outliers(df: DataFrame, cfg: CleanSettings) -> DataFrame:
    if cfg.outlier_column not in df.columns:
        return df
    return df.where(within_price_limit(df, cfg))


def clean(
    df: DataFrame,
    lookup: DataFrame | None,
    cfg: CleanSettings,
    bound: BroadcastBound,
    group: Sequence[str] = (),
    order: Sequence[str] | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Locations, duplicates and outliers in one plan with one wide shuffle.

    The price test comes first and the lookup last, which gives the same rows as
    the order locations, duplicates, outliers: duplicates agree in price and
    city, so a price test keeps or drops them together and the lookup adds
    nothing to compare. Fewer and narrower rows reach the shuffle.

    ``watch`` is given the rows between the two steps, for instance to count them as
    they pass; the price test then comes second.
    """
    rows = normalize_cities(df, cfg)
    late = watch is not None or cfg.outlier_column in cfg.duplicate_ignore
    if not late:
        rows = drop_price_outliers(rows, cfg)
    rows = drop_duplicates_keep_first(rows, cfg, group, order)
    if watch is not None:
        rows = watch(rows)
    if late:
        rows = drop_price_outliers(rows, cfg)
    return join_locations(rows, lookup, cfg, bound)


def cleaning_audit(df: DataFrame, cfg: CleanSettings, split_column: str = "split") -> DataFrame:
    """Rows before, after and removed for each split and cleaning step.

    Takes rows that are tagged but not cleaned. Groups of copies are counted
    with map-side partial counts, so nothing is ranked or sorted.
    """
    rows = normalize_cities(df, cfg)
    keys = compared_columns(rows, cfg, [split_column])
    keep = within_price_limit(rows, cfg) if cfg.outlier_column in rows.columns else F.lit(True)
    groups = rows.select(*[missing_as_null(rows, k).alias(k) for k in keys], keep.alias("__keep"))
    groups = groups.groupBy(*[F.col(f"`{k}`") for k in keys], "__keep").agg(F.count("*").alias("__n"))
    totals = groups.groupBy(split_column).agg(
        F.sum("__n").alias("all_rows"),
        F.count("*").alias("distinct_rows"),
        F.count_if("__keep").alias("kept_rows"),
    )
    return totals.select(
        split_column,
        F.inline(
            F.array(
                _step("duplicates", "all_rows", "distinct_rows"),
                _step("price_outliers", "distinct_rows", "kept_rows"),
            )
        ),
    )


def _step(name: str, before: str, after: str) -> Column:
    return F.struct(
        F.lit(name).alias("step"),
        F.col(before).alias("rows_before"),
        F.col(after).alias("rows_after"),
        (F.col(before) - F.col(after)).alias("rows_removed"),
    )
