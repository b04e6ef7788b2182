"""Null-safe left lookup join: broadcast within a bound, else a shuffle that salts hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BroadcastBound
from ..functions.numbers import missing_as_null
from ..sources.workspace import materialize

_KEY = "__lookup_key"
_SALT = "__salt"
_HOT = "__hot"


def fits_broadcast(lookup: DataFrame, bound: BroadcastBound) -> bool:
    """Count the lookup against both bounds; stops reading one row past the limit."""
    width = F.lit(0)
    for f in lookup.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.octet_length(F.to_json(F.struct(value)))
        else:
            width = width + F.lit(16)
    row = lookup.limit(bound.max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return row[0] <= bound.max_rows and row[1] <= bound.max_bytes


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def hot_keys(df: DataFrame, key: str, bound: BroadcastBound) -> DataFrame:
    """Keys that hold more than 1 / (16 * salts) of all rows: fewer than 16 * salts
    of them, whatever the table. Counted in one pass; only the hot ones are written."""
    counts = df.groupBy(missing_as_null(df, key).alias(_HOT)).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return materialize(counts.where(F.col("n") * (16 * bound.salts) > total).select(_HOT), "hot-keys")


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    values: list[str],
    bound: BroadcastBound,
) -> DataFrame:
    """``df`` with ``values`` of the one lookup row whose key is equal; a missing
    key matches a missing key. ``lookup`` holds every key once, so the row count
    never changes.

    Small lookup: broadcast, no shuffle of ``df``. Large lookup: both sides are
    shuffled by key and, where there are hot keys, a salt. Only those (null may be
    one) have more than one salt; their lookup rows are repeated once per salt, so the rows of one hot key
    are dealt over ``bound.salts`` tasks. The salt hashes all columns but those with
    maps, so it is the same when a task
    runs again. A stream cannot be counted before it runs and has no salts; adaptive
    execution splits its large partitions. The hint keeps the planner, which goes by
    the size of compressed files, from broadcasting what is beyond the bound.
    """
    right = lookup.select(F.col(f"`{lookup_key}`").alias(_KEY), *[F.col(f"`{v}`") for v in values])
    same_key = missing_as_null(df, key).eqNullSafe(F.col(_KEY))
    if fits_broadcast(right, bound):
        return df.join(F.broadcast(right), same_key, "left").drop(_KEY)
    # fewer than 16 * salts rows by their definition
    hot = None if df.isStreaming else hot_keys(df, key, bound)
    if hot is None or hot.isEmpty():
        return df.join(right.hint("merge"), same_key, "left").drop(_KEY)
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
    own = [df[f"`{c}`"] for c in df.columns]
    hot = F.broadcast(hot.withColumn("__salts", F.lit(bound.salts)))
    salts = F.coalesce("__salts", F.lit(1))
    left = df.join(hot, missing_as_null(df, key).eqNullSafe(F.col(_HOT)), "left")
    wide = right.join(hot, F.col(_KEY).eqNullSafe(F.col(_HOT)), "left")
    left = left.select(*own, F.pmod(F.xxhash64(*hashed), salts).cast("int").alias(_SALT))
    repeated = wide.select(*right.columns, F.explode(F.sequence(F.lit(0), salts - 1)).alias("__copy"))
    on = missing_as_null(left, key).eqNullSafe(F.col(_KEY)) & (F.col(_SALT) == F.col("__copy"))
    return left.join(repeated.hint("merge"), on, "left").drop(_KEY, _SALT, "__copy")
