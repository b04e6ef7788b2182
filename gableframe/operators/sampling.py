"""Exact-size seeded sample and small ordered previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import seeded_key

_KEY, _HEAD, _NEXT = "__key", "__head", "__next"


def sample_exact(df: DataFrame, fraction: float | None, seed: int, row_id: Sequence[str]) -> DataFrame:
    """``round(fraction * n)`` rows (half to even) without replacement: those with
    the lowest seeded key of their unique row id. No fraction, or one outside
    (0, 1), gives the whole table.

    No global sort. Rows are counted in 65,536 buckets by the first digits of the
    key, then the bucket that holds the last wanted row is counted again by the
    next digits; only the rows of that one sub-bucket (n / 2^32) are ranked.
    """
    if fraction is None or not 0 < fraction < 1:
        return df
    key = seeded_key(seed, *[F.col(f"`{c}`") for c in row_id])
    keyed = df.withColumn(_KEY, key)
    head, after = F.substring(_KEY, 1, 4), F.substring(_KEY, 5, 4)

    counts = keyed.groupBy(head.alias("bucket")).agg(F.count("*").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    wanted = round(fraction * total)
    if wanted == 0:
        return df.limit(0)
    first, before = _cut(counts, wanted)
    inner = keyed.where(head == first).groupBy(after.alias("bucket")).agg(F.count("*").alias("n"))
    second, before_inner = _cut(inner, wanted - before)
    rest = wanted - before - before_inner

    below = (head < first) | ((head == first) & (after < second))
    tie = keyed.where((head == first) & (after == second))
    order = W.partitionBy(head, after).orderBy(_KEY, *[F.col(f"`{c}`") for c in row_id])
    last = tie.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= rest)
    return keyed.where(below).drop(_KEY).unionByName(last.drop(_KEY, "__rank"))


def _cut(counts: DataFrame, wanted: int) -> tuple[str, int]:
    """The bucket that holds row number ``wanted`` and the rows before it. At
    most 65,536 buckets are summed up."""
    running = F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("bucket"))
    reached = counts.withColumn("upto", running).where(F.col("upto") >= wanted)
    row = reached.orderBy("bucket").select("bucket", F.col("upto") - F.col("n")).first()
    return row[0], row[1]


def sample_fast(df: DataFrame, fraction: float | None, seed: int) -> DataFrame:
    """Approximate size, no extra pass."""
    if fraction is None or not 0 < fraction < 1:
        return df
    return df.sample(False, fraction, seed)


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in an explicit order (a preview, or rows to score)."""
    if not 1 <= n <= 1000:
        raise ValueError("A preview has 1 to 1000 rows.")
    return df.orderBy(*order).limit(n)
