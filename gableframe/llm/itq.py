"""Near-duplicate vectors by iterative quantisation and multi-index tables.

A rotation of the principal axes is learned on a bounded sample so that signs
of the rotated vector make balanced binary codes. Codes are cut into substrings;
each substring is a table whose buckets hold the vectors with equal bits (and,
for long substrings, are also visited by vectors one or two bits away, so that no
pair up to 11 bits apart is missed). Vectors that meet
in a bucket are compared by cosine on the original components in double
precision. A pair that meets in several tables counts in the first of them only,
so link counts add up without a list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, forest, materialize, partitions_for, ship_package

BITS = 64


@dataclass(frozen=True)
class Settings:
    """``sample``: vectors the rotation is learned on, at most (all are indexed).
    ``long_from``: vectors in the largest label from which tables have 16 bits
    and are also visited from up to two bits away, instead of 8 bits: the number of
    candidates per vector then falls from n/32 to n/120. ``block``: rows of a
    bucket that are compared in one piece; larger buckets become pairs of blocks."""

    threshold: float = 0.98
    sample: int = 20_000
    rounds: int = 50
    seed: int = 42
    long_from: int = 1 << 17
    block: int = 2048


def fit_rotation(vectors: np.ndarray, rounds: int = 50, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dimensions x bits) that keep sign codes close to the
    centred vectors. With fewer dimensions than 64 there are fewer bits."""
    mean = vectors.mean(axis=0)
    centred = vectors - mean
    bits = min(BITS, vectors.shape[1])
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :bits]
    spread = centred @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))[0]
    for _ in range(rounds):
        codes = np.where(spread @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(codes.T @ spread)
        turn = (left @ right).T
    return mean, axes @ turn


def encode(units: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Codes as unsigned numbers, bit i from projected dimension i."""
    signs = (units - mean) @ projection >= 0
    padded = np.zeros((len(units), BITS), dtype=bool)
    padded[:, : signs.shape[1]] = signs
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")[:, 0]


def substrings(codes: np.ndarray, width: int) -> np.ndarray:
    """(rows, 64 / width) substrings of the codes."""
    return codes.view({8: "<u1", 16: "<u2"}[width]).reshape(len(codes), BITS // width)


def as_bytes(column: Iterable) -> list[bytes]:
    """Each vector as bytes of doubles."""
    return [np.asarray(x, dtype=np.float64).tobytes() for x in column]


def _units(raw: list[bytes], length: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(raw), dtype=np.float64).reshape(len(raw), length)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that no square leaves the range of doubles
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cfg: Settings = Settings()
) -> DataFrame:
    """``(key, n_links, component)`` for every row.

    Links join rows of one label whose vectors have a cosine of at least the
    threshold. A null label or a vector that is null, empty, zero, or holds null
    or non-finite components links with nothing: ``n_links`` 0 and its own key as
    component. Vectors of other lengths than each other never link. Equal vectors
    of a label are one vector with many rows; they link with each other and are
    never paired. Components take the smallest key; repeated rows stay repeated
    and count as separate rows in ``n_links``. Empty in, empty out.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    usable = F.coalesce(F.col(label).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))
    marked = vectors.select(F.col(key).alias("key"), F.when(usable, F.col(label)).alias("label"), F.when(usable, F.col(vector)).alias("vector"))
    good = marked.where("vector IS NOT NULL")
    # the node of a vector is a row of it; key alone would join rows that share one
    node = F.xxhash64("label", "vector")
    unique = materialize(
        good.groupBy("label", "vector").agg(F.count("*").alias("times"), F.min("key").alias("first")).withColumn("node", node),
        "itq-unique",
    )
    met = materialize(_meet(unique, cfg), "itq-met")
    counts = met.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("near"))
    group = components(met.where("b IS NOT NULL").select("a", "b"), "itq-components").withColumnRenamed("component", "root")
    named = unique.select("node", "times", "first").join(group, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component"))
    named = (
        named.join(lowest, "root")
        .join(counts, "node", "left")
        .select("node", (F.col("times") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), "component")
    )
    named = materialize(named, "itq-named")
    alone = marked.where("vector IS NULL").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component"))
    linked = good.select("key", node.alias("node")).join(named, "node").select("key", "n_links", "component")
    return linked.union(alone).withColumnRenamed("key", key)


def _meet(unique: DataFrame, cfg: Settings) -> DataFrame:
    """Rows ``(a, b, n)``: ``b`` null, n more rows linked with a; or a link a - b
    of a spanning forest of one piece of a bucket."""
    spark = unique.sparkSession
    ship_package(spark)
    by_length = unique.withColumn("length", F.size("vector"))
    sizes = by_length.groupBy("label", "length").count().groupBy("length").agg(F.max("count"), F.sum("count")).collect()
    out = spark.createDataFrame([], "a long, b long, n long")
    for length, most, rows in sizes:
        part = by_length.where(F.col("length") == length)
        learned = part.orderBy(F.xxhash64("node")).limit(cfg.sample).select("vector").collect()
        mean, projection = fit_rotation(_units(as_bytes([r[0] for r in learned]), length), cfg.rounds, cfg.seed)
        coded = materialize(_coded(part, length, mean, projection), f"itq-codes-{length}")
        out = out.union(_compare(coded, length, rows, 16 if most > cfg.long_from else 8, cfg))
    return out


def _coded(part: DataFrame, length: int, mean: np.ndarray, projection: np.ndarray) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raw = as_bytes(frame.pop("vector"))
            codes = encode(_units(raw, length), mean, projection) if raw else np.empty(0, dtype=np.uint64)
            yield frame.assign(code=codes.view(np.int64), raw=pd.Series(raw, dtype=object))

    types = dict(part.dtypes)
    return part.select("label", "node", "times", "vector").mapInPandas(
        run, f"label {types['label']}, node long, times long, code long, raw binary"
    )


def _compare(coded: DataFrame, length: int, rows: int, width: int, cfg: Settings) -> DataFrame:
    tables, reach = BITS // width, 2 * int(width > 8)
    places = []
    for table in range(tables):
        bits = F.shiftrightunsigned("code", table * width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        for probe in [sum(1 << i for i in flips) for k in range(reach + 1) for flips in combinations(range(width), k)]:
            bucket = bits.bitwiseXOR(F.lit(probe).cast("long")) + F.lit(table << width).cast("long")
            places.append(F.struct(bucket.alias("bucket"), F.lit(probe == 0).alias("own")))
    placed = coded.withColumn("place", F.explode(F.array(*places))).select("*", "place.*").drop("place")
    full = materialize(
        placed.where("own").groupBy("label", "bucket").count().where(F.col("count") > cfg.block)
        .select("label", "bucket", F.ceil(F.col("count") / cfg.block).alias("blocks")),
        "itq-full",
    )
    # A bucket above one block is a square of pieces: entries of one block against
    # queries of one block. A row asks in every piece of its query block and, if it
    # lies in the bucket itself, is given in every piece of its entry block.
    dealt = placed.join(full, ["label", "bucket"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)

    def piece(entries: Column, queries: Column, asks: Column, given: Column) -> Column:
        return F.struct(entries.alias("entries"), queries.alias("queries"), asks.alias("asks"), given.alias("given"))

    asking = F.transform(every, lambda e: piece(e, F.col("mine"), F.lit(True), F.col("own") & (e == F.col("mine"))))
    others = F.filter(every, lambda q: F.col("own") & (q != F.col("mine")))
    given = F.transform(others, lambda q: piece(F.col("mine"), q, F.lit(False), F.lit(True)))
    dealt = dealt.withColumn("piece", F.explode(F.concat(asking, given))).select(
        "label", "bucket", "piece.*", "node", "times", "code", "raw"
    )
    run_key = ["label", "bucket", "entries", "queries"]
    n = partitions_for(coded.sparkSession, rows * len(places), 200_000)
    dealt = dealt.repartition(n, *run_key).sortWithinPartitions(*run_key)

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            now = {name: frame[name].to_numpy() for name in frame.columns}
            held = now if held is None else {name: np.concatenate([held[name], now[name]]) for name in now}
            if not len(held["node"]):
                continue
            change = np.zeros(len(held["node"]) - 1, dtype=bool)
            for name in run_key:
                change |= held[name][1:] != held[name][:-1]
            starts = np.r_[0, np.flatnonzero(change) + 1]
            for start, end in zip(starts[:-1], starts[1:]):
                if end - start > 1:
                    yield from _piece({k: v[start:end] for k, v in held.items()}, length, width, reach, cfg)
            held = {k: v[starts[-1] :] for k, v in held.items()}
        if held is not None and len(held["node"]) > 1:
            yield from _piece(held, length, width, reach, cfg)

    return dealt.mapInPandas(search, "a long, b long, n long")


def _piece(rows: dict, length: int, width: int, reach: int, cfg: Settings) -> Iterator[pd.DataFrame]:
    table = int(rows["bucket"][0]) >> width
    asks, given = rows["asks"], rows["given"]
    if not asks.any() or not given.any():
        return
    nodes, times, codes = rows["node"], rows["times"], rows["code"].view(np.uint64)
    units = _units(rows["raw"].tolist(), length)
    entries = np.flatnonzero(given)
    names, local = np.unique(nodes, return_inverse=True)
    near = np.zeros(len(names), dtype=np.int64)
    label = np.arange(len(names))
    for start in range(0, len(nodes), 1024):
        queries = np.flatnonzero(asks[start : start + 1024]) + start
        q, e = np.nonzero(units[queries] @ units[entries].T >= cfg.threshold)
        q, e = queries[q], entries[e]
        q, e = q[nodes[q] != nodes[e]], e[nodes[q] != nodes[e]]
        if not len(q):
            continue
        differ = np.bitwise_count(substrings(codes[q] ^ codes[e], width))
        first = (differ <= reach).argmax(axis=1) == table
        np.add.at(near, local[q[first]], times[e[first]])
        ids = np.arange(len(names))
        moved = np.flatnonzero(label != ids)
        label = forest(len(names), np.r_[moved, local[q]], np.r_[label[moved], local[e]])
    counted, linked = np.flatnonzero(near), np.flatnonzero(label != np.arange(len(names)))
    if len(counted):
        yield pd.DataFrame({"a": names[counted], "b": pd.array([pd.NA] * len(counted), dtype="Int64"), "n": near[counted]})
    if len(linked):
        yield pd.DataFrame(
            {"a": names[linked], "b": pd.array(names[label[linked]], dtype="Int64"), "n": np.zeros(len(linked), dtype=np.int64)}
        )
