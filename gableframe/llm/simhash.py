"""Near-duplicate documents by SimHash, searched in vantage-point trees.

Fingerprints of 64 bits are linked when they differ in at most two bits. The
search tree splits them by their Hamming distances to vantage points: the zero
word and the words that are all ones in one block of bits. Both distances
together give ``|x AND block|``, so a tree level is a ring per block, and by the
triangle inequality two fingerprints at distance two or less lie in the same or
in adjacent rings, with at most two ring steps between them over all blocks.

A shard of the tree is one combination of rings. A fingerprint goes to its own
shard and to every shard one ring step away: two fingerprints at most two steps
apart then meet in a shard, whichever side of a boundary they lie on. A shard
with more than ``leaf`` fingerprints is a branch: its fingerprints go down to the
level whose blocks are single bits. There a shard is one word with its
neighbours one bit away, at most 65 fingerprints, so any crowd of near copies
ends in small leaves. Every pair within the radius is met; no bucket has a cap.

Shards give a spanning forest of their links, never all pairs; connected
components are joined up in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, forest, materialize, partitions_for, ship_package

BITS = 64
SIZE = 3
RADIUS = 2  # the shard rule above meets all pairs up to this many bits
SEED = 42
LEAF = 4096
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PAIRS_HELD = 1 << 20


def fingerprint(text: str | None, size: int = SIZE) -> int:
    """SimHash of word shingles, each occurrence counted. Null or no words: 0."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < size:
        grams: Iterator[bytes] = iter((b" ".join(words),))
        n = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(size))))
        n = len(words) - size + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, n, 8192):
        part = hashes[start : start + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), size: int = SIZE) -> DataFrame:
    """The ``keep`` columns and ``fp``, the fingerprint as a signed 64-bit number."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(x.as_py(), size) for x in batch.column(len(keep))], dtype=np.uint64)
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values.view(np.int64))], names=[*keep, "fp"])

    picked = docs.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*picked.schema.fields[:-1], T.StructField("fp", T.LongType())])
    return picked.mapInArrow(run, schema)


def vantage_points(blocks: int) -> list[int]:
    """The zero word, then one word per block of bits, as signed numbers."""
    width = BITS // blocks
    words = [0] + [((1 << width) - 1) << (width * i) for i in range(blocks)]
    return [w - (1 << BITS) if w >= 1 << (BITS - 1) else w for w in words]


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def shards(fp: Column, blocks: int) -> Column:
    """Own shard and all shards one ring step away, as an array of shard numbers."""
    width = BITS // blocks
    zero, *points = vantage_points(blocks)
    from_zero = distance(fp, F.lit(zero).cast("long"))
    if width == 1:  # a ring per bit: the shard is the word itself
        return F.array(fp, *(fp.bitwiseXOR(F.lit(p).cast("long")) for p in points))
    digits = width.bit_length()
    rings = [
        ((from_zero + F.lit(width) - distance(fp, F.lit(p).cast("long"))) / 2).cast("long") for p in points
    ]
    own = sum((F.shiftleft(ring, digits * i) for i, ring in enumerate(rings)), F.lit(0).cast("long"))
    beside = []
    for i, ring in enumerate(rings):
        step = F.lit(1 << (digits * i)).cast("long")
        beside.append(F.when(ring < width, own + step))
        beside.append(F.when(ring > 0, own - step))
    return F.filter(F.array(own, *beside), lambda x: x.isNotNull())


def links(fps: DataFrame, leaf: int = LEAF, blocks: int | None = None, radius: int = RADIUS) -> DataFrame:
    """``(a, b)``: links that connect every two fingerprints within the radius.

    ``fps`` has one column ``fp`` of different values. More rows take more
    blocks, hence smaller shards; the links connect the same fingerprints.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"The shards meet all pairs up to {RADIUS} bits apart, not {radius}")
    rows = fps.count()
    if blocks is None:
        blocks = 4 if rows <= 1 << 19 else 8 if rows <= 1 << 28 else 16
    found = materialize(_level(fps, rows, blocks, leaf, radius), "simhash-shards")
    crowd = found.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    out = found.where("b IS NOT NULL")
    if not crowd.isEmpty():
        crowd = materialize(crowd, "simhash-crowd")
        out = out.union(materialize(_level(crowd, crowd.count(), BITS, BITS + 1, radius), "simhash-leaves"))
    return out.distinct()


def _level(fps: DataFrame, rows: int, blocks: int, leaf: int, radius: int) -> DataFrame:
    placed = fps.select(F.explode(shards(F.col("fp"), blocks)).alias("shard"), "fp")
    n = partitions_for(fps.sparkSession, rows * (2 * blocks + 1), 2_000_000)
    sorted_rows = placed.repartition(n, "shard").sortWithinPartitions("shard", "fp")
    ship_package(fps.sparkSession)
    return sorted_rows.mapInArrow(lambda batches: search(batches, leaf, radius), "a long, b long")


def search(batches: Iterator[pa.RecordBatch], leaf: int, radius: int) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal shards. A run longer than ``leaf`` is handed
    on as ``(fingerprint, null)``; at most ``leaf`` rows of it are held."""
    shard = np.empty(0, dtype=np.int64)
    fp = np.empty(0, dtype=np.int64)
    crowded: int | None = None  # the shard that is being handed on
    for batch in batches:
        shard = np.concatenate([shard, batch.column(0).to_numpy(zero_copy_only=False)])
        fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False)])
        if not len(shard):
            continue
        whole = int(np.searchsorted(shard, shard[-1], side="left"))
        yield from _search_runs(shard[:whole], fp[:whole], leaf, radius, crowded)
        if whole:
            crowded = None
        shard, fp = shard[whole:], fp[whole:]
        if crowded is not None or len(shard) > leaf:
            crowded = int(shard[0])
            yield _out(fp, None)
            # keep one row, so that the rest of the run is known to be crowded
            shard, fp = shard[:1], fp[:1]
    if len(shard):
        yield from _search_runs(shard, fp, leaf, radius, crowded)


def _out(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
    other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
    return pa.RecordBatch.from_arrays([pa.array(a), other], names=["a", "b"])


def _search_runs(shard: np.ndarray, fp: np.ndarray, leaf: int, radius: int, crowded: int | None) -> Iterator[pa.RecordBatch]:
    if not len(shard):
        return
    starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    size = np.diff(np.r_[starts, len(shard)])
    handed = size > leaf
    if crowded is not None and shard[0] == crowded:
        handed[0] = True
    given = np.repeat(handed, size)
    if given.any():
        yield _out(fp[given], None)
        fp, size = fp[~given], size[~handed]
        starts = np.cumsum(size) - size
    n = len(fp)
    end = np.repeat(starts + size, size)
    word, live, shift = fp.view(np.uint64), np.arange(n), 1
    held_a: list[np.ndarray] = []
    held_b: list[np.ndarray] = []
    held = 0
    while len(live := live[live + shift < end[live]]):
        near = live[np.bitwise_count(word[live] ^ word[live + shift]) <= radius]
        held_a.append(near)
        held_b.append(near + shift)
        held += len(near)
        if held > _PAIRS_HELD:  # keep a forest of what was found so far
            label = forest(n, np.concatenate(held_a), np.concatenate(held_b))
            node = np.flatnonzero(label != np.arange(n))
            held_a, held_b, held = [node], [label[node]], 0
        shift += 1
    if held_a:
        a, b = np.concatenate(held_a), np.concatenate(held_b)
        if len(a):
            label = forest(n, a, b)
            node = np.flatnonzero(label != np.arange(n))
            yield _out(fp[node], fp[label[node]])


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", leaf: int = LEAF, size: int = SIZE, radius: int = RADIUS
) -> DataFrame:
    """``(key, fp, component)`` for every row: component is the smallest key of
    the rows reachable by links.

    Equal fingerprints are one fingerprint with many rows, so exact copies cost
    one row each and are never paired. Repeated rows stay repeated. A null or
    empty text has fingerprint zero and links like any other. A null key never
    wins over another; a component of null keys only has a null component.
    An empty table gives an empty table; other columns are not read.
    """
    marked = materialize(with_fingerprint(docs, text, (key,), size), "simhash-fingerprints")
    first = materialize(marked.groupBy("fp").agg(F.min(key).alias("first")), "simhash-distinct")
    group = components(links(first.select("fp"), leaf, radius=radius), "simhash-components")
    linked = group.join(first, group["node"] == first["fp"]).select("fp", "component", "first")
    lowest = linked.groupBy("component").agg(F.min("first").alias("lowest"))
    linked = linked.join(lowest, "component").select("fp", "lowest")
    named = first.join(linked, "fp", "left").select("fp", F.coalesce("lowest", "first").alias("component"))
    return marked.join(materialize(named, "simhash-named"), "fp", "left").select(key, "fp", "component")


def keep_one(
    docs: DataFrame, text: str = "text", key: str = "doc_id", leaf: int = LEAF, size: int = SIZE, radius: int = RADIUS
) -> DataFrame:
    """One row of each component of ``near_duplicates``, all columns: that of the
    smallest key, a null key only where the component knows no other.

    Rows with one key and different texts are judged one by one; among those of
    the smallest key the text with the smallest hash stays. Rows equal in key
    and text are one row, of which any stays. A null or empty text has
    fingerprint zero and links like any other; long texts are read whole. An
    empty table gives an empty table. No name of another column clashes.
    """
    picked = docs.select(F.col(key).alias("__key"), F.xxhash64(text).alias("__hash"), F.col(text).alias("__body"))
    marked = with_fingerprint(picked, "__body", ("__key", "__hash"), size)
    marked = materialize(marked.groupBy("fp", "__key", "__hash").agg(F.count("*").alias("copies")), "simhash-keys")
    own = F.struct(F.col("__key").isNull().alias("void"), "__key", "__hash", "copies")
    first = materialize(marked.groupBy("fp").agg(F.min(own).alias("own")), "simhash-distinct")
    group = components(links(first.select("fp"), leaf, radius=radius), "simhash-components")
    placed = first.join(group, first["fp"] == group["node"], "left").select(F.coalesce("component", "fp").alias("root"), "own")
    kept = placed.groupBy("root").agg(F.min("own").alias("own"))
    kept = materialize(kept.select("own.__key", "own.__hash", "own.copies"), "simhash-kept")
    # the kept keys grow with the documents: one shuffle on the key at every size
    same = docs[key].eqNullSafe(kept["__key"]) & F.xxhash64(docs[text]).eqNullSafe(kept["__hash"])
    out = docs.join(kept.hint("merge"), same, "left_semi")
    return out if kept.where("copies > 1").isEmpty() else out.dropDuplicates([key, text])


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
