"""Vector code compression: product codes found by k-means with adaptive bounds.

Vectors become whole numbers and are cut into equal parts; each part is replaced by
the index of the nearest entry of its own codebook. After a first full search,
every part keeps, ordered by distance, its ``b`` closest other entries with a lower
bound each, and one outer bound for all the rest. When the entries move, a bound
falls by as much as its entry moved (the outer one by the largest move), so an
entry whose bound still lies above the distance to the part's own entry cannot be
nearest or tie with it and is not looked at. Only the entries that remain are
measured, in whole numbers, which decides ties; a part whose outer bound fails is
searched again over the whole codebook. ``b`` adapts: each batch of rows keeps as
many bounds as all but a sixteenth of its parts have used, never more than before.

Bounds are stored as halves rounded down, so they are never too high, and compared
with a margin above the rounding of doubles. Nothing depends on ``b``, on the
batches or on the order of rows: entries move to the floor of exact means.

Defined cases. Vectors that are null or hold a null, NaN or infinite component are
dropped. Vectors of different lengths are coded apart, each length with codebooks
of its own; parts differ by one component where the length is no multiple of their
number, and a vector of no components has codes and error zero. Fewer vectors
than entries: as many entries as vectors. Ids decide the first entries, nulls last; rows
with the same id are taken in the order of their components. A component beyond
``limit`` counts as the limit, so that every error fits 64 bits; a sum over a label
ends at the largest long. A NaN label counts as null. An empty table gives an
empty table. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BroadcastBound
from ..functions.numbers import missing_as_null
from ..operators.lookup import lookup_join
from .common import materialize, ship_package

_LONGEST = (1 << 63) - 1
_CELLS = 1 << 21  # differences held at once


class Settings(NamedTuple):
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    bounds: int = 8  # b at first: an eighth of the entries
    least: int = 2


def limit(dim: int) -> int:
    """Largest component: squared distances over all components fit 63 bits."""
    return math.isqrt(_LONGEST // max(dim, 1)) // 2


def edges(dim: int, parts: int) -> list[int]:
    return [p * dim // parts for p in range(parts + 1)]


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    bound = limit(values.shape[1])
    with np.errstate(over="ignore"):
        floored = np.floor(values.astype(np.float64) * scale)
    return np.clip(floored, -bound, bound).astype(np.int64)


def _packed(rows: np.ndarray) -> list[bytes]:
    """Each row in the fewest bytes per number its batch needs."""
    most = int(np.abs(rows).max(initial=0))
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return [r.tobytes() for r in rows.astype(kind)]


def _unpacked(column: pa.Array, dim: int) -> np.ndarray:
    kinds = {2: "<i2", 4: "<i4", 8: "<i8"}
    rows = [v.as_py() for v in column]
    if not dim:
        return np.zeros((len(rows), 0), dtype=np.int64)
    return np.array([np.frombuffer(r, dtype=kinds[len(r) // dim]) for r in rows], dtype=np.int64).reshape(len(rows), dim)


class Codebook(NamedTuple):
    """Entries as rows; the entries of a part are the columns of that part.
    ``moved`` says how far each entry of each part has moved, rounded up."""

    entries: np.ndarray  # (k, dim) whole numbers
    moved: np.ndarray  # (parts, k)


class State(NamedTuple):
    """Of n rows: nearest entry, b closest others with lower bounds, outer bound."""

    code: np.ndarray  # (n, parts)
    near: np.ndarray  # (n, parts, b)
    low: np.ndarray  # (n, parts, b) halves
    outer: np.ndarray  # (n, parts) halves
    used: np.ndarray  # (n, parts): bounds that had to be passed; b + 1 beyond the outer one


def _down(x: np.ndarray) -> np.ndarray:
    """Halves that are not above the doubles."""
    half = np.minimum(x, 65504.0).astype(np.float16)
    return np.where(half.astype(np.float64) > x, np.nextafter(half, np.float16(-np.inf)), half)


def _scan(part: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a part to all entries."""
    out = np.empty((len(part), len(entries)), dtype=np.int64)
    step = max(1, _CELLS // max(1, entries.size))
    for start in range(0, len(part), step):
        apart = part[start : start + step, None, :] - entries[None]
        out[start : start + step] = np.einsum("nkw,nkw->nk", apart, apart)
    return out


def _closest(square: np.ndarray, bounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry, the ``bounds`` next ones and their distances, that of the one after."""
    order = np.argsort(square, axis=1, kind="stable")  # ties: lower index first
    far = np.sqrt(np.take_along_axis(square, order[:, 1 : bounds + 2], axis=1).astype(np.float64))
    outer = far[:, bounds] if far.shape[1] > bounds else np.full(len(square), np.inf)
    return order[:, 0], order[:, 1 : bounds + 1], far[:, :bounds], outer


def first_search(rows: np.ndarray, book: Codebook, cfg: Settings) -> tuple[State, np.ndarray]:
    """Every part against every entry: the state and the error of every row."""
    n, dim = rows.shape
    b = min(cfg.bounds, len(book.entries) - 1)
    code, used = np.empty((n, cfg.parts), dtype=np.uint8), np.zeros((n, cfg.parts), dtype=np.uint8)
    near, low = np.empty((n, cfg.parts, b), dtype=np.uint8), np.empty((n, cfg.parts, b))
    outer, error = np.empty((n, cfg.parts)), np.zeros(n, dtype=np.int64)
    for p, (start, end) in enumerate(zip((cut := edges(dim, cfg.parts)), cut[1:])):
        square = _scan(rows[:, start:end], book.entries[:, start:end])
        code[:, p], near[:, p], low[:, p], outer[:, p] = _closest(square, b)
        error += np.take_along_axis(square, code[:, p, None].astype(np.intp), axis=1)[:, 0]
    return State(code, near, _down(low), _down(outer), used), error


def next_search(rows: np.ndarray, old: State, book: Codebook, cfg: Settings) -> tuple[State, np.ndarray]:
    """The same after the entries have moved, by the bounds."""
    n, dim = rows.shape
    b = old.near.shape[2]
    code, near, used = old.code.copy(), old.near.copy(), np.zeros((n, cfg.parts), dtype=np.uint8)
    low, outer = old.low.astype(np.float64), old.outer.astype(np.float64)
    error = np.zeros(n, dtype=np.int64)
    for p, (start, end) in enumerate(zip((cut := edges(dim, cfg.parts)), cut[1:])):
        part, entries, moved = rows[:, start:end], book.entries[:, start:end], book.moved[p]
        low[:, p] -= moved[near[:, p]]
        outer[:, p] -= moved.max(initial=0)
        own = ((part - entries[code[:, p]]) ** 2).sum(axis=1)
        reach = np.sqrt(own.astype(np.float64)) * (1 + 1e-12) + 1e-9
        unsure = low[:, p] <= reach[:, None]
        used[:, p] = np.where(unsure, np.arange(1, b + 1), 0).max(axis=1, initial=0)
        lost = outer[:, p] <= reach
        used[lost, p] = b + 1
        # some of the kept entries may be nearer now: measure these alone
        row, place = np.nonzero(unsure & ~lost[:, None])
        if len(row):
            entry = near[row, p, place].astype(np.int64)
            square = ((part[row] - entries[entry]) ** 2).sum(axis=1)
            low[row, p, place] = np.sqrt(square.astype(np.float64))
            # the least of (square, entry) in each row that has any
            order = np.lexsort((entry, square, row))
            head = order[np.r_[True, row[order][1:] != row[order][:-1]]]
            at, best, index = row[head], square[head], entry[head]
            wins = (best < own[at]) | ((best == own[at]) & (index < code[at, p]))
            at, head = at[wins], head[wins]
            slot, left = place[head], code[at, p].copy()
            code[at, p] = near[at, p, slot]
            near[at, p, slot] = left  # the entry left behind takes the place of the new one
            low[at, p, slot] = np.sqrt(own[at].astype(np.float64))
            own[at] = square[head]
        again = np.flatnonzero(lost)
        if len(again):
            square = _scan(part[again], entries)
            code[again, p], near[again, p], low[again, p], outer[again, p] = _closest(square, b)
            own[again] = square[np.arange(len(again)), code[again, p]]
        error += own
    order = np.argsort(low, axis=2, kind="stable")
    near, low = np.take_along_axis(near, order, axis=2), np.take_along_axis(low, order, axis=2)
    keep = adapted(used, b, cfg)
    if keep < b:  # the bounds given up fall to the outer one
        outer = np.minimum(outer, low[:, :, keep])
        near, low = near[:, :, :keep], low[:, :, :keep]
    return State(code, near, _down(low), _down(outer), used), error


def adapted(used: np.ndarray, b: int, cfg: Settings) -> int:
    """Bounds that would have been enough for all but a sixteenth of the parts."""
    enough = int(np.quantile(used, 15 / 16, method="higher")) if used.size else b
    return min(b, max(cfg.least, enough))


def _stored(state: State) -> list[pa.Array]:
    return [pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary()) for x in state]


def _loaded(batch: pa.RecordBatch, at: int, cfg: Settings) -> State:
    """The state of rows that have equally many bounds; blobs start at column ``at``."""
    n = batch.num_rows
    code, near, low, outer, used = (b"".join(batch.column(at + i).to_pylist()) for i in range(5))
    b = len(near) // (n * cfg.parts)
    flat, deep = (n, cfg.parts), (n, cfg.parts, b)
    return State(
        np.frombuffer(code, np.uint8).reshape(flat),
        np.frombuffer(near, np.uint8).reshape(deep),
        np.frombuffer(low, np.float16).reshape(deep),
        np.frombuffer(outer, np.float16).reshape(flat),
        np.frombuffer(used, np.uint8).reshape(flat),
    )


def _alike(batch: pa.RecordBatch, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch that agree in all of ``columns``, group by group."""
    if not batch.num_rows:
        return
    _, group = np.unique(np.stack(columns, axis=1), axis=0, return_inverse=True)
    for g in range(group.max() + 1):
        yield batch.take(pa.array(np.flatnonzero(group == g)))


def _lengths(column: pa.Array) -> np.ndarray:
    return np.array([len(v.as_py()) for v in column], dtype=np.int64)


def numbered(vectors: DataFrame, vector: str, key: str, label: str, cfg: Settings) -> DataFrame:
    """``(__key, __label, dim, vec)`` of the vectors that are kept, as whole numbers."""
    ship_package(vectors.sparkSession)
    picked = vectors.select(F.col(key).alias("__key"), F.col(label).alias("__label"), F.col(vector).cast("array<double>").alias("vec"))
    whole = picked.where(F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf)))
    sized = whole.withColumn("dim", F.size("vec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for alike in _alike(batch, [batch.column(3).to_numpy()]):
                dim = alike.column(3)[0].as_py()
                rows = whole_numbers(alike.column(2).flatten().to_numpy().reshape(alike.num_rows, dim), cfg.scale)
                yield pa.RecordBatch.from_arrays([alike.column(0), alike.column(1), alike.column(3), pa.array(_packed(rows), pa.binary())], names=["__key", "__label", "dim", "vec"])

    fields = [*picked.schema.fields[:2], T.StructField("dim", T.IntegerType()), T.StructField("vec", T.BinaryType())]
    return sized.mapInArrow(run, T.StructType(fields))


def first_books(vectors: DataFrame, vector: str, key: str, cfg: Settings) -> dict[int, Codebook]:
    """The vectors of the smallest ids of each length: at most ``entries`` rows a length."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("dim").orderBy(F.col("__key").asc_nulls_last(), "values"))
    rows = vectors.select(F.col(key).alias("__key"), F.col(vector).cast("array<double>").alias("values"))
    rows = rows.where(F.col("values").isNotNull() & ~F.exists("values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf)))
    # ranks stop in every task after this many rows, so none orders a whole length
    picked = rows.withColumn("dim", F.size("values")).withColumn("place", place).where(F.col("place") <= cfg.entries)
    found: dict[int, list] = {}
    for row in sorted(picked.select("dim", "place", "values").collect(), key=lambda r: (r.dim, r.place)):
        found.setdefault(row.dim, []).append(row["values"])
    out = {}
    for dim, values in found.items():
        entries = whole_numbers(np.array(values, dtype=np.float64).reshape(len(values), dim), cfg.scale)
        out[dim] = Codebook(entries, np.zeros((cfg.parts, len(entries))))
    return out


def assign(rows: DataFrame, books: dict[int, Codebook], cfg: Settings, bounded: bool) -> DataFrame:
    """The state of every row and its ``error``; by the bounds where there are any."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by = [batch.column(2).to_numpy(), *([_lengths(batch.column(5))] if bounded else [])]
            for alike in _alike(batch, by):
                dim = alike.column(2)[0].as_py()
                vec = _unpacked(alike.column(3), dim)
                if bounded:
                    state, error = next_search(vec, _loaded(alike, 4, cfg), books[dim], cfg)
                else:
                    state, error = first_search(vec, books[dim], cfg)
                columns = [alike.column(i) for i in range(4)] + _stored(state) + [pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=[*alike.schema.names[:4], *state._fields, "error"])

    blobs = [T.StructField(c, T.BinaryType()) for c in State._fields]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:4], *blobs, T.StructField("error", T.LongType())]))


def moved_books(state: DataFrame, books: dict[int, Codebook], cfg: Settings) -> dict[int, Codebook]:
    """Entries at the floor of the mean of their parts; unused ones stay. A task gives
    one row per entry it has used, the driver receives one per entry and length."""
    sizes = {dim: len(b.entries) for dim, b in books.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {dim: np.zeros((k, dim), dtype=np.int64) for dim, k in sizes.items()}
        counts = {dim: np.zeros((cfg.parts, k), dtype=np.int64) for dim, k in sizes.items()}
        for batch in batches:
            for alike in _alike(batch, [batch.column(0).to_numpy()]):
                dim = alike.column(0)[0].as_py()
                vec, cut = _unpacked(alike.column(1), dim), edges(dim, cfg.parts)
                code = np.frombuffer(b"".join(alike.column(2).to_pylist()), np.uint8).reshape(-1, cfg.parts)
                for p in range(cfg.parts):
                    counts[dim][p] += np.bincount(code[:, p], minlength=sizes[dim])
                    np.add.at(sums[dim][:, cut[p] : cut[p + 1]], code[:, p], vec[:, cut[p] : cut[p + 1]])
        for dim in sizes:
            cut = edges(dim, cfg.parts)
            p, e = np.nonzero(counts[dim])
            if len(p):
                total = pa.array([sums[dim][j, cut[i] : cut[i + 1]].tolist() for i, j in zip(p, e)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), dim, np.int32)), pa.array(p), pa.array(e), pa.array(counts[dim][p, e]), total], names=["dim", "part", "entry", "n", "total"]
                )

    parts = state.select("dim", "vec", "code").mapInArrow(run, "dim int, part long, entry long, n long, total array<long>")
    group = ["dim", "part", "entry"]
    counted = parts.groupBy(*group).agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    total = parts.select(*group, F.posexplode("total").alias("at", "x")).groupBy(*group, "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    entries = {dim: b.entries.copy() for dim, b in books.items()}
    for row in total.join(counted, group).collect():
        entries[row.dim][row.entry, edges(row.dim, cfg.parts)[row.part] + row.at] = int(row.x) // int(row.n)
    return {dim: Codebook(new, _moves(books[dim].entries, new, cfg.parts)) for dim, new in entries.items()}


def _moves(old: np.ndarray, new: np.ndarray, parts: int) -> np.ndarray:
    """How far every entry of every part has moved, rounded up."""
    square, cut = (new - old) ** 2, edges(old.shape[1], parts)
    far = np.sqrt(np.array([square[:, a:b].sum(axis=1) for a, b in zip(cut, cut[1:])], dtype=np.float64))
    return np.where(far > 0, far * (1 + 1e-12) + 1e-9, 0.0)


def digest(book: Codebook, cfg: Settings) -> str:
    """SHA-256 of all components by part, entry and position, as decimal text."""
    cut = edges(book.entries.shape[1], cfg.parts)
    listed = (str(x) for a, b in zip(cut, cut[1:]) for x in book.entries[:, a:b].reshape(-1).tolist())
    return hashlib.sha256(",".join(listed).encode()).hexdigest()


def compress(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", cfg: Settings = Settings(), bound: BroadcastBound = BroadcastBound()
) -> tuple[DataFrame, dict[int, Codebook]]:
    """``(key, label, dim, code, error)``, code being one byte a part, and the final
    codebooks by vector length."""
    books = first_books(vectors, vector, key, cfg)
    state = numbered(vectors, vector, key, label, cfg)
    for turn in range(cfg.rounds):
        state = materialize(assign(state, books, cfg, turn > 0).drop("error"), f"codes-{turn}")
        books = moved_books(state, books, cfg)
    out = assign(state, books, cfg, cfg.rounds > 0)
    return out.select(F.col("__key").alias(key), F.col("__label").alias(label), "dim", "code", "error"), books


def report(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", cfg: Settings = Settings(), bound: BroadcastBound = BroadcastBound()) -> DataFrame:
    """``(key, code, error, label_error, codebooks_sha256)`` with the code in hex digits."""
    spark = vectors.sparkSession
    codes, books = compress(vectors, vector, key, label, cfg)
    rows = codes.select(F.col(key).alias("__key"), missing_as_null(codes, label).alias("__label"), "dim", F.lower(F.hex("code")).alias("code"), "error")
    rows = materialize(rows, "codes-final")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONGEST).cast("decimal(38,0)")).cast("long")
    sums = materialize(rows.groupBy(F.col("__label").alias("label")).agg(total.alias("label_error")), "codes-labels")
    named = spark.createDataFrame([(d, digest(b, cfg)) for d, b in sorted(books.items())], "dim int, codebooks_sha256 string")
    found = lookup_join(rows, sums, "__label", "label", ["label_error"], bound).join(F.broadcast(named), "dim")  # one row a length
    return found.select(F.col("__key").alias(key), "code", "error", "label_error", "codebooks_sha256")
