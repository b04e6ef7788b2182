"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Documents become pieces of at most ``capacity`` tokens. Pieces of full length are
sequences of their own. The others are dealt into groups of bounded size; each
group is first packed best-fit decreasing. A group that has met the lower bound on
its number of sequences is done. The others evolve on several islands: a crossover
injects whole well-filled bins of one parent into another, drops the bins that
hold a piece twice, and best-fits the displaced pieces. After each epoch the best
packing of every island moves to the next island of its group.

What is poorly filled in the end is taken apart and packed again together with
that of other groups, until it no longer shrinks. Each such packing starts from
the bins as they are, so it never needs more of them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, partitions_for, ship_package
from .tokens import encoder


@dataclass(frozen=True)
class Settings:
    """``group``: pieces packed together, about. ``islands``, ``epochs``,
    ``population``, ``generations`` (per epoch): how long a group evolves that has
    not met its bound. ``well_filled``: bins from this share on are injected by
    crossovers and never taken apart at the end."""

    capacity: int = 4096
    end_id: int = 1
    group: int = 8192
    islands: int = 2
    epochs: int = 2
    population: int = 4
    generations: int = 12
    well_filled: float = 0.98
    seed: int = 7


def pieces(docs: DataFrame, tokenizer: str, cfg: Settings = Settings(), key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32; with ``ids`` also
    the ids themselves. A null or empty text is the end id alone; a repeated row
    is packed as often as it occurs; other columns are not read."""
    ship_package(docs.sparkSession)
    fields = [docs.schema[key], *T.StructType.fromDDL("piece int, start long, length long, ids_crc32 long").fields]
    if ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    end, capacity = cfg.end_id, cfg.capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, start, cut = [], [], []
                for i, data in enumerate(encode(part.column(1).to_pylist(), end)):
                    for k in range(0, len(data), 4 * capacity):
                        row.append(i)
                        start.append(k // 4)
                        cut.append(data[k : k + 4 * capacity])
                columns = [
                    part.column(0).take(pa.array(row, pa.int64())),
                    pa.array([s // capacity for s in start], pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array([len(c) // 4 for c in cut], pa.int64()),
                    pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                ]
                if ids:
                    columns.append(pa.array(cut, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.select(key, text).mapInArrow(run, T.StructType(fields))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing needs fewer bins: for each small size, what the larger pieces
    need by themselves, plus what their free space cannot take of the rest."""
    count = np.bincount(lengths, minlength=capacity + 1)
    total = count * np.arange(capacity + 1)
    many, much = np.cumsum(count), np.cumsum(total)
    half = capacity // 2
    size = np.arange(half + 1)
    below = np.maximum(size - 1, 0)
    huge = many[-1] - many[capacity - size]
    large = many[capacity - size] - many[half]
    free = large * capacity - (much[capacity - size] - much[half])
    middle = much[half] - np.where(size > 0, much[below], 0)
    return int((huge + large + np.maximum(0, -((free - middle) // capacity))).max())


class Bins:
    """Bins under construction; best fit finds the fullest bin with enough room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.bins: list[list[int]] = []
        self.rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = 0  # bit r is set where a bin has room r

    def add(self, bin_: list[int], filled: int) -> None:
        self._file(len(self.bins), self.capacity - filled)
        self.bins.append(bin_)

    def _file(self, number: int, room: int) -> None:
        self.rooms[room].append(number)
        self.open |= 1 << room

    def best_fit(self, item: int, length: int) -> None:
        fits = self.open >> length
        if not fits:
            self.add([item], length)
            return
        room = length + (fits & -fits).bit_length() - 1
        number = self.rooms[room].pop()
        if not self.rooms[room]:
            self.open ^= 1 << room
        self.bins[number].append(item)
        self._file(number, room - length)


def best_fit(items: list[int], lengths: list[int], capacity: int, start: list[list[int]] = ()) -> list[list[int]]:
    """Items, longest first, into the bins of ``start`` and new ones."""
    out = Bins(capacity)
    for bin_ in start:
        out.add(list(bin_), sum(lengths[i] for i in bin_))
    for item in sorted(items, key=lambda i: -lengths[i]):
        out.best_fit(item, lengths[item])
    return out.bins


def fitness(bins: list[list[int]], lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better; then bins that are full or nearly empty."""
    return -len(bins), sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(into: list[list[int]], source: list[list[int]], lengths: list[int], capacity: int, well_filled: float, rng: np.random.Generator) -> list[list[int]]:
    """Child of two packings: a random part of the source's well-filled bins whole,
    the bins of ``into`` that share no piece with them, the rest by best fit."""
    good = [b for b in source if sum(lengths[i] for i in b) >= well_filled * capacity]
    if not good:
        good = source
    share = rng.uniform(0.2, 0.8)
    injected = [b for b, x in zip(good, rng.random(len(good))) if x < share]
    taken = np.zeros(len(lengths), dtype=bool)
    taken[[i for b in injected for i in b]] = True
    kept, displaced = [], []
    for b in into:
        if any(taken[i] for i in b):
            displaced.extend(i for i in b if not taken[i])
        else:
            kept.append(b)
    # the poorest bin is emptied as well, so that children can be shorter than parents
    if kept:
        poorest = min(range(len(kept)), key=lambda k: sum(lengths[i] for i in kept[k]))
        displaced.extend(kept.pop(poorest))
    return best_fit(displaced, lengths, capacity, [*injected, *kept])


def evolve(population: list[list[list[int]]], lengths: list[int], bound: int, cfg: Settings, rng: np.random.Generator) -> list[list[int]]:
    """Best packing after the generations of one epoch; stops at the bound."""
    cap = cfg.capacity

    def score(p: list[list[int]]) -> tuple[int, float]:
        return fitness(p, lengths, cap)

    while len(population) < cfg.population:  # other packings: best fit in random order
        order = rng.permutation(len(lengths)).tolist()
        made = Bins(cap)
        for i in order:
            made.best_fit(i, lengths[i])
        population.append(made.bins)
    population = sorted(population, key=score, reverse=True)[: cfg.population]
    for _ in range(cfg.generations):
        if len(population[0]) <= bound:
            break
        a, b = rng.choice(len(population), 2, replace=False)
        child = crossover(population[min(a, b)], population[max(a, b)], lengths, cap, cfg.well_filled, rng)
        worst = len(population) - 1
        if score(child) > score(population[worst]):
            population[worst] = child
            population.sort(key=score, reverse=True)
    return population[0]


def _labels(bins: list[list[int]], n: int) -> np.ndarray:
    label = np.empty(n, dtype=np.int32)
    for number, b in enumerate(bins):
        label[b] = number
    return label


def _bins(label: np.ndarray) -> list[list[int]]:
    order = np.argsort(label, kind="stable")
    cuts = np.flatnonzero(np.diff(label[order])) + 1
    return [part.tolist() for part in np.split(order, cuts)]


def _first(frames: Iterator[pd.DataFrame], cfg: Settings) -> Iterator[pd.DataFrame]:
    """Best-fit decreasing, or the bins a group came with if they are fewer."""
    for frame in frames:
        out = []
        for lengths, given in zip(frame["lengths"], frame["given"]):
            sizes = np.asarray(lengths, dtype=np.int64)
            made = best_fit(list(range(len(sizes))), sizes.tolist(), cfg.capacity)
            if given is not None:
                came = _bins(np.asarray(given, dtype=np.int64))
                made = min(made, came, key=len)
            out.append((_labels(made, len(sizes)).tolist(), len(made) <= lower_bound(sizes, cfg.capacity)))
        yield pd.DataFrame({"grp": frame["grp"], "bins": [o[0] for o in out], "done": [o[1] for o in out]})


def _epoch(frames: Iterator[pd.DataFrame], cfg: Settings) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for row in frame.itertuples():
            lengths = np.asarray(row.lengths, dtype=np.int64)
            rng = np.random.default_rng([cfg.seed, row.grp, row.island, row.epoch])
            elites = [_bins(np.asarray(e, dtype=np.int64)) for e in row.elites]
            best = evolve(elites, lengths.tolist(), lower_bound(lengths, cfg.capacity), cfg, rng)
            score = fitness(best, lengths.tolist(), cfg.capacity)
            out.append((_labels(best, len(lengths)).tolist(), -score[0], score[1]))
        yield pd.DataFrame(
            {"grp": frame["grp"], "island": frame["island"], "bins": [o[0] for o in out], "n": [o[1] for o in out], "fill": [o[2] for o in out]}
        )


def _pack_groups(groups: DataFrame, cfg: Settings, level: int) -> DataFrame:
    """``groups(grp, items, given)`` to ``(grp, bins)``; lists follow the items."""
    short = groups.select("grp", F.col("items.length").alias("lengths"), "given")
    first = materialize(short.mapInPandas(lambda f: _first(f, cfg), "grp long, bins array<int>, done boolean"), f"pack-first-{level}")
    todo = first.where("NOT done")
    if todo.isEmpty():
        return first.select("grp", "bins")
    islands = F.explode(F.sequence(F.lit(0), F.lit(cfg.islands - 1)))
    state = todo.select("grp", islands.alias("island"), "bins")
    state_schema = "grp long, island int, bins array<int>, n int, fill double"
    for epoch in range(cfg.epochs):
        # each island keeps its best packing and gets that of the island before it
        stay = state.select("grp", "island", F.struct(F.lit(0).alias("came"), "bins").alias("elite"))
        moved = state.select("grp", F.pmod(F.col("island") + 1, F.lit(cfg.islands)).alias("island"), F.struct(F.lit(1).alias("came"), "bins").alias("elite"))
        elites = stay.union(moved).groupBy("grp", "island").agg(F.array_sort(F.collect_list("elite"))["bins"].alias("elites"))
        ready = elites.join(short.drop("given"), "grp").withColumn("epoch", F.lit(epoch))
        ready = ready.repartition(partitions_for(groups.sparkSession, 1, 1), "grp", "island")
        state = materialize(ready.mapInPandas(lambda f: _epoch(f, cfg), state_schema), f"pack-epoch-{level}-{epoch}")
    best = state.groupBy("grp").agg(F.max_by("bins", F.struct(-F.col("n"), "fill", -F.col("island"))).alias("bins"))
    return first.where("done").select("grp", "bins").union(best)


def pack(parts: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the rows of ``pieces``; any further
    columns of the rows are kept. An empty table stays empty."""
    spark = parts.sparkSession
    ship_package(spark)
    if "sequence_id" in parts.columns or "offset" in parts.columns:
        raise ValueError("Columns sequence_id and offset are made here.")
    own = parts.columns
    stored = materialize(parts.withColumn("__id", F.monotonically_increasing_id()), "pack-pieces")
    full = stored.where(F.col("length") >= cfg.capacity).select(*own, (-1 - F.col("__id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = stored.where(F.col("length") < cfg.capacity)
    n = rest.count()
    done = []
    number = max(1, math.ceil(n / cfg.group))
    spread = rest.select(F.pmod(F.xxhash64("__id"), F.lit(number)).alias("grp"), F.struct("length", "__id", *[c for c in own if c != "length"]).alias("item"), F.lit(None).cast("long").alias("at"))
    level = 0
    while n:
        gathered = (
            spread.repartition(max(1, min(number, partitions_for(spark, n, 8 * cfg.group))), "grp")
            .groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("item", "at"))).alias("both"))
        )
        given = F.when(F.exists("both.at", lambda x: x.isNotNull()), F.col("both.at"))
        groups = materialize(gathered.select("grp", F.col("both.item").alias("items"), given.alias("given")), f"pack-groups-{level}")
        packed = _pack_groups(groups, cfg, level)
        placed = groups.join(packed, "grp").select(
            "grp", F.explode(F.arrays_zip("items", "bins")).alias("z")
        ).select("grp", F.col("z.items").alias("item"), F.col("z.bins").alias("bin"))
        placed = placed.withColumn("filled", F.sum("item.length").over(Window.partitionBy("grp", "bin")))
        placed = placed.withColumn(
            "offset", F.sum("item.length").over(Window.partitionBy("grp", "bin").orderBy("item.length", "item.__id").rowsBetween(Window.unboundedPreceding, -1))
        )
        placed = materialize(placed, f"pack-level-{level}")
        poor = placed.where(F.col("filled") < cfg.well_filled * cfg.capacity)
        left = poor.count()
        fewer = max(1, math.ceil(left / cfg.group))
        last = number == 1 or fewer >= number
        closed = placed if last else placed.where(F.col("filled") >= cfg.well_filled * cfg.capacity)
        sequence = F.lit(level << 56) + F.shiftleft("grp", 20) + F.col("bin")
        done.append(closed.select("item.*", sequence.alias("sequence_id"), F.coalesce("offset", F.lit(0)).cast("long").alias("offset")))
        if last:
            break
        # whole bins of a group stay together, numbered across the groups that meet
        number = fewer
        spread = poor.select(F.pmod("grp", F.lit(number)).alias("grp"), "item", (F.shiftleft("grp", 20) + F.col("bin")).alias("at"))
        n = left
        level += 1
    for part in done:
        full = full.unionByName(part.select(*own, "sequence_id", "offset"))
    return full
