"""Shards of near-equal bytes from a k-d tree over document metadata.

A node that stands for more than one shard is split along the dimension that is
widest in it, measured against the range of that dimension over all documents, at
the value below which lie the bytes of half its shards. Leaves thus reach the
target bytes (all bytes over the number of shards), which need not be a power of
two. The weighted median is found by histograms of all nodes at once: each pass
sums bytes by bin, and the bin that holds the median is cut into bins again, down
to one value and then, among rows of that value, to one row. The driver sees bins
and the tree, never rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

LAW = "bytes"


@dataclass(frozen=True)
class Settings:
    """``bins``: per node and pass; the driver gets at most bins times shards sums.
    ``slot_rows``: rows numbered by one task."""

    shards: int = 24
    row_bytes: int = 8
    bins: int = 1024
    slot_rows: int = 100_000


@dataclass
class Node:
    first: int  # first shard
    count: int  # number of shards
    dim: str = ""
    value: int = 0
    tie: int = 0  # rows of the same value with a tie up to this go left
    below: "Node | None" = None
    above: "Node | None" = None


@dataclass
class _Search:
    """Where a node's median is looked for: bins between low and high."""

    node: Node
    dim: str
    target: float
    low: int
    high: int
    passed: float = 0.0  # bytes known to lie below
    value: int | None = None  # set once the value is known and ties are searched
    done: bool = False

    def width(self, bins: int) -> int:
        return max(1, math.ceil((self.high - self.low + 1) / bins))


def coordinate(df: DataFrame, name: str) -> Column:
    """A metadata column as an integer: numbers rounded down, booleans 0 or 1, other
    types by the first seven bytes of their text, in order. Null is 0."""
    kind = dict(df.dtypes)[name]
    column = F.col(name)
    if kind in ("tinyint", "smallint", "int", "bigint", "boolean"):
        number = column.cast("long")
    elif kind in ("float", "double") or kind.startswith("decimal"):
        number = F.floor(F.when(~F.isnan(column.cast("double")), column.cast("double"))).try_cast("long")
    elif kind in ("timestamp", "date"):
        number = F.unix_timestamp(column.cast("timestamp"))
    else:
        number = F.conv(F.rpad(F.substring(F.hex(F.encode(column.cast("string"), "utf-8")), 1, 14), 14, "0"), 16, 10).cast("long")
    return F.coalesce(number, F.lit(0).cast("long"))


def shard(docs: DataFrame, dims: tuple[str, ...] = ("source", "lang", "n_chars"), text: str = "text", keep: tuple[str, ...] = ("doc_id",), cfg: Settings = Settings()) -> DataFrame:
    """The ``keep`` columns, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``.

    Size is the UTF-8 bytes of the text and ``row_bytes``; a null text has none and
    the check sum of no bytes. Slots count from 0 in each shard without gaps. Rows
    that agree in every dimension are split by a hash of their place, so that no
    value, source or group of copies, however common, makes a shard heavy. Fewer
    rows than shards leave shards empty; an empty table gives an empty table.
    Columns named like the results are refused in ``keep``.
    """
    made = {"size", "text_crc32", "law", "shard", "slot"}
    if made & set(keep):
        raise ValueError(f"These columns are made here: {sorted(made & set(keep))}")
    names = [f"__d{i}" for i in range(len(dims))]
    raw = F.coalesce(F.encode(F.col(text), "utf-8"), F.lit(b""))
    points = docs.select(
        *keep,
        (F.octet_length(raw) + cfg.row_bytes).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        *(coordinate(docs, d).alias(n) for d, n in zip(dims, names)),
        F.monotonically_increasing_id().alias("__row"),
    )
    points = materialize(points, "kd-points").withColumn("__tie", F.shiftrightunsigned(F.xxhash64("__row"), 1))
    _, placed = grow(points, names, cfg)
    rows = placed.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    pieces = max(1, math.ceil(rows / cfg.slot_rows))
    placed = placed.withColumn("__piece", F.pmod("__tie", F.lit(pieces)))
    before = Window.partitionBy("shard").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "__piece").count()
    starts = counts.select("shard", "__piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    number = F.row_number().over(Window.partitionBy("shard", "__piece").orderBy("__tie", "__row"))
    out = placed.withColumn("__number", number).join(starts, ["shard", "__piece"])
    slot = (F.col("__start") + F.col("__number") - 1).cast("long").alias("slot")
    return out.select(*keep, "size", "text_crc32", F.lit(LAW).alias("law"), "shard", slot)


def grow(points: DataFrame, dims: list[str], cfg: Settings) -> tuple[Node, DataFrame]:
    """The tree, and the points with their ``shard``; ``points`` has the dimensions,
    ``size`` and ``__tie``. Each level writes the points with their node, so that a
    pass reads a finished table."""
    root = Node(0, cfg.shards)
    span: dict[str, int] = {}
    inside, level = points.withColumn("__node", F.lit(0)), 0
    while open_ := [n for n in _leaves(root) if n.count > 1]:
        ends = [f(d).alias(f"{n}{d}") for d in dims for n, f in (("low", F.min), ("high", F.max))]
        seen = {r["__node"]: r for r in inside.groupBy("__node").agg(F.sum("size").alias("bytes"), *ends).collect()}
        if not span:
            span = {d: max(1, seen[0][f"high{d}"] - seen[0][f"low{d}"]) if seen else 1 for d in dims}
        searches = []
        for node in open_:
            half = node.count // 2
            node.below, node.above = Node(node.first, half), Node(node.first + half, node.count - half)
            node.dim = dims[0]
            if node.first in seen:  # a node without rows is split anyhow
                row = seen[node.first]
                node.dim = max(dims, key=lambda d: (row[f"high{d}"] - row[f"low{d}"]) / span[d])
                searches.append(_Search(node, node.dim, row["bytes"] * half / node.count, row[f"low{node.dim}"], row[f"high{node.dim}"]))
        while live := [s for s in searches if not s.done]:
            _narrow(inside, live, dims, cfg.bins)
        level += 1
        inside = materialize(_down(inside, open_, dims), f"kd-level-{level}")
    return root, inside.withColumnRenamed("__node", "shard")


def _at_most(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """One row per node, to be joined to the points: at most as many as shards."""
    return F.broadcast(df.sparkSession.createDataFrame(rows, f"__node int, {schema}"))


def _narrow(inside: DataFrame, searches: list[_Search], dims: list[str], bins: int) -> None:
    """One pass: histograms for all searches, each then continues in one bin."""
    ways = [
        (s.node.first, dims.index(s.dim), s.value is not None, s.value or 0, s.low, s.high, s.width(bins)) for s in searches
    ]
    rows = inside.join(_at_most(inside, ways, "dim int, tied boolean, value long, low long, high long, width long"), "__node")
    here = F.element_at(F.array(*dims), F.col("dim") + 1)
    rows = rows.where(~F.col("tied") | (here == F.col("value")))
    rows = rows.withColumn("at", F.when(F.col("tied"), F.col("__tie")).otherwise(here)).where("at BETWEEN low AND high")
    binned = rows.groupBy("__node", F.expr("(at - low) div width").alias("bin")).agg(
        F.sum("size").alias("bytes"), F.min("at").alias("least"), F.max("at").alias("most")
    )
    found: dict[int, list] = {}
    for row in binned.collect():
        found.setdefault(row["__node"], []).append(row)
    for s in searches:
        ordered = sorted(found[s.node.first], key=lambda r: r["bin"])
        for row in ordered[:-1]:
            if s.passed + row["bytes"] >= s.target:
                break
            s.passed += row["bytes"]
        else:
            row = ordered[-1]
        s.low, s.high = row["least"], row["most"]
        if s.low < s.high:
            continue
        if s.value is None:  # the value is known: now the rows that share it
            s.value, s.low, s.high = s.low, 0, (1 << 63) - 1
            continue
        # one row (or rows of one tie) is left: it goes where the split is closer
        closer = s.target - s.passed > s.passed + row["bytes"] - s.target
        s.node.value, s.node.tie, s.done = s.value, s.low if closer else s.low - 1, True


def _leaves(node: Node) -> list[Node]:
    return [node] if node.below is None else _leaves(node.below) + _leaves(node.above)


def _down(inside: DataFrame, split: list[Node], dims: list[str]) -> DataFrame:
    """Points of the nodes just split, in their children; a node goes by its first shard."""
    ways = [(n.first, dims.index(n.dim), n.value, n.tie, n.above.first) for n in split]
    rows = inside.join(_at_most(inside, ways, "dim int, value long, tie long, above int"), "__node", "left")
    here = F.element_at(F.array(*dims), F.coalesce("dim", F.lit(0)) + 1)
    right = (here > F.col("value")) | ((here == F.col("value")) & (F.col("__tie") > F.col("tie")))
    node = F.when(right, F.col("above")).otherwise(F.col("__node")).alias("__node")
    return rows.select(*(c for c in inside.columns if c != "__node"), node)
