"""Token ids in shard files with a minimal perfect hash index of document keys.

A shard file holds, one after the other: a magic word, the length of a JSON
header, the header, the keys of its documents in ascending order, the places of
their ids (one more than documents), the index, and the raw ids (two bytes each
if the vocabulary allows, else four, little-endian).

The index has levels of bits. A key sets the bit its hash picks in the first level
where no other remaining key picks the same. The number of set bits before it,
over all levels, is its rank, from 0 to the number of different keys less one. An
entry per rank stores a fingerprint of the key, its first document in the file and
how many documents repeat it. A lookup reads one entry and one stretch of ids
whatever the size of the file; a key that is not there fails by its fingerprint,
or, in one case in four thousand million, by the key stored with the document.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, partitions_for, ship_package
from .tokens import encoder

MAGIC = b"GTOKENS1"
_ENTRY = np.dtype([("mark", "<u4"), ("first", "<u4"), ("times", "<u4")])
_U = np.uint64


@dataclass(frozen=True)
class Settings:
    """``shard_tokens``: a shard is closed at the first document end from there
    on. ``text_bytes``: text per task, about. ``spread``: bits per key in a level."""

    end_id: int = 2
    shard_tokens: int = 4_000_000
    text_bytes: int = 32_000_000
    spread: float = 2.0


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = keys.astype(_U) + _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class PerfectHash:
    """Ranks 0 to n - 1 for n different keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # arrays of 64-bit words
        counts = [np.bitwise_count(words).astype(np.int64) for words in levels]
        totals = np.cumsum([0] + [int(c.sum()) for c in counts])
        self.before = [base + np.cumsum(c) - c for base, c in zip(totals, counts)]

    @classmethod
    def build(cls, keys: np.ndarray, spread: float) -> "PerfectHash":
        rest, levels = keys.astype(_U), []
        while len(rest):
            words = max(1, int(len(rest) * spread) // 64)
            slot = (mixed(rest, len(levels)) % _U(words * 64)).astype(np.int64)
            alone = np.bincount(slot, minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            rest = rest[~alone[slot]]
        return cls(levels)

    def rank(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each key; -1 if no level has its bit (then it is not there)."""
        keys = keys.astype(_U)
        out = np.full(len(keys), -1, dtype=np.int64)
        for level, words in enumerate(self.levels):
            open_ = np.flatnonzero(out < 0)
            slot = mixed(keys[open_], level) % _U(len(words) * 64)
            word, bit = (slot >> _U(6)).astype(np.int64), slot & _U(63)
            hit = (words[word] >> bit) & _U(1) == 1
            lower = words[word] & ((_U(1) << bit) - _U(1))
            place = self.before[level][word] + np.bitwise_count(lower).astype(np.int64)
            out[open_[hit]] = place[hit]
        return out


def shard_bytes(keys: list[int | None], ids: list[bytes], wide: bool, spread: float = 2.0) -> bytes:
    """A shard of documents in ascending key order, null keys first; ``ids`` are
    little-endian 32-bit numbers."""
    nulls = sum(k is None for k in keys)
    known = np.array([0 if k is None else k for k in keys], dtype="<i8")
    ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype("<u8")
    unique, first, times = np.unique(known[nulls:], return_index=True, return_counts=True)
    hashed = PerfectHash.build(unique.view(_U), spread)
    rank = hashed.rank(unique.view(_U))
    entries = np.empty(len(unique), dtype=_ENTRY)
    entries["mark"][rank] = mark(unique.view(_U))
    entries["first"][rank] = first + nulls
    entries["times"][rank] = times
    payload = np.frombuffer(b"".join(ids), dtype="<u4").astype("<u4" if wide else "<u2")
    parts = [known.tobytes(), ends.tobytes(), entries.tobytes(), *(w.tobytes() for w in hashed.levels), payload.tobytes()]
    header = json.dumps(
        {"documents": len(keys), "nulls": nulls, "keys": len(unique), "levels": [len(w) for w in hashed.levels], "width": 4 if wide else 2}
    ).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *parts])


def mark(keys: np.ndarray) -> np.ndarray:
    """Fingerprints, independent of the hashes of the levels."""
    return (mixed(keys, 1 << 20) >> _U(32)).astype("<u4")


class Shard:
    """Opens a shard: reads the index, leaves the ids where they are."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        if file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("This is no token shard.")
        length = int.from_bytes(file.read_at(4, 8), "little")
        head = json.loads(file.read_at(length, 12))
        self.nulls, self.width, n = head["nulls"], head["width"], head["documents"]
        sizes = [8 * n, 8 * (n + 1), _ENTRY.itemsize * head["keys"], *(8 * w for w in head["levels"])]
        data = file.read_at(sum(sizes), 12 + length)
        cuts = np.cumsum([0] + sizes).tolist()
        parts = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        self.keys = np.frombuffer(parts[0], dtype="<i8")
        self.places = np.frombuffer(parts[1], dtype="<u8").astype(np.int64)
        self.entries = np.frombuffer(parts[2], dtype=_ENTRY)
        self.hash = PerfectHash([np.frombuffer(p, dtype="<u8") for p in parts[3:]])
        self.payload = 12 + length + sum(sizes)

    def documents(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; 0 of them if absent."""
        if not len(self.entries):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        rank = self.hash.rank(keys.view(_U))
        entry = self.entries[np.maximum(rank, 0)]
        first = entry["first"].astype(np.int64)
        there = (rank >= 0) & (entry["mark"] == mark(keys.view(_U))) & (self.keys[first] == keys)
        return first, np.where(there, entry["times"], 0).astype(np.int64)

    def ids(self, document: int) -> np.ndarray:
        start, end = int(self.places[document]), int(self.places[document + 1])
        raw = self.file.read_at((end - start) * self.width, self.payload + start * self.width)
        return np.frombuffer(raw, dtype="<u4" if self.width == 4 else "<u2").astype("<u4")

    def get(self, key: int | None) -> list[np.ndarray]:
        """Ids of all documents with the key, in the order of the file."""
        if key is None:
            return [self.ids(i) for i in range(self.nulls)]
        first, times = self.documents(np.array([key], dtype="<i8"))
        return [self.ids(i) for i in range(int(first[0]), int(first[0] + times[0]))]


def _file_system(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write_store(docs: DataFrame, folder: str, tokenizer: str, cfg: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the shards of a table with integer keys below ``folder``, a folder
    all executors share, and returns their list: file, start (ids in all shards
    before), documents, tokens, first_key, last_key.

    Documents go in ascending key order, null keys first, repeated keys by text.
    A null or empty text is the end id alone. Other columns are not read. An empty
    table gives no shards. A shard is written under another name and then renamed,
    so a task that runs again replaces its own files only by equal ones.
    """
    spark = docs.sparkSession
    ship_package(spark)
    ids_up_to = _vocabulary(tokenizer)
    picked = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    size = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = partitions_for(spark, size, cfg.text_bytes)
    # equal keys may fall to several tasks, so that a repeated key is no bottleneck
    tie = [F.col("key").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = picked.select("key", "text", tie[1].alias("h"), tie[2].alias("row"))
    order = [F.col("key").asc_nulls_first(), "h", "row"]
    ordered = ordered.repartitionByRange(n, *order).sortWithinPartitions(*order).select("key", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        system, path = _file_system(folder)
        encode = encoder(tokenizer).encode
        keys: list[int | None] = []
        ids: list[bytes] = []
        made, tokens = 0, 0

        def close() -> pa.RecordBatch:
            name = f"shard-{task:06d}-{made:05d}.tok"
            temporary = f"{path}/_writing-{uuid.uuid4().hex}"
            with system.open_output_stream(temporary) as out:
                out.write(shard_bytes(keys, ids, ids_up_to > 1 << 16, cfg.spread))
            system.move(temporary, f"{path}/{name}")
            row = {"task": task, "number": made, "file": name, "documents": len(keys), "tokens": tokens, "first_key": keys[0], "last_key": keys[-1]}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([(k, pa.string() if k == "file" else pa.int64()) for k in row]))

        system.create_dir(path, recursive=True)
        for batch in batches:
            # so many that the encoder fills its groups: it learns the new words of a group together
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                keys.extend(part.column(0).to_pylist())
                ids.extend(new := encode(part.column(1).to_pylist(), cfg.end_id))
                tokens += sum(map(len, new)) // 4
                if tokens >= cfg.shard_tokens:
                    yield close()
                    keys, ids, made, tokens = [], [], made + 1, 0
        if keys:
            yield close()

    schema = "task long, number long, file string, documents long, tokens long, first_key long, last_key long"
    listed = materialize(ordered.mapInArrow(write, schema), "token-shards")
    # one row per shard file: small beside the data whatever its size
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))
    return materialize(listed.withColumn("start", starts).drop("task", "number"), "token-list")


def _vocabulary(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)


def read_store(spark: SparkSession, folder: str, listed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every document of the shard files, found through the index: key, start,
    n_tokens, ids_crc32."""
    ship_package(spark)
    schema = T.StructType.fromDDL("file string, key long, at long, n_tokens long, ids_crc32 long")
    empty = listed.isEmpty()
    if empty:
        return spark.createDataFrame([], f"{key} long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                shard = Shard(pa.BufferReader(content.as_buffer()))
                keys = np.unique(shard.keys[shard.nulls :])
                first, times = shard.documents(keys)
                if not (times > 0).all():
                    raise ValueError(f"Damaged index in {path.as_py()}")
                order = np.repeat(first, times) + np.concatenate([np.arange(t) for t in times]).astype(np.int64) if len(keys) else np.empty(0, np.int64)
                order = np.r_[np.arange(shard.nulls), order].astype(np.int64)
                name = path.as_py().rpartition("/")[2]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(order), pa.string()),
                        pa.array(shard.keys[order], mask=order < shard.nulls),
                        pa.array(shard.places[order]),
                        pa.array(shard.places[order + 1] - shard.places[order]),
                        pa.array([zlib.crc32(shard.ids(i).tobytes()) for i in order.tolist()], pa.int64()),
                    ],
                    names=schema.names,
                )

    rows = files.select("path", "content").mapInArrow(read, schema)
    starts = listed.select("file", "start")
    return rows.join(starts, "file").select(F.col("key").alias(key), (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def get(spark: SparkSession, folder: str, listed: DataFrame, key: int) -> list[np.ndarray]:
    """Ids of the documents with a key: its shards by their key ranges, then one
    index entry and one stretch of ids in each."""
    inside = listed.where((F.col("last_key") >= key) & ((F.col("first_key") <= key) | F.col("first_key").isNull()))
    system, path = _file_system(folder)
    out = []
    for (name,) in inside.orderBy("start").select("file").collect():
        with system.open_input_file(f"{path}/{name}") as file:
            out.extend(Shard(file).get(key))
    return out
