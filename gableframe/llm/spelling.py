"""Spelling variants: words one letter apart, found with a bit-sliced index.

The index of a block of words holds, for every position and letter, a bitset of
the words that have that letter there. A word is looked up letter by letter: one
bitset holds the words that agree with it so far, three more those with one error
behind them, whose further letters are compared at the same position (a letter
replaced), one ahead (a letter of theirs inserted) or one behind (a letter of theirs
missing). Every step is a few operations on whole machine words, done for all
words of the block at once.

Blocks are made of shards. Of two words one error apart, cut at the middle of the
shorter one, the first halves or the last halves are equal; so each word goes to the
shards of its halves, as the shorter word and as the longer, and every pair meets.
A shard of more than ``leaf`` words is handed on and its unequal rest is halved
again, until the words differ at one place only and the alphabet bounds the shard.
No shard has a cap, and no two words are compared outside a shard.

Defined cases. Null, empty and wordless texts add nothing; a null id is written as
no characters before the colon. Repeated rows count as often as they stand there.
Ties go to the smaller word in code-point order. An empty table gives an empty
table. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions_for, ship_package

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST = 5  # code points of a word
SEEN = 3  # occurrences of a word
SLIP = 97
LEAF = 4096  # words of a shard
BLOCK = 1024  # words of a block of several shards
_CELLS = 1 << 20  # letters of a block
_HELD = 300_000  # words a task counts before it gives them on
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PLACED = "shard long, base int, front int, back int, word string, n long"


def runs(text: str | None) -> Counter:
    """Lower-cased runs of letters of a text and how often each stands there."""
    return Counter(RUN.findall((text or "").encode().translate(_LOWER).decode()))


def slipped(prefix: int, run: str) -> str:
    """The run as it is spelt in one document, given the checksum of its id and colon."""
    h = zlib.crc32(run.encode(), prefix)
    at = h % len(run)
    return run if h % SLIP else run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id", seen: int = SEEN) -> DataFrame:
    """``(word, n)`` of the words that stand at least ``seen`` times in all documents."""
    ship_package(docs.sparkSession)
    picked = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__key"), F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for name, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                prefix = zlib.crc32(f"{name}:".encode())
                for found, n in runs(row.as_py()).items():
                    if len(found) >= LEAST and len(word := slipped(prefix, found)) >= LEAST:
                        counts[word] += n
                if len(counts) > _HELD:
                    yield given()
                    counts.clear()
        yield given()

    found = picked.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= seen)


def _shard(base: Column, front: Column, back: Column) -> Column:
    """A shard: words of ``base`` letters or one more that agree in their first
    ``front`` and last ``back`` letters. Equal numbers of two shards only join them."""
    ends = F.substring(F.col("word"), F.lit(1), front), F.right(F.col("word"), back)
    return F.struct(F.xxhash64(base, front, back, *ends).alias("shard"), base.alias("base"), front.alias("front"), back.alias("back"))


def _halves(base: Column, front: Column, back: Column) -> Column:
    """The two shards that hold all near pairs of a shard; itself when one place is left."""
    rest = base - front - back
    half = F.floor(rest / 2).cast("int")
    both = F.array(_shard(base, front + half, back), _shard(base, front, back + (rest - half)))
    return F.when(rest > 1, both).otherwise(F.array(_shard(base, front, back)))


def place(words: DataFrame) -> DataFrame:
    """The first shards of ``(word, n)``: as the shorter and as the longer word of a pair."""
    long, none = F.length("word"), F.lit(0)
    shards = F.concat(_halves(long, none, none), F.when(long > 1, _halves(long - 1, none, none)).otherwise(F.array()))
    return words.select(F.explode(shards).alias("at"), "word", "n").select("at.*", "word", "n")


def refine(crowd: DataFrame) -> DataFrame:
    halves = _halves(F.col("base"), F.col("front"), F.col("back"))
    return crowd.select(F.explode(halves).alias("at"), "word", "n").select("at.*", "word", "n")


def letters(words: list[str]) -> np.ndarray:
    """Code points by word and position; zero behind the end."""
    longest = max(map(len, words))
    return np.array(words, dtype=f"<U{longest}").view(np.uint32).reshape(len(words), longest)


def near_in_block(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All ordered pairs of words that are exactly one error apart, as two index
    arrays. The words differ from each other or are equal; equal ones are no pair."""
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    spelt = letters([words[i] for i in order])
    n, longest = spelt.shape
    length = (spelt != 0).sum(axis=1)
    wide = (n + 63) // 64
    alphabet, code = np.unique(spelt, return_inverse=True)
    code = code.reshape(n, longest)
    bit = np.uint64(1) << (np.arange(n) % 64).astype(np.uint64)
    # slices[p + 1, letter]: the words that have the letter at position p
    slices = np.zeros((longest + 3, len(alphabet), wide), dtype=np.uint64)
    which, at = np.nonzero(spelt)
    np.bitwise_or.at(slices, (at + 1, code[which, at], which // 64), bit[which])
    has = np.bitwise_or.reduce(slices, axis=1)  # the words that reach position p
    sized = np.zeros((longest + 3, wide), dtype=np.uint64)
    np.bitwise_or.at(sized, (length, np.arange(n) // 64), bit)
    same = np.full((n, wide), ~np.uint64(0))
    other, ahead, behind = (np.zeros((n, wide), dtype=np.uint64) for _ in range(3))
    found = np.zeros((n, wide), dtype=np.uint64)
    live = n  # the longest words come first, so those not yet at their end are the first
    for i in range(longest + 1):
        ended = int(np.searchsorted(-length, -i, side="left"))
        if ended < live:  # words of i letters
            done = slice(ended, live)
            found[done] = (other[done] & sized[i]) | ((ahead[done] | same[done]) & sized[i + 1])
            if i:
                found[done] |= behind[done] & sized[i - 1]
            live = ended
        if not live:
            break
        letter, now = code[:live, i], slice(0, live)
        here, next_one, before = slices[i + 1, letter], slices[i + 2, letter], slices[i, letter]
        behind[now] = (behind[now] & before) | same[now]
        ahead[now] = (ahead[now] | (same[now] & has[i + 1])) & next_one
        other[now] = (other[now] & here) | (same[now] & ~here & has[i + 1])
        same[now] &= here
    rows, words_at = np.nonzero(found)
    bits = np.unpackbits(found[rows, words_at].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pick, place_in = np.nonzero(bits)
    index = np.array(order)
    return index[rows[pick]], index[words_at[pick] * 64 + place_in]


def search(batches: Iterator[pa.RecordBatch], leaf: int) -> Iterator[pa.RecordBatch]:
    """Near pairs ``(word, near, near_n)`` within each run of equal shards; the rows of
    a run beyond ``leaf`` words are handed on with a null ``near``."""
    held: list[tuple] = []  # rows of whole shards not yet searched
    run: list[tuple] = []  # rows of the shard that is being read
    crowded, shard = False, None

    def most(row: tuple) -> int:
        """Rows of a shard that is searched as it is; with one place left, the alphabet bounds it."""
        base, front, back = row[1:4]
        return min(leaf, max(64, _CELLS // base)) if base - front - back > 1 else 1 << 30

    def full() -> bool:
        rows = len(held) + len(run)
        return rows > BLOCK or rows * (run[0][1] + 1) > _CELLS

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != shard:
                if crowded and run:
                    yield _handed(run)
                elif run:
                    if held and full():
                        yield from _pairs(held)
                        held = []
                    held += run
                shard, run, crowded = row[0], [], False
            run.append(row)
            if len(run) > (BLOCK if crowded else most(row)):
                yield _handed(run)
                run, crowded = [], True
    if crowded and run:
        yield _handed(run)
    else:
        held += run
    if held:
        yield from _pairs(held)


def _columns(rows: list[tuple], near: list, near_n: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
    names = ["shard", "base", "front", "back", "word", "n", "near", "near_n"]
    return pa.RecordBatch.from_arrays([*columns, pa.array(near, pa.string()), pa.array(near_n, pa.int64())], names=names)


def _handed(rows: list[tuple]) -> pa.RecordBatch:
    return _columns(rows, [None] * len(rows), [None] * len(rows))


def _pairs(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    a, b = near_in_block([r[4] for r in rows])
    shard = np.array([r[0] for r in rows])
    inside = shard[a] == shard[b]
    a, b = a[inside].tolist(), b[inside].tolist()
    for start in range(0, len(a), 10_000):
        one, two = a[start : start + 10_000], b[start : start + 10_000]
        yield _columns([rows[i] for i in one], [rows[i][4] for i in two], [rows[i][5] for i in two])


def neighbours(words: DataFrame, leaf: int = LEAF) -> DataFrame:
    """``(word, n, near, near_n)``: all ordered pairs of words exactly one error
    apart. ``words`` is ``(word, n)`` with different, non-empty words."""
    spark = words.sparkSession
    placed, out, level = place(words), None, 0
    total = 4 * words.count()
    while True:
        parts = partitions_for(spark, total, 200_000)
        sorted_rows = placed.repartition(parts, "shard").sortWithinPartitions("base", "shard", "word")
        ship_package(spark)
        found = materialize(sorted_rows.mapInArrow(lambda batches: search(batches, leaf), f"{_PLACED}, near string, near_n long"), f"spelling-{level}")
        pairs = found.where("near IS NOT NULL").select("word", "n", "near", "near_n")
        out = pairs if out is None else out.union(pairs)
        crowd = found.where("near IS NULL")
        if not (handed := crowd.count()):
            break
        placed, total, level = refine(crowd.select("base", "front", "back", "word", "n")), 2 * handed, level + 1
    return out.distinct()  # a pair may meet in the shard of its first halves and of its last


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)``: the last word reached. Every round
    skips to the form of the form, so rounds grow with the logarithm of the chain."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots-0")
    step = 0
    while True:
        step += 1
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(now.join(further, "root", "left"), f"spelling-roots-{step}")
        now = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.where("further IS NOT NULL").isEmpty():
            return now


def variants(docs: DataFrame, text: str = "text", key: str = "doc_id", leaf: int = LEAF) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every word of the vocabulary."""
    words = materialize(vocabulary(docs, text, key), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = neighbours(words, leaf).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    good = -F.col("best.less") >= 2 * F.col("n")
    named = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n")
    )
    named = materialize(named, "spelling-forms")
    found = roots(named.where("form IS NOT NULL").select("word", "form"))
    return named.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))
