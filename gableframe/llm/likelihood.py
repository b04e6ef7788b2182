"""Quality rules: surface counts of a text, and a likelihood ratio of its n-grams.

A trusted text differs from a crawl by the words it uses. Single words and pairs
of neighbours are hashed into a fixed number of buckets; one multinomial over the
buckets is counted on trusted documents, one on the whole corpus. The mean
logarithm of their ratio over the n-grams of a document says which of the two
explains it better, whatever its length. Every document is measured against one
fixed threshold; nothing is drawn at random.

Weights are whole millionths, so sums do not depend on the order in which
partitions, threads or engines add them up.

Null, blank and empty texts have no words and fail the rules. Repeated rows are
judged, and counted in the corpus, as often as they stand there. A document is
trusted when all labels of its id are good and none is toxic; labels without an id
count for nothing. Without a trusted document, or without any document, all
weights are zero, so the rules alone decide.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package

MICRO = 1_000_000
PAIR = 1_000_003  # multiplies the first word's hash in that of a pair
WINDOW = 5
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Runs of letters and digits, or of ASCII punctuation.
TOKEN = re.compile("[0-9A-Za-z\x80-\U0010ffff]+|[!-/:-@\\[-`{-~]+")
_BREAK = re.compile("[\x00- \x7f]")
_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_PIECE = 1 << 20  # characters of a text that are cut into tokens at once
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams", "ratio_micro")


class Settings(NamedTuple):
    buckets: int = 1 << 14
    prior: int = 4  # occurrences of either multinomial that are assumed in every bucket, at a ratio of one
    sample: int = 100_000  # trusted documents the target is counted on, at most; the corpus is counted whole
    threshold_micro: int = -300_000  # least mean log ratio, in millionths
    least_words: int = 10
    repeat_percent: int = 20


class Hashes(dict):
    """Hash of a token, kept for the commonest. When full, the held ones become
    the older half, and those still in use come back from there."""

    held = 500_000

    def __init__(self) -> None:
        super().__init__()
        self.older: dict[str, int] = {}

    def __missing__(self, token: str) -> int:
        value = self.older.get(token)
        if value is None:
            value = int.from_bytes(hashlib.md5(token.encode(), usedforsecurity=False).digest()[:4], "big")
        if len(token) <= 64:
            if len(self) >= self.held:
                self.older = dict(self)
                self.clear()
            self[token] = value
        return value


_hashes = Hashes()


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > _PIECE:
        found = _BREAK.search(text, start + _PIECE)
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end
    yield text[start:]


def grams(text: str | None, buckets: int) -> Iterator[np.ndarray]:
    """Bucket of every word and of every pair of neighbours, in pieces."""
    last = np.empty(0, dtype=np.int64)
    for piece in _pieces((text or "").encode().translate(_LOWER).decode()):
        words = TOKEN.findall(piece)
        one = np.fromiter(map(_hashes.__getitem__, words), dtype=np.int64, count=len(words))
        run = np.concatenate([last, one])
        yield one % buckets
        yield (run[:-1] * PAIR + run[1:]) % buckets
        last = run[-1:]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that stand in the text twice or more. Windows are
    compared exactly, by ranks of ever longer runs of words; a run that stands there
    once begins no such window and is left out."""
    n = len(words) - window + 1
    number: dict[bytes, int] = {}
    one = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    if n < 2 or len(number) == len(words):
        return 0
    at = np.flatnonzero(np.bincount(one)[one[:n]] > 1)
    run = one[at]
    for i in range(1, window):
        _, run, times = np.unique(run * len(number) + one[at + i], return_inverse=True, return_counts=True)
        again = times[run] > 1
        at, run = at[again], run[again]
        if not len(at):
            return 0
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def surface(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated windows."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode()
    words = data.split()
    chars = len(text) - sum(text.count(c) for c in _SPACE)
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def trusted_ids(labels: DataFrame, key: str, sample: int) -> DataFrame:
    """Ids whose labels are all good and not toxic; of more than ``sample``, those
    of the smallest hashes."""
    good = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__id"))
    good = good.agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).where("quality = 1 AND toxic = 0")
    return good.select("__id").orderBy(F.xxhash64("__id"), "__id").limit(sample)


def fit(docs: DataFrame, labels: DataFrame, cfg: Settings = Settings(), text: str = "text", key: str = "doc_id") -> np.ndarray:
    """Weight of every bucket in millionths: the logarithm of its count in trusted
    documents over the count its share of the whole corpus lets expect there, the
    prior added to both. So a bucket of which little is known weighs little.

    A task counts its own rows and gives one row per bucket; the driver receives
    one row per bucket in all.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    ids = trusted_ids(labels, key, cfg.sample)  # bounded by the sample
    marked = rows.join(F.broadcast(ids), rows["__key"] == ids["__id"], "left").select(F.col("__id").isNotNull().alias("good"), "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, cfg.buckets), dtype=np.int64)
        for batch in batches:
            for good, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                for found in grams(row.as_py(), cfg.buckets):
                    counted = np.bincount(found, minlength=cfg.buckets)
                    counts[0] += counted
                    if good:
                        counts[1] += counted
        seen = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[0][seen]), pa.array(counts[1][seen])], names=["bucket", "raw", "good"])

    found = marked.mapInArrow(run, "bucket long, raw long, good long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    raw, good = np.zeros(cfg.buckets), np.zeros(cfg.buckets)
    for row in found.collect():
        raw[row.bucket], good[row.bucket] = row.raw, row.good
    expected = raw * (good.sum() / max(raw.sum(), 1))
    ratio = np.log((good + cfg.prior) / (expected + cfg.prior))
    return np.rint(ratio * MICRO).astype(np.int64)


def measured(batch: pa.RecordBatch, at: int, weights: np.ndarray, cfg: Settings) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
    """Measures, rule failures and verdicts of the texts in a batch's column."""
    rows = []
    for value in batch.column(at):
        text = value.as_py()
        found = [(len(g), int(weights[g].sum())) for g in grams(text, cfg.buckets)]
        rows.append((*surface(text), sum(n for n, _ in found), sum(w for _, w in found)))
    table = np.array(rows, dtype=np.int64).reshape(len(rows), len(MEASURES)).T
    n, repeats, count, ratio = table[0], table[4], table[5], table[6]
    failed = (n < cfg.least_words) | (100 * repeats > cfg.repeat_percent * n)
    return list(table), failed, ~failed & (ratio >= cfg.threshold_micro * count)


def judge(docs: DataFrame, weights: np.ndarray, cfg: Settings = Settings(), text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, the measures, ``base_failed`` and ``kept`` of every row.
    Other columns are not read. A kept column that has the name of a measure is
    replaced by it."""
    ship_package(docs.sparkSession)
    made = (*MEASURES, "base_failed", "kept")
    keep = tuple(c for c in keep if c not in made)
    picked = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, failed, good = measured(batch, len(keep), weights, cfg)
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, table), pa.array(failed), pa.array(good)], names=[*keep, *made])

    fields = [T.StructField(c, T.LongType()) for c in MEASURES] + [T.StructField(c, T.BooleanType()) for c in made[len(MEASURES) :]]
    return picked.mapInArrow(run, T.StructType([*picked.schema.fields[:-1], *fields]))


def keep_good(docs: DataFrame, labels: DataFrame, cfg: Settings = Settings(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that are kept, all their columns, whatever their names."""
    weights = fit(docs, labels, cfg, text, key)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(measured(batch, at, weights, cfg)[2]))

    return docs.mapInArrow(run, docs.schema)
