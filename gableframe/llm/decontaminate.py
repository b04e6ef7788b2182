"""Benchmark passages in training documents, by a positional inverted index.

The index stores postings of training tokens: term, document, position, and the
words around it. Which terms are stored is decided by the benchmark: every window
of an item is looked up by its rarest term in the corpus, so no list of a common
word is built when a rarer word stands beside it, and a window with a word that
the corpus lacks is done at once. The list of the rarest term is intersected with
those of the other terms at their offsets, by comparing the stored neighbours with
the words of the window. What is left are exact phrases. Proximity matches come
from the same postings: the rarest terms of an item within a span of words.

All of it is DataFrame operations. Terms are broadcast in blocks of bounded size;
a larger benchmark takes more passes, not larger broadcasts.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Settings:
    """``window``: consecutive words of an item that count as found. ``near_terms``
    rarest terms of an item within ``near_span`` words are a proximity match.
    ``block``: terms that are broadcast at once."""

    window: int = 10
    near_terms: int = 3
    near_span: int = 20
    block: int = 200_000


def words(text: Column) -> Column:
    """Words of a text: A to Z lower-cased, cut at ASCII that is no letter or digit.
    Null has none."""
    plain = F.length(text) == F.octet_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), _NO_WORD), "")


def _tokens(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document: its key, a hash of its text (rows of equal key and text
    have equal results), and its words."""
    return docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("h"), words(F.col(text)).alias("words"))


def _blocks(terms: DataFrame, size: int) -> list[DataFrame]:
    n = math.ceil(terms.count() / size)
    return [F.broadcast(terms.where(F.pmod(F.xxhash64("term"), F.lit(n)) == i)) for i in range(n)]


def corpus_counts(tokens: DataFrame, terms: DataFrame, cfg: Settings) -> DataFrame:
    """Occurrences in all documents of each of the terms that occurs at all."""
    out = None
    for block in _blocks(terms, cfg.block):
        part = tokens.select(F.explode("words").alias("term")).join(block, "term").groupBy("term").count()
        out = part if out is None else out.union(part)
    return terms.withColumn("count", F.lit(0).cast("long")).limit(0) if out is None else out


def windows(bench: DataFrame, cfg: Settings, key: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, at, window)``: all runs of ``window`` words of an item; all of a
    shorter item. Items without words have none. Item keys become text, null ''."""
    size, n = F.size("words"), cfg.window
    starts = F.when(size > n, F.sequence(F.lit(1), size - n + 1)).when(size > 0, F.array(F.lit(1)))
    items = bench.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("words"))
    return items.select("item", "words", F.explode(starts).alias("at")).select("item", "at", F.slice("words", F.col("at"), n).alias("window"))


def anchors(cut: DataFrame, counts: DataFrame) -> DataFrame:
    """``(wid, window, length, term, offset)``: each different window whose words all
    occur, with its rarest term and the place of that term in it."""
    different = cut.select("window").distinct().withColumn("wid", F.xxhash64("window"))
    terms = different.select("wid", "window", F.posexplode("window").alias("offset", "term"))
    known = terms.join(counts, "term")
    rarest = known.groupBy("wid", "window").agg(
        F.min(F.struct("count", "term", "offset")).alias("best"), F.count("*").alias("found")
    )
    whole = rarest.where(F.col("found") == F.size("window"))
    return whole.select("wid", "window", F.size("window").alias("length"), "best.term", "best.offset")


def rare_terms(bench: DataFrame, counts: DataFrame, cfg: Settings, key: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, term)``: the rarest terms of each item that has enough of them."""
    terms = bench.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), F.explode(F.array_distinct(words(F.col(text)))).alias("term")
    ).distinct()
    ranked = terms.join(counts, "term").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy("count", "term")))
    few = ranked.where(F.col("rank") <= cfg.near_terms)
    enough = few.groupBy("item").count().where(F.col("count") == cfg.near_terms).select("item")
    return few.join(enough, "item").select("item", "term")


def postings(tokens: DataFrame, reach: DataFrame, cfg: Settings) -> DataFrame:
    """``(term, key, h, position, before, around)`` for the terms of ``reach(term,
    before, after)``: ``around`` holds the words from ``before`` places ahead of the
    term (fewer at the start of the text) to ``after`` places behind it."""
    out = None
    for block in _blocks(reach, cfg.block):
        found = tokens.select("key", "h", "words", F.posexplode("words").alias("position", "term")).join(block, "term")
        ahead = F.least("before", "position")
        around = F.slice("words", F.col("position") - ahead + 1, ahead + 1 + F.col("after"))
        part = found.select("term", "key", "h", "position", ahead.alias("before"), around.alias("around"))
        out = part if out is None else out.union(part)
    return out


def find(docs: DataFrame, bench: DataFrame, cfg: Settings = Settings(), key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Exact matches ``(key, h, start, length, item)``, proximity matches ``(key, h,
    item, last)``, and the documents ``(key, h, n_words)``. Keys may be null or
    repeated; ``h`` tells texts of one key apart."""
    tokens = _tokens(docs, key, text)
    cut = materialize(windows(bench, cfg, item, item_text), "bench-windows")
    vocabulary = materialize(cut.select(F.explode("window").alias("term")).distinct(), "bench-terms")
    counts = materialize(corpus_counts(tokens, vocabulary, cfg), "bench-counts")
    anchored = materialize(anchors(cut, counts), "bench-anchors")
    rare = materialize(rare_terms(bench, counts, cfg, item, item_text), "bench-rare")
    reach = (
        anchored.select("term", F.col("offset").alias("before"), (F.col("length") - F.col("offset") - 1).alias("after"))
        .union(rare.select("term", F.lit(0), F.lit(0)))
        .groupBy("term").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    )
    listed = postings(tokens, materialize(reach, "bench-reach"), cfg)
    docs_seen = tokens.select("key", "h", F.size("words").cast("long").alias("n_words"))
    if listed is None:
        spark = docs.sparkSession
        kind = docs.schema[key].dataType.simpleString()
        exact = spark.createDataFrame([], f"key {kind}, h long, start long, length int, item string")
        return exact, spark.createDataFrame([], f"key {kind}, h long, item string, last long"), docs_seen
    index = materialize(listed, "bench-postings")
    # the neighbours at their offsets must be the other words of the window
    start = F.col("before") - F.col("offset")
    same = (start >= 0) & (F.slice("around", F.greatest(start, F.lit(0)) + 1, F.col("length")) == F.col("window"))
    phrases = index.join(anchored, "term").where(same)
    phrases = phrases.select("key", "h", (F.col("position") - F.col("offset")).cast("long").alias("start"), "length", "wid").distinct()
    owners = cut.select(F.xxhash64("window").alias("wid"), "item").distinct()
    exact = phrases.join(owners, "wid").select("key", "h", "start", "length", "item")
    near = index.select("key", "h", "term", F.col("position").cast("long").alias("position")).join(rare, "term")
    span = Window.partitionBy("key", "h", "item").orderBy("position").rangeBetween(1 - cfg.near_span, 0)
    near = near.withColumn("seen", F.size(F.collect_set("term").over(span))).where(F.col("seen") == cfg.near_terms)
    return exact, near.groupBy("key", "h", "item").agg(F.max("position").alias("last")), docs_seen


def report(docs: DataFrame, bench: DataFrame, cfg: Settings = Settings(), key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items_sha256,
    contaminated, n_near.

    A word is hit if it lies in an occurrence of a window. ``items_sha256`` digests
    the item keys found, sorted as text and joined by commas (of no keys: the digest
    of no bytes). ``n_near`` counts items with a proximity match. Null and empty
    texts have no words and no hits; repeated rows stay; a null key is a key like
    another. With an empty benchmark nothing is hit; other columns are not read.
    """
    exact, near, seen = find(docs, bench, cfg, key, text, item, item_text)
    exact = materialize(exact, "bench-exact")
    covered = exact.select("key", "h", "start", "length").distinct()
    covered = covered.select("key", "h", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("position"))
    hit = covered.distinct().groupBy("key", "h").agg(F.count("*").alias("n_hit"))
    named = exact.select("key", "h", "item").distinct().groupBy("key", "h").agg(
        F.count("*").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("item"))), 256).alias("items_sha256")
    )
    close = near.groupBy("key", "h").agg(F.count("*").alias("n_near"))
    parts = [f.withColumn("kind", F.lit(i)) for i, f in enumerate((hit, named, close))]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    summed = both.groupBy(F.col("key").alias("k"), F.col("h").alias("hh")).agg(
        *(F.max(c).alias(c) for c in ("n_hit", "n_items", "items_sha256", "n_near"))
    )
    summed = materialize(summed, "bench-summed")
    out = seen.join(summed, seen["key"].eqNullSafe(summed["k"]) & (seen["h"] == summed["hh"]), "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
        F.coalesce("n_near", zero).alias("n_near"),
    )


def clean(docs: DataFrame, bench: DataFrame, cfg: Settings = Settings(), key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of the documents without any window of the benchmark."""
    exact, _, _ = find(docs, bench, cfg, key, text, item, item_text)
    bad = materialize(exact.select(F.col("key").alias("__key"), F.col("h").alias("__h")).distinct(), "bench-bad")
    return docs.join(bad, docs[key].eqNullSafe(bad["__key"]) & (F.xxhash64(docs[text]) == bad["__h"]), "left_anti")
