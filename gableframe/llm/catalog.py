"""Queries of the operators of this subpackage, and SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import scratch_path
from . import decontaminate, html_text, itq, kd_shards, licenses, likelihood, packing, quality, simhash, spelling, token_store, url_lists, vector_codes
from .catalog_sql import ORACLE_SQL


def tokenizer_file() -> str:
    """The vocabulary file of the packing and storing queries."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as captures of January 2024; the events are the list's changes: each event
    of three types puts the host, path or URL of a page on the list or takes it off. Page
    ids have no gaps, so the event's number modulo their count is its page."""
    pages = _table(spark, folder, "pages")
    seconds = F.lit(1704067200) + F.pmod(F.col("page_id") * 7919, F.lit(2592000))
    captures = pages.select("page_id", "url", F.timestamp_seconds(seconds).alias("fetched_at"))
    action = F.when(F.col("event_type") == "signup", "block").when(F.col("event_type") == "view", "allow")
    action = action.when(F.col("event_type") == "purchase", "remove")
    at = _table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp").alias("at"), action.alias("action"))
    name, way = url_lists.host(F.col("url")), url_lists.path(F.col("url"))
    turn = F.pmod("event_id", F.lit(4))
    kind = F.when(turn < 2, "domain").when(turn == 2, "prefix").otherwise("url")
    pattern = F.when(turn == 0, name).when(turn == 1, F.substring_index(name, ".", -3))
    pattern = pattern.when(turn == 2, F.element_at(url_lists.prefixes(name, way), -1)).otherwise(F.concat(name, way))
    named = at.where("action IS NOT NULL").withColumn("page_id", F.pmod("event_id", F.lit(max(1, pages.count()))))
    changes = named.join(pages.select("page_id", "url"), "page_id")
    changes = changes.select(kind.alias("kind"), pattern.alias("pattern"), "action", "at")
    found = url_lists.verdicts(captures, changes)
    return found.select("page_id", F.unix_micros("fetched_at").alias("fetched_us"), "verdict", "kind", "pattern", F.unix_micros("since").alias("since_us"))


def op2_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    return kd_shards.shard(_table(spark, folder, "documents")).withColumn("grown_shard", F.lit(None).cast("int"))


def op3_empirical_bayes(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = quality.score(docs, quality.fit(docs, _table(spark, folder, "labels")))
    names = {"__own": "own_probability", "__host": "host_rate", "__path": "path_rate", "__posterior": "posterior", "__kept": "kept"}
    return found.select("doc_id", *(F.col(old).alias(new) for old, new in names.items()))


def op4_genetic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.pieces(_table(spark, folder, "documents"), tokenizer_file()))


def op5_simhash_trees(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op6_block_tree(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(_table(spark, folder, "pages"))


def op7_license_families(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find(spark, _table(spark, folder, "documents"))


def op8_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op9_itq_vectors(spark: SparkSession, folder: str) -> DataFrame:
    found = itq.near_duplicates(_table(spark, folder, "embeddings")).withColumnRenamed("component", "component_id")
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_token_store(spark: SparkSession, folder: str) -> DataFrame:
    store = scratch_path(spark, "token-store")
    listed = token_store.write_store(_table(spark, folder, "documents"), store, tokenizer_file())
    return token_store.read_store(spark, store, listed)


def op11_adaptive_codes(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors, in 16 parts of 64 entries; see ``vector_codes`` for the defined cases."""
    return vector_codes.report(_table(spark, folder, "embeddings"))


def op12_target_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, against those whose labels are good; see ``likelihood``."""
    docs = _table(spark, folder, "documents")
    return likelihood.judge(docs, likelihood.fit(docs, _table(spark, folder, "labels")))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """All words of all documents; see ``spelling`` for the defined cases."""
    return spelling.variants(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_lists,
        op2_kd_shards,
        op3_empirical_bayes,
        op4_genetic_packing,
        op5_simhash_trees,
        op6_block_tree,
        op7_license_families,
        op8_positional_index,
        op9_itq_vectors,
        op10_token_store,
        op11_adaptive_codes,
        op12_target_likelihood,
        op13_spelling_variants,
    )
}

ORACLE: dict[str, str] = {
    "op1_url_lists": r"""
WITH parts AS (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS raw,
         TIMESTAMP '2024-01-01' + to_seconds(page_id * 7919 % 2592000) AS fetched
  FROM pages),
pages2 AS (
  SELECT page_id, host, CASE WHEN raw = '' THEN '/' ELSE raw END AS path, fetched FROM parts),
keyed AS (
  SELECT *, string_split(host, '.') AS labels, string_split(path, '/') AS steps FROM pages2),
keys AS (
  SELECT page_id, fetched, 1 AS rank, 'domain' AS kind, unnest(list_transform(range(1, greatest(len(labels), 2)), lambda i: array_to_string(labels[i:], '.'))) AS pattern
  FROM keyed WHERE host <> ''
  UNION ALL
  SELECT page_id, fetched, 2, 'prefix', unnest(list_transform(range(1, len(steps)), lambda i: host || array_to_string(steps[1:i], '/') || '/'))
  FROM keyed WHERE host <> ''
  UNION ALL
  SELECT page_id, fetched, 3, 'url', host || path FROM keyed WHERE host <> ''),
raw_changes AS (
  SELECT CASE WHEN event_id % 4 < 2 THEN 'domain' WHEN event_id % 4 = 2 THEN 'prefix' ELSE 'url' END AS kind,
         CASE event_id % 4 WHEN 0 THEN host WHEN 1 THEN array_to_string(labels[greatest(len(labels) - 2, 1):], '.')
           WHEN 2 THEN host || array_to_string(steps[1:len(steps) - 1], '/') || '/' ELSE host || path END AS pattern,
         CASE event_type WHEN 'signup' THEN 3 WHEN 'view' THEN 2 WHEN 'purchase' THEN 1 END AS action, ts
  FROM events JOIN keyed ON page_id = event_id % (SELECT count(*) FROM pages)),
changes AS (
  SELECT kind, pattern, ts, max(action) AS action FROM raw_changes WHERE action IS NOT NULL GROUP BY ALL),
held AS (
  SELECT *, lead(ts) OVER (PARTITION BY kind, pattern ORDER BY ts) AS until FROM changes),
met AS (
  SELECT k.page_id, h.action, k.kind, k.pattern, h.ts,
         row_number() OVER (PARTITION BY k.page_id ORDER BY k.rank DESC, length(k.pattern) DESC, k.pattern DESC) AS place
  FROM keys k JOIN held h ON k.kind = h.kind AND k.pattern = h.pattern AND h.ts <= k.fetched AND (h.until IS NULL OR k.fetched < h.until)
  WHERE h.action > 1)
SELECT p.page_id, epoch_us(p.fetched) AS fetched_us,
       CASE m.action WHEN 3 THEN 'block' WHEN 2 THEN 'allow' ELSE 'unlisted' END AS verdict,
       m.kind, m.pattern, epoch_us(m.ts) AS since_us
FROM parts p LEFT JOIN (SELECT * FROM met WHERE place = 1) m USING (page_id)
"""
} | ORACLE_SQL
