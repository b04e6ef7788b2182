"""Artifact registry, metric log, run log and lineage as append-only tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.labels import metric_key
from .workspace import claim, materialize, path_exists

ARTIFACT = (
    "name string, type string, version int, job string, path string, description string, "
    "metadata map<string,string>, aliases array<string>, tags array<string>, "
    "inputs array<string>, created_at timestamp"
)
METRIC = "key string, model string, split string, metric string, value double, job string, logged_at timestamp"
RUN = "step string, started_at timestamp, seconds double, status string, n_rows bigint, error string"


def numbered(records: DataFrame, order: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """Version numbers for new records of each name: one above the highest
    ``known`` one, then counting up in ``order``."""
    rank = F.row_number().over(W.partitionBy("name").orderBy(*order))
    if known is None:
        return records.withColumn("version", rank)
    last = known.groupBy("name").agg(F.max("version").alias("__last"))
    joined = records.join(last, "name", "left")
    return joined.withColumn("version", rank + F.coalesce("__last", F.lit(0))).drop("__last")


def resolve(artifacts: DataFrame, alias: str = "latest") -> DataFrame:
    """For every name the newest version that carries the alias. ``v3`` and the
    like mean that version. One row per name is kept in each task before the
    shuffle."""
    if alias.startswith("v") and alias[1:].isdigit():
        return artifacts.where(F.col("version") == int(alias[1:]))
    window = W.partitionBy("name").orderBy(F.desc("version"))
    held = artifacts.where(F.array_contains("aliases", alias))
    return held.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def preferred(artifacts: DataFrame, names: Sequence[str], alias: str = "latest") -> DataFrame:
    """The record of the first of ``names`` that is registered, one row at most:
    the tuned model if there is one, else the best baseline."""
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("name"))
    return resolve(artifacts.where(rank > 0), alias).orderBy(rank).limit(1)


def parents(artifacts: DataFrame) -> DataFrame:
    """Lineage: one row per artifact and input, with the input's own record.
    Inputs are written ``name:v2``."""
    key = F.concat_ws(":v", "name", F.col("version").cast("string"))
    source = artifacts.select(
        key.alias("input"), F.col("type").alias("input_type"), F.col("path").alias("input_path")
    )
    edges = artifacts.select("name", "version", F.explode("inputs").alias("input"))
    return edges.join(source, "input", "left").select(
        "name", "version", "input", "input_type", "input_path"
    )


def ancestors(artifacts: DataFrame) -> DataFrame:
    """Everything an artifact was made from, directly or not: ``(node, ancestor,
    steps)`` with keys ``name:v2`` and the fewest steps between them.

    Each round joins the paths found so far with themselves, so the rounds grow with
    the logarithm of the longest chain. Records in a circle are ancestors of each
    other, and of themselves, and end the search like any others. Inputs that are not
    registered are ancestors without inputs of their own.
    """
    key = F.concat_ws(":v", "name", F.col("version").cast("string"))
    edges = artifacts.select(key.alias("node"), F.explode("inputs").alias("ancestor")).distinct()
    found, seen = materialize(edges.withColumn("steps", F.lit(1)), "ancestors-1"), None
    turn = 1
    while (now := tuple(found.agg(F.count("*"), F.sum("steps")).first())) != seen:
        seen, turn = now, turn + 1
        onward = found.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("further"), F.col("steps").alias("more"))
        longer = found.join(onward, "ancestor").select("node", F.col("further").alias("ancestor"), (F.col("steps") + F.col("more")).alias("steps"))
        both = found.union(longer).groupBy("node", "ancestor").agg(F.min("steps").alias("steps"))
        found = materialize(both, f"ancestors-{turn}")
    return found


class Registry:
    """Tables below one folder. The drivers of several jobs may append to them: a
    version belongs to the writer that claims it first."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)

    def _append(self, rows: DataFrame, name: str) -> None:
        """Each entry in a folder of its own: writers that share one would remove each
        other's unfinished files."""
        rows.coalesce(1).write.parquet(f"{self.folder}/{name}/{uuid.uuid4().hex}")

    def artifacts(self) -> DataFrame:
        return self._read("artifacts", ARTIFACT)

    def register(
        self,
        name: str,
        kind: str,
        path: str,
        job: str,
        *,
        description: str = "",
        metadata: Mapping[str, object] | None = None,
        aliases: Sequence[str] = ("latest",),
        tags: Sequence[str] = (),
        inputs: Sequence[str] = (),
        required: Sequence[str] = (),
    ) -> str:
        """Append one record and give back ``name:vN``. Refused when one of the
        ``required`` outputs is not there. A version that another writer has claimed,
        also one that ended before its record was written, is left to it."""
        absent = [p for p in (required or [path]) if not path_exists(self.spark, p)]
        if absent:
            raise FileNotFoundError(f"Missing outputs of {name}: {absent}")
        last = self.artifacts().where(F.col("name") == name).agg(F.max("version")).first()[0]
        version = (last or 0) + 1
        while not claim(self.spark, f"{self.folder}/claims/{quote(name, safe='')}/v{version}"):
            version += 1
        row = (
            name,
            kind,
            version,
            job,
            path,
            description,
            {k: str(v) for k, v in (metadata or {}).items()},
            list(aliases),
            list(tags),
            [self._pinned(reference) for reference in inputs],
            datetime.now(timezone.utc),
        )
        self._append(self.spark.createDataFrame([row], ARTIFACT), "artifacts")
        return f"{name}:v{version}"

    def find(self, reference: str) -> dict:
        """The record of ``name:alias`` or ``name:vN``."""
        name, _, alias = reference.partition(":")
        found = resolve(self.artifacts().where(F.col("name") == name), alias or "latest").first()
        if found is None:
            raise FileNotFoundError(f"No artifact {reference} in the registry.")
        return found.asDict(recursive=True)

    def _pinned(self, reference: str) -> str:
        """``name:alias`` as the ``name:vN`` it means now; kept when unknown."""
        try:
            found = self.find(reference)
        except FileNotFoundError:
            return reference
        return f"{found['name']}:v{found['version']}"

    def log_metrics(self, metrics: DataFrame, job: str) -> None:
        """Append long metrics (model, split, metric, value) under their keys."""
        rows = metrics.select(
            metric_key(F.col("model"), F.col("split"), F.col("metric")).alias("key"),
            "model",
            "split",
            "metric",
            "value",
            F.lit(job).alias("job"),
            F.current_timestamp().alias("logged_at"),
        )
        self._append(rows, "metrics")

    def metrics(self) -> DataFrame:
        return self._read("metrics", METRIC)

    def runs(self) -> DataFrame:
        return self._read("runs", RUN)

    @contextmanager
    def step(self, name: str):
        """Time a job step and append one row to the run log, also when it fails.
        The body may set ``rows`` on the yielded dict."""
        note: dict[str, int | None] = {"rows": None}
        started, clock = datetime.now(timezone.utc), time.perf_counter()
        status, message = "finished", None
        try:
            yield note
        except Exception as error:
            status, message = "failed", f"{type(error).__name__}: {error}"
            raise
        finally:
            row = (name, started, time.perf_counter() - clock, status, note["rows"], message)
            self._append(self.spark.createDataFrame([row], RUN), "runs")


def content_hash(spark: SparkSession, folder: str, digits: int = 8) -> str:
    """First digits of a SHA-256 over the sorted SHA-256 values of all files below
    a model folder. Files are hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    hashes = files.select(F.sha2("content", 256).alias("h"))
    joined = F.concat_ws("", F.sort_array(F.collect_list("h")))
    return hashes.agg(F.substring(F.sha2(joined, 256), 1, digits)).first()[0]


def version_text(spark: SparkSession, folder: str, source: str) -> str:
    name = folder.rstrip("/").rsplit("/", 1)[-1]
    return f"{name}@sha256:{content_hash(spark, folder)}@{source}"
