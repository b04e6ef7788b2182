"""Scoring of request streams with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Settings
from ..models.scoring import Artifacts, score_records
from ..operators.requests import parse_requests


def score_stream(
    requests: DataFrame,
    artifacts: Artifacts,
    lookup: DataFrame | None,
    cfg: Settings,
    sink: str,
    checkpoint: str,
    carry: Sequence[str] = ("request_id",),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start scoring a stream of typed requests into a Parquet folder.

    The same plan as batch scoring: stateless, stream-static joins against the
    fitted tables, so no watermark. The checkpoint makes the file sink exactly
    once across restarts. The default trigger drains what is there and stops.
    """
    scored = score_records(requests, artifacts, lookup, cfg, carry)
    writer = scored.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", sink).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


class CurrentArtifacts:
    """Artifacts that follow a reference, such as the newest registered model: they
    are loaded again when the reference has changed, and not otherwise."""

    def __init__(self, reference: Callable[[], str], load: Callable[[str], Artifacts]):
        self._reference, self._load = reference, load
        self._known: str | None = None
        self._artifacts: Artifacts | None = None

    def __call__(self) -> Artifacts:
        now = self._reference()
        if self._artifacts is None or now != self._known:
            self._artifacts, self._known = self._load(now), now
        return self._artifacts


def read_request_stream(spark: SparkSession, folder: str, files_each: int | None = None, key: str = "request_id", text: str = "body") -> DataFrame:
    """A folder that JSON files ``{key, text}`` are put into, as a stream of raw requests."""
    reader = spark.readStream.schema(f"{key} string, {text} string")
    if files_each:
        reader = reader.option("maxFilesPerTrigger", files_each)
    return reader.json(folder)


def score_request_stream(
    bodies: DataFrame,
    artifacts: Callable[[], Artifacts],
    lookup: DataFrame | None,
    cfg: Settings,
    sink: str,
    checkpoint: str,
    key: str = "request_id",
    text: str = "body",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start checking and scoring a stream of raw JSON requests into two folders,
    ``scored`` and ``refused`` (with the text and all reasons).

    Every micro-batch is parsed once and asks ``artifacts`` for the model, so a new
    version serves from the next batch on. Each batch owns one folder of either sink,
    named by its number, and replaces it: a batch that is run again after a failure
    leaves its rows once. What one batch holds is bounded by the stream's options.
    """

    def one_batch(rows: DataFrame, number: int) -> None:
        serving = artifacts()
        checked = parse_requests(rows, text).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            accepted = checked.where("request IS NOT NULL").select(key, "request.*")
            refused = checked.where("request IS NULL").select(key, text, "reject_reasons")
            scored = score_records(accepted, serving, lookup, cfg, [key])
            for name, out in (("scored", scored), ("refused", refused)):
                out.write.mode("overwrite").parquet(f"{sink}/{name}/batch={number}")
        finally:
            checked.unpersist()

    writer = bodies.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_sink(spark: SparkSession, sink: str, name: str) -> DataFrame:
    """All batches of one of the two folders."""
    return spark.read.parquet(f"{sink}/{name}").drop("batch")
