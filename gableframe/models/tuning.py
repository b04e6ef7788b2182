"""Seeded random search for the boosted model on the fixed eval split."""

from __future__ import annotations

import hashlib
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings, TuneSettings
from ..functions.numbers import seeded_key, uniform_from
from ..sources.workspace import path_exists
from .candidates import Prepared, boosted, candidate_metrics, whole_model

# Parameter name, lowest, highest, scale. Rounds and depth come
# from the settings.
SEARCH_RANGES = (
    ("learning_rate", 0.01, 0.3, "log"),
    ("subsample", 0.5, 1.0, "linear"),
    ("colsample", 0.5, 1.0, "linear"),
    ("min_child_weight", 1, 10, "int"),
    ("gamma", 0.0, 5.0, "linear"),
    ("reg_alpha", 1e-8, 10.0, "log"),
    ("reg_lambda", 1e-8, 10.0, "log"),
)


def _drawn(u: Column, low: float, high: float, scale: str) -> Column:
    if scale == "int":
        return (F.lit(low) + F.floor(u * (high - low + 1))).cast("int")
    if scale == "log":
        return F.exp(F.log(F.lit(low)) + u * (F.log(F.lit(high)) - F.log(F.lit(low))))
    return F.lit(low) + u * (high - low)


def search_space(spark: SparkSession, cfg: TuneSettings) -> DataFrame:
    """One row of parameters per trial; every value depends only on the seed, the
    trial number and the parameter name, so trials can be repeated."""
    ranges = (
        ("n_estimators", *cfg.rounds, "int"),
        ("max_depth", *cfg.depth, "int"),
        *SEARCH_RANGES,
    )
    trials = spark.range(cfg.n_trials).select(F.col("id").cast("int").alias("trial_number"))
    return trials.select(
        "trial_number",
        *[
            _drawn(uniform_from(seeded_key(cfg.seed, F.col("trial_number"), F.lit(name))), low, high, scale).alias(name)
            for name, low, high, scale in ranges
        ],
    )


def check_tunable(best_model: str | None, cfg: TuneSettings) -> None:
    if not best_model:
        raise ValueError("The training metrics name no best model.")
    if best_model != cfg.supported_model:
        raise ValueError(f"Tuning supports only '{cfg.supported_model}', got '{best_model}'.")


def booster_parameters(params: dict) -> dict:
    """Search parameters in the terms of the Spark learner. The two weight
    penalties have no counterpart there and are recorded only."""
    return {
        "maxIter": params["n_estimators"],
        "maxDepth": params["max_depth"],
        "stepSize": params["learning_rate"],
        "subsamplingRate": params["subsample"],
        "featureSubsetStrategy": str(params["colsample"]),
        "minInstancesPerNode": params["min_child_weight"],
        "minInfoGain": params["gamma"],
    }


@dataclass(frozen=True)
class TuningResult:
    model: PipelineModel
    best_params: dict
    trials: DataFrame
    metrics: DataFrame


class Ledger:
    """Finished trials in a shared folder, each under a digest of its parameters, the
    learner's settings and the training data, so that a search that was killed goes on
    where it stood. Another table, seed or setting has other digests and starts anew."""

    def __init__(self, spark: SparkSession, folder: str, prepared: Prepared, cfg: Settings):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.about = {"train": asdict(cfg.train), "columns": prepared.columns, "label": asdict(prepared.stats)}

    def path(self, params: dict) -> str:
        told = json.dumps({**self.about, "params": params}, sort_keys=True)
        return f"{self.folder}/{hashlib.sha256(told.encode()).hexdigest()[:32]}"

    def known(self, params: dict) -> dict | None:
        path = self.path(params)
        if not path_exists(self.spark, f"{path}/_SUCCESS"):  # written whole or not at all
            return None
        return json.loads(self.spark.read.text(path).first()[0])

    def enter(self, params: dict, record: dict) -> None:
        row = self.spark.createDataFrame([(json.dumps(record),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(self.path(params))


def tune(prepared: Prepared, cfg: Settings, spark: SparkSession, ledger: str | None = None) -> TuningResult:
    """Fit every trial on train, score it on eval, refit the best.

    A few trials run at once on the one prepared frame; each is a distributed
    fit, and only its parameters and nine metric values reach the driver. With a
    ``ledger`` folder, finished trials are kept there and not fitted again.
    """
    space = [r.asDict() for r in search_space(spark, cfg.tune).orderBy("trial_number").collect()]
    book = Ledger(spark, ledger, prepared, cfg) if ledger else None

    def run(params: dict) -> dict:
        if book and (record := book.known(params)):
            return record
        model = _fit(prepared, cfg, params)
        values = candidate_metrics(prepared, {"tuned": [model]}).where("split = 'eval'").collect()
        record = {**params, **{r["metric"]: r["value"] for r in values}}
        if book:
            book.enter(params, record)
        return record

    with ThreadPoolExecutor(cfg.tune.parallel_trials) as pool:
        records = list(pool.map(run, space))
    trials = spark.createDataFrame(records)
    best = best_trial(trials, cfg.train.primary_metric).first().asDict()
    best_params = {k: best[k] for k in space[0] if k != "trial_number"}
    model = _fit(prepared, cfg, best_params)
    metrics = candidate_metrics(prepared, {"tuned": [model]})
    return TuningResult(whole_model(prepared, [model]), best_params, trials, metrics)


def _fit(prepared: Prepared, cfg: Settings, params: dict):
    return boosted(cfg.train, **booster_parameters(params)).fit(prepared.train())


def best_trial(trials: DataFrame, metric: str = "rmse", number: str = "trial_number") -> DataFrame:
    """The trial with the lowest objective; the earlier one wins a tie."""
    return trials.orderBy(F.col(metric).asc_nulls_last(), number).limit(1)
