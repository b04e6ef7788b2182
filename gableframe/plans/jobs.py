"""Jobs: split, clean, features, train, tune, score, and the whole pipeline.

A job reads Parquet that an earlier job wrote, stays lazy inside, and writes once.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import SPLITS, Settings
from ..functions import labels
from ..models.candidates import check_features, prepare, train_candidates
from ..models.scoring import Artifacts, score_table, scoring_metrics
from ..models.tuning import check_tunable, tune
from ..operators.clean import clean, unmatched_cities
from ..operators.encode import Encoders, load_encoders, save_encoders
from ..operators.features import engineer_features
from ..operators.metrics import best_model
from ..operators.splits import split_by_date, split_profile
from ..sources.registry import Registry, preferred, version_text
from ..sources.tables import (
    read_feature_names,
    read_lookup,
    read_splits,
    read_table,
    write_csv,
    write_splits,
)
from ..sources.workspace import path_exists
from ..streaming.score import CurrentArtifacts, read_request_stream, score_request_stream


@dataclass(frozen=True)
class Layout:
    """Folders of one project."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name in ("splits", "cleaned", "features", "encoders", "predictions", "registry", "models", "audit", "unmatched"):
            return f"{self.root.rstrip('/')}/{name}"
        raise AttributeError(name)

    @property
    def best(self) -> str:
        return f"{self.models}/best_model"

    @property
    def tuned(self) -> str:
        return f"{self.models}/tuned_model"

    def model(self, name: str) -> str:
        return f"{self.models}/candidates/{name}"


@dataclass
class Project:
    spark: SparkSession
    layout: Layout
    cfg: Settings = field(default_factory=Settings)
    register: bool = True
    source: str = "local"

    @property
    def registry(self) -> Registry:
        return Registry(self.spark, self.layout.registry)

    def stage_path(self, artifact: str, folder: str) -> str:
        """Where to read a stage: its registered ``latest``, or the folder."""
        if not self.register:
            return folder
        return self.registry.find(f"{artifact}:latest")["path"]


def write_json(spark: SparkSession, payload: dict, path: str) -> None:
    """A small document (metrics, parameters) as one line of JSON."""
    row = spark.createDataFrame([(json.dumps(payload),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Not found: {path}")
    return json.loads(spark.read.text(path).first()[0])


def nested_metrics(metrics: DataFrame) -> dict:
    """Long metrics (a few rows per model) as model -> split -> metric -> value."""
    out: dict = {}
    for r in metrics.collect():
        out.setdefault(r["model"], {}).setdefault(r["split"], {})[r["metric"]] = r["value"]
    return out


def long_metrics(spark: SparkSession, nested: dict) -> DataFrame:
    rows = [
        (model, split, metric, value)
        for model, splits in nested.items()
        for split, values in splits.items()
        for metric, value in values.items()
    ]
    return spark.createDataFrame(rows, "model string, split string, metric string, value double")


def run_split(project: Project, raw_path: str) -> DataFrame:
    """Load, tag by date, write one folder per split."""
    cfg, path = project.cfg, project.layout.splits
    raw = read_table(project.spark, raw_path)
    with project.registry.step("split") as note:
        write_splits(split_by_date(raw, cfg.split), path, cfg.split.split_column, SPLITS)
        written = read_splits(project.spark, path)
        profile = split_profile(written.drop("row_id"), cfg.split)
        note["rows"] = profile.agg(F.sum("n_rows")).first()[0]
    if project.register:
        source = project.registry.register(
            cfg.registry.raw,
            "dataset",
            raw_path,
            "register_raw_data",
            description="Table as it was delivered.",
            metadata={"source_path": raw_path},
        )
        project.registry.register(
            cfg.registry.splits,
            "dataset",
            path,
            "split_data",
            description="Rows dealt by date into one folder per period.",
            metadata={
                "eval_start_date": cfg.split.eval_start,
                "holdout_start_date": cfg.split.holdout_start,
                "date_column": cfg.split.date_column,
            },
            inputs=[source],
            required=[f"{path}/split={s}" for s in SPLITS],
        )
    return profile


class RowCount:
    """Counts the rows of each split as they pass to the writer: no pass of its own."""

    def __init__(self, split_column: str, splits: Sequence[str]):
        self._split, self._names = split_column, tuple(splits)
        self._seen = Observation()

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *[F.count_if(F.col(self._split) == s).alias(s) for s in self._names])

    def by_split(self) -> dict[str, int]:
        """After the frame was written."""
        return {s: self._seen.get[s] for s in self._names}


def run_clean(project: Project, metros_path: str | None, splits: Sequence[str] = SPLITS) -> DataFrame:
    """Clean the named splits in one plan; the split bounds duplicate removal.

    Every run leaves an audit of removed rows and a list of the cities without a
    place. The rows before are counted from the file footers; those after either step
    are counted behind the one shuffle, on their way to the writer. The list reads two
    columns of what was written.
    """
    cfg, path, layout = project.cfg, project.layout.cleaned, project.layout
    split = cfg.split.split_column
    with project.registry.step("clean") as note:
        tagged = read_splits(project.spark, layout.splits, splits)
        before = {r[0]: r[1] for r in tagged.groupBy(split).count().collect()}  # one row a split
        lookup = read_lookup(project.spark, metros_path, cfg.clean)
        distinct, kept = RowCount(split, splits), RowCount(split, splits)
        cleaned = clean(tagged, lookup, cfg.clean, cfg.broadcast, group=[split], watch=distinct)
        write_splits(kept(cleaned), path, split, splits)
        after, left = distinct.by_split(), kept.by_split()
        steps = [
            row
            for s in splits
            for row in (
                (s, "duplicates", before.get(s, 0), after[s], before.get(s, 0) - after[s]),
                (s, "price_outliers", after[s], left[s], after[s] - left[s]),
            )
        ]
        schema = f"{split} string, step string, rows_before bigint, rows_after bigint, rows_removed bigint"
        project.spark.createDataFrame(steps, schema).coalesce(1).write.mode("overwrite").parquet(layout.audit)
        written = read_splits(project.spark, path, splits)
        if {cfg.clean.city_column, cfg.clean.latitude_column} <= set(written.columns):
            unmatched_cities(written, cfg.clean).write.mode("overwrite").parquet(layout.unmatched)
        note["rows"] = sum(left.values())
    if project.register:
        project.registry.register(
            cfg.registry.cleaned,
            "dataset",
            path,
            "preprocess_data",
            description="Rows with places, without duplicates and price outliers.",
            metadata={
                "splits": ",".join(splits),
                "city_column": cfg.clean.city_column,
                "outlier_column": cfg.clean.outlier_column,
                "outlier_limit": cfg.clean.outlier_limit,
            },
            inputs=[f"{cfg.registry.splits}:latest"],
            required=[f"{path}/split={s}" for s in SPLITS],
        )
    return written


def run_features(project: Project) -> tuple[DataFrame, Encoders]:
    """Fit the encoders on train, write features of all splits and the encoders."""
    cfg, layout = project.cfg, project.layout
    with project.registry.step("features") as note:
        cleaned = read_splits(project.spark, project.stage_path(cfg.registry.cleaned, layout.cleaned))
        features, encoders = engineer_features(cleaned, cfg)
        passed = RowCount(cfg.split.split_column, SPLITS)
        write_splits(passed(features), layout.features, cfg.split.split_column, SPLITS)
        save_encoders(encoders, layout.encoders)
        written = read_splits(project.spark, layout.features)
        note["rows"] = sum(passed.by_split().values())
    if project.register:
        source = f"{cfg.registry.cleaned}:latest"
        project.registry.register(
            cfg.registry.features,
            "dataset",
            layout.features,
            "feature_engineering",
            description="Numeric model inputs of every period.",
            metadata={
                "target_column": cfg.features.target_column,
                "frequency_encode_column": cfg.features.frequency_column,
                "target_encode_column": cfg.features.target_encode_column,
                "drop_columns": ",".join(cfg.features.drop_columns),
            },
            inputs=[source],
            required=[f"{layout.features}/split={s}" for s in SPLITS],
        )
        if encoders.frequency is not None or encoders.target is not None:
            project.registry.register(
                cfg.registry.encoders,
                "model",
                layout.encoders,
                "feature_engineering",
                description="Frequency and target means of the train keys.",
                inputs=[source],
            )
    return written, load_encoders(project.spark, layout.encoders)


def run_training(
    project: Project, candidates: Sequence[str] | None = None, save_candidates: bool = False
) -> tuple[str, DataFrame]:
    """Fit and compare the candidates, save the best; (its name, long metrics)."""
    cfg, layout, spark = project.cfg, project.layout, project.spark
    names = tuple(candidates or cfg.train.candidates)
    with project.registry.step("training"):
        stage = project.stage_path(cfg.registry.features, layout.features)
        with prepare(read_splits(spark, stage, ("train", "eval")), cfg) as prepared:
            models, measured = train_candidates(prepared, cfg, names)
            nested = nested_metrics(measured)
        metrics = long_metrics(spark, nested)
        best = best_model(metrics, names, cfg.train.primary_metric).first()
        if save_candidates:
            for name, model in models.items():
                model.write().overwrite().save(layout.model(name))
        models[best["model"]].write().overwrite().save(layout.best)
        payload = {
            "best_model": best["model"],
            "primary_metric": cfg.train.primary_metric,
            "metrics": nested,
        }
        write_json(spark, payload, f"{layout.models}/metrics")
    if project.register:
        _register_best(project, payload, best["value"], names)
    return best["model"], metrics


def _register_best(project: Project, payload: dict, value: float, names: Sequence[str]) -> None:
    cfg, layout = project.cfg, project.layout
    name, metric = payload["best_model"], payload["primary_metric"]
    label = project.spark.range(1).select(
        labels.best_description(F.lit(name), F.lit(metric), F.lit(value)).alias("description"),
        labels.best_tags(F.lit(name), F.lit(metric)).alias("tags"),
        labels.best_aliases(F.lit(name), F.lit(metric)).alias("aliases"),
    ).first()
    project.registry.log_metrics(long_metrics(project.spark, payload["metrics"]), "train_model")
    project.registry.register(
        cfg.registry.best_model,
        "model",
        layout.best,
        "train_model",
        description=label["description"],
        metadata={
            "best_model": name,
            "primary_metric": metric,
            "primary_metric_value": value,
            "train_metrics": json.dumps(payload["metrics"][name]["train"]),
            "eval_metrics": json.dumps(payload["metrics"][name]["eval"]),
            "generalization_gap": json.dumps(payload["metrics"][name]["gap"]),
            "candidate_models": ",".join(names),
            "metrics_by_model": json.dumps(payload["metrics"]),
            "target_column": cfg.features.target_column,
            "random_state": cfg.train.seed,
            "sample_frac": cfg.train.sample_fraction,
        },
        aliases=label["aliases"],
        tags=label["tags"],
        inputs=[f"{cfg.registry.features}:latest"],
        required=[layout.best, f"{layout.models}/metrics"],
    )


def run_tuning(project: Project) -> tuple[dict, DataFrame]:
    """Tune the baseline winner when it is the boosted model; (parameters, metrics)."""
    cfg, layout, spark = project.cfg, project.layout, project.spark
    check_tunable(read_json(spark, f"{layout.models}/metrics").get("best_model"), cfg.tune)
    with project.registry.step("tuning"):
        stage = project.stage_path(cfg.registry.features, layout.features)
        sampled = cfg.with_(
            train={"sample_fraction": cfg.tune.sample_fraction, "seed": cfg.tune.seed}
        )
        with prepare(read_splits(spark, stage, ("train", "eval")), sampled) as prepared:
            result = tune(prepared, sampled, spark, f"{layout.models}/trial_ledger")
            nested = nested_metrics(result.metrics)
        result.model.write().overwrite().save(layout.tuned)
        n_trials = result.trials.count()
        payload = {
            "base_model": cfg.tune.supported_model,
            "primary_metric": cfg.train.primary_metric,
            "best_params": result.best_params,
            "metrics": nested["tuned"],
            "n_trials": n_trials,
        }
        write_json(spark, payload, f"{layout.models}/tuning_metrics")
        write_csv(result.trials.orderBy("trial_number").coalesce(1), f"{layout.models}/trials.csv")
    metrics = long_metrics(spark, nested)
    if project.register:
        _register_tuned(project, payload, metrics)
    return result.best_params, metrics


def _register_tuned(project: Project, payload: dict, metrics: DataFrame) -> None:
    cfg, layout = project.cfg, project.layout
    metric = payload["primary_metric"]
    value = payload["metrics"]["eval"][metric]
    label = project.spark.range(1).select(
        labels.tuned_description(F.lit(payload["base_model"]), F.lit(metric), F.lit(value)).alias("description"),
        labels.tuned_tags(F.lit(metric)).alias("tags"),
        labels.tuned_aliases(F.lit(metric)).alias("aliases"),
    ).first()
    project.registry.log_metrics(metrics, "tune_model")
    project.registry.register(
        cfg.registry.tuned_model,
        "model",
        layout.tuned,
        "tune_model",
        description=label["description"],
        metadata={
            "base_model": payload["base_model"],
            "primary_metric": metric,
            "primary_metric_value": value,
            "best_params": json.dumps(payload["best_params"]),
            "train_metrics": json.dumps(payload["metrics"]["train"]),
            "eval_metrics": json.dumps(payload["metrics"]["eval"]),
            "generalization_gap": json.dumps(payload["metrics"]["gap"]),
            "n_trials": payload["n_trials"],
        },
        aliases=label["aliases"],
        tags=label["tags"],
        inputs=[f"{cfg.registry.features}:latest", f"{cfg.registry.best_model}:latest"],
        required=[layout.tuned, f"{layout.models}/tuning_metrics", f"{layout.models}/trials.csv"],
    )


def choose_model_path(spark: SparkSession, layout: Layout) -> str:
    """The tuned model when there is one, else the best baseline."""
    for path in (layout.tuned, layout.best):
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"No model in {layout.models}")


def load_artifacts(project: Project, model_path: str | None = None) -> Artifacts:
    """Model, encoders and feature schema, checked against each other."""
    spark, layout, cfg = project.spark, project.layout, project.cfg
    path = model_path or choose_model_path(spark, layout)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Model not found: {path}")
    model = PipelineModel.load(path)
    skip = (cfg.split.split_column, *cfg.clean.row_order)
    columns = read_feature_names(spark, layout.features, cfg.features.target_column, skip)
    check_features(model, columns)
    encoders = load_encoders(spark, layout.encoders)
    version = version_text(spark, path, project.source)
    return Artifacts(model, encoders, tuple(columns), version, project.source)


def model_info(spark: SparkSession, artifacts: Artifacts | None) -> DataFrame:
    """One row about the loaded artifacts; ``unhealthy`` without any."""
    schema = (
        "status string, version string, source string, n_features int, train_columns array<string>, "
        "frequency_encoder boolean, target_encoder boolean"
    )
    if artifacts is None:
        row = ("unhealthy", None, None, None, None, False, False)
    else:
        row = (
            "healthy",
            artifacts.version,
            artifacts.source,
            len(artifacts.train_columns),
            list(artifacts.train_columns),
            artifacts.encoders.frequency is not None,
            artifacts.encoders.target is not None,
        )
    return spark.createDataFrame([row], schema).withColumn("loaded_at", F.current_timestamp())


def run_scoring(
    project: Project,
    input_path: str | None = None,
    metros_path: str | None = None,
    model_path: str | None = None,
    output: str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Score a raw-compatible file, the raw holdout by default; write predictions, as
    Parquet and as CSV, and, when there are actual values, their metrics."""
    spark, cfg, layout = project.spark, project.cfg, project.layout
    path = output or layout.predictions
    with project.registry.step("scoring") as note:
        if input_path is None:
            table = read_splits(spark, layout.splits, ["holdout"]).drop(cfg.split.split_column)
        else:
            table = read_table(spark, input_path)
        artifacts = load_artifacts(project, model_path)
        lookup = read_lookup(spark, metros_path, cfg.clean)
        scored, passed = score_table(table, artifacts, lookup, cfg), Observation()
        scored.observe(passed, F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/rows")
        written = spark.read.parquet(f"{path}/rows")
        write_csv(flat_rows(written), f"{path}/predictions.csv")
        metrics = scoring_metrics(written, cfg.score)
        if metrics is not None:
            metrics.write.mode("overwrite").json(f"{path}/metrics")
            metrics = spark.read.schema("mae double, rmse double, r2 double").json(f"{path}/metrics")
        note["rows"] = passed.get["n"]
    return written, metrics


def flat_rows(df: DataFrame) -> DataFrame:
    """For files of text: a row id that is a place in a file becomes three columns."""
    ids = [c for c in df.schema.fields if isinstance(c.dataType, T.StructType)]
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if f not in ids], *[F.col(f"`{f.name}`.`{g.name}`").alias(f"{f.name}_{g.name}") for f in ids for g in f.dataType.fields])


def serving_reference(project: Project) -> str:
    """What tells whether another model serves now: the newest record of the tuned
    model, else of the best one; without a registry the path and hash of its files."""
    names = (project.cfg.registry.tuned_model, project.cfg.registry.best_model)
    if project.register:
        found = preferred(project.registry.artifacts(), names).first()
        if found is None:
            raise FileNotFoundError(f"No model of {names} in the registry.")
        return f"{found['name']}:v{found['version']}"
    return version_text(project.spark, choose_model_path(project.spark, project.layout), project.source)


def run_stream(
    project: Project,
    folder: str,
    metros_path: str | None = None,
    output: str | None = None,
    checkpoint: str | None = None,
    files_each: int = 100,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start checking and scoring the JSON requests that arrive in a folder. The newest
    registered model serves each micro-batch; a new one is taken up between two."""
    spark, path = project.spark, output or f"{project.layout.predictions}/stream"
    current = CurrentArtifacts(lambda: serving_reference(project), lambda _: load_artifacts(project))
    lookup = read_lookup(spark, metros_path, project.cfg.clean)
    bodies = read_request_stream(spark, folder, files_each)
    return score_request_stream(bodies, current, lookup, project.cfg, path, checkpoint or f"{path}/checkpoint", trigger=trigger)


def run_pipeline(
    project: Project,
    raw_path: str | None = None,
    metros_path: str | None = None,
    *,
    data: bool = True,
    features: bool = True,
    training: bool = True,
    tuning: bool = True,
    scoring: bool = False,
    scoring_input: str | None = None,
    scoring_output: str | None = None,
    scoring_model: str | None = None,
) -> list[str]:
    """The stages in fixed order, each unless skipped; gives the stages that ran."""
    ran = []
    if data:
        if raw_path is None:
            raise ValueError("The data stage needs a raw table.")
        run_split(project, raw_path)
        run_clean(project, metros_path)
        ran.append("data")
    if features:
        run_features(project)
        ran.append("features")
    if training:
        run_training(project)
        ran.append("training")
    if tuning:
        run_tuning(project)
        ran.append("tuning")
    if scoring:
        run_scoring(project, scoring_input, metros_path, scoring_model, scoring_output)
        ran.append("scoring")
    return ran
