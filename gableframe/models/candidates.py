"""Five candidate regressors as Spark ML pipelines on one prepared frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings, TrainSettings
from ..operators.metrics import evaluate_candidates, with_gap
from ..operators.sampling import sample_exact
from ..schema import feature_columns, require_columns
from ..sources.workspace import workspace

FEATURES, SCALED, LABEL = "features", "scaled_features", "label"
# From the cheapest fit to the dearest.
NAMES = ("dummy", "linear_regression", "ridge", "random_forest", "gbt")
# Trees of a forest that are fitted together, and how many such parts are fitted at once.
FOREST_PART, PARALLEL_PARTS = 25, 4


@dataclass(frozen=True)
class LabelStats:
    n: int
    mean: float
    deviation: float


def _literal(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def fit_preparation(
    train: DataFrame, columns: Sequence[str], label: str = LABEL
) -> tuple[PipelineModel, LabelStats]:
    """Mean imputation fitted on train, then one feature vector; and what the
    learners need to know of the label. One pass over train.

    Columns without any value on train have no mean and are left out.
    """
    number = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in columns}
    row = train.agg(
        F.count(label).alias("n"),
        F.avg(label).alias("mean"),
        F.stddev_pop(label).alias("deviation"),
        *[F.avg(value).alias(f"mean {c}") for c, value in number.items()],
    ).first()
    if not row["n"]:
        raise ValueError("Train has no row with a target.")
    means = {c: row[f"mean {c}"] for c in columns if row[f"mean {c}"] is not None}
    if not means:
        raise ValueError("No feature column has a value on train.")
    filled = ", ".join(
        f"COALESCE(NANVL(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), {_literal(mean)}) AS `{c}__filled`"
        for c, mean in means.items()
    )
    imputer = SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")
    assembler = VectorAssembler(inputCols=[f"{c}__filled" for c in means], outputCol=FEATURES)
    return PipelineModel(stages=[imputer, assembler]), LabelStats(row["n"], row["mean"], row["deviation"])


def build_estimator(name: str, cfg: TrainSettings, stats: LabelStats):
    """One unfitted stage by name; an unknown name is an error.

    ``ridge`` has the penalty ``alpha * |w|^2`` on population-scaled inputs. The
    scaler divides by the sample deviation and the learner divides the squared
    error by 2n and scales the label, hence the factor.
    """
    common = {"featuresCol": FEATURES, "labelCol": LABEL}
    scaled = {"featuresCol": SCALED, "labelCol": LABEL, "solver": "normal"}
    if name == "dummy":
        return SQLTransformer(
            statement=f"SELECT *, {_literal(stats.mean)} AS prediction FROM __THIS__"
        )
    if name == "linear_regression":
        return LinearRegression(**scaled, regParam=0.0)
    if name == "ridge":
        factor = (stats.n - 1) / stats.n**2 * stats.deviation
        return LinearRegression(
            **scaled, regParam=cfg.ridge_alpha * factor, elasticNetParam=0.0, standardization=False
        )
    if name == "random_forest":
        return RandomForestRegressor(
            **common,
            numTrees=cfg.forest_trees,
            maxDepth=cfg.forest_depth,
            maxBins=cfg.max_bins,
            featureSubsetStrategy="all",
            seed=cfg.seed,
            checkpointInterval=cfg.checkpoint_interval,
        )
    if name == "gbt":
        return boosted(
            cfg,
            maxIter=cfg.boost_rounds,
            stepSize=cfg.boost_rate,
            maxDepth=cfg.boost_depth,
            subsamplingRate=cfg.boost_row_share,
            featureSubsetStrategy=str(cfg.boost_column_share),
        )
    raise ValueError(f"Unsupported model name: {name}")


def boosted(cfg: TrainSettings, **params) -> GBTRegressor:
    return GBTRegressor(
        featuresCol=FEATURES,
        labelCol=LABEL,
        lossType="squared",
        maxBins=cfg.max_bins,
        seed=cfg.seed,
        checkpointInterval=cfg.checkpoint_interval,
        **params,
    )


@dataclass(frozen=True)
class Prepared:
    """Train and eval rows with a label, assembled once and kept for all fits."""

    frame: DataFrame
    preparation: PipelineModel
    columns: tuple[str, ...]
    stats: LabelStats

    @cached_property
    def scaler(self) -> Transformer:
        """Fitted when a linear model first asks for it; trees need none. Threads that
        ask at once would each fit one: ask before they start."""
        return StandardScaler(inputCol=FEATURES, outputCol=SCALED, withMean=True).fit(self.train())

    def train(self) -> DataFrame:
        return self.frame.where("split = 'train'")

    def release(self) -> None:
        self.frame.unpersist()

    def __enter__(self) -> Prepared:
        return self

    def __exit__(self, *error) -> None:
        self.release()


def prepare(features: DataFrame, cfg: Settings, columns: Sequence[str] | None = None) -> Prepared:
    """Assemble the train and eval rows of a feature table.

    The holdout is not read. Rows without a target are left out of fits and
    metrics. Optional sampling is exact and per split.
    """
    split, target = cfg.split.split_column, cfg.features.target_column
    order = [c for c in cfg.clean.row_order if c in features.columns]
    if columns is None:
        columns = feature_columns(features, target, {split, *order})
    label = F.col(target).cast("double")
    rows = features.where(F.col(split).isin("train", "eval"))
    if cfg.train.sample_fraction is not None:
        require_columns(rows, cfg.clean.row_order, "Sampled data")
        parts = [
            sample_exact(
                rows.where(F.col(split) == name), cfg.train.sample_fraction, cfg.train.seed, order
            )
            for name in ("train", "eval")
        ]
        rows = reduce(DataFrame.unionByName, parts)
    rows = rows.where(label.isNotNull() & ~F.isnan(label)).select(
        F.col(split).alias("split"), label.alias(LABEL), *[F.col(f"`{c}`") for c in columns]
    )
    workspace(features.sparkSession)  # a checkpoint folder for the boosting lineage
    preparation, stats = fit_preparation(rows.where("split = 'train'"), columns)
    frame = preparation.transform(rows).select("split", LABEL, FEATURES)
    frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
    return Prepared(frame, preparation, tuple(columns), stats)


def fit_forest(forest: RandomForestRegressor, train: DataFrame) -> RandomForestRegressionModel:
    """A large forest, grown as several small ones at a time and then put together.

    Deep trees have many nodes of few rows, which are split by few tasks, one group
    of nodes after the other: one fit leaves most cores idle. Each part draws its rows
    by a seed of its own; the learner adds partition numbers to seeds, so they lie far
    apart. A forest of one part is that of the learner.
    """
    trees, seed = forest.getNumTrees(), forest.getSeed()
    parts = [
        forest.copy({forest.numTrees: min(FOREST_PART, trees - first), forest.seed: seed + first * 1_000_003})
        for first in range(0, trees, FOREST_PART)
    ]
    if len(parts) == 1:
        return forest.fit(train)
    with ThreadPoolExecutor(PARALLEL_PARTS) as pool:
        models = list(pool.map(lambda part: part.fit(train), parts))
    # Python has no way to make a model of trees; the class of the JVM has.
    context = train.sparkSession.sparkContext
    kinds = context._jvm.org.apache.spark.ml.regression
    grown = [tree for model in models for tree in model._java_obj.trees()]
    held = context._gateway.new_array(kinds.DecisionTreeRegressionModel, len(grown))
    for i, tree in enumerate(grown):
        held[i] = tree
    whole = kinds.RandomForestRegressionModel(forest.uid, held, models[0].numFeatures)
    made = forest._copyValues(RandomForestRegressionModel(whole))
    made._transfer_params_to_java()
    return made


def fit_stages(name: str, prepared: Prepared, cfg: TrainSettings) -> list[Transformer]:
    """Fitted stages that follow the preparation."""
    stage = build_estimator(name, cfg, prepared.stats)
    if name == "dummy":
        return [stage]
    if name in ("linear_regression", "ridge"):
        return [prepared.scaler, stage.fit(prepared.scaler.transform(prepared.train()))]
    if name == "random_forest":
        return [fit_forest(stage, prepared.train())]
    return [stage.fit(prepared.train())]


def whole_model(prepared: Prepared, stages: Sequence[Transformer]) -> PipelineModel:
    return PipelineModel(stages=[*prepared.preparation.stages, *stages])


def predict_all(prepared: Prepared, fitted: Mapping[str, Sequence[Transformer]]) -> DataFrame:
    """Split, label and one prediction column per model, in one pass. The linear
    models have one scaler, so its vector is computed once for all of them."""
    out = prepared.frame
    for name, stages in fitted.items():
        for stage in stages:
            if not (isinstance(stage, StandardScalerModel) and SCALED in out.columns):
                out = stage.transform(out)
        out = out.withColumnRenamed("prediction", f"p_{name}")
    return out.select("split", LABEL, *[f"p_{name}" for name in fitted])


def train_candidates(
    prepared: Prepared, cfg: Settings, names: Sequence[str] | None = None
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit every candidate on the same rows; (models, long metrics with gap).

    A few fits run at once: the many short stages of one leave room for others. The
    dearest begin first, so that boosting does not run alone at the end. The linear
    models' scaler comes before them: it is fitted once, and its pass puts the frame
    into memory by all cores, where the trees would begin with one row of it.
    """
    names = tuple(names or cfg.train.candidates)
    unknown = [n for n in names if n not in NAMES]
    if unknown:
        raise ValueError(f"Unsupported model name: {unknown}")
    if {"linear_regression", "ridge"} & set(names):
        _ = prepared.scaler
    with ThreadPoolExecutor(cfg.train.parallel_fits) as pool:
        dearest = sorted(set(names), key=NAMES.index, reverse=True)
        fits = {name: pool.submit(fit_stages, name, prepared, cfg.train) for name in dearest}
        fitted = {name: fits[name].result() for name in names}
    metrics = candidate_metrics(prepared, fitted)
    return {name: whole_model(prepared, stages) for name, stages in fitted.items()}, metrics


def candidate_metrics(prepared: Prepared, fitted: Mapping[str, Sequence[Transformer]]) -> DataFrame:
    predictions = predict_all(prepared, fitted)
    return with_gap(evaluate_candidates(predictions, LABEL, {n: f"p_{n}" for n in fitted}))


def feature_count(model: PipelineModel) -> int | None:
    """Width of the vector the last stage was fitted on, if it knows."""
    last = model.stages[-1]
    return getattr(last, "numFeatures", None)


def used_columns(model: PipelineModel) -> list[str]:
    """Raw feature columns a saved model reads."""
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            return [c.removesuffix("__filled") for c in stage.getInputCols()]
    return []


def check_features(model: PipelineModel, columns: Sequence[str]) -> None:
    """Raise when a model and a stored feature schema do not fit together."""
    used, width = used_columns(model), feature_count(model)
    absent = sorted(set(used) - set(columns))
    if absent or (width is not None and width != len(used)):
        raise ValueError(
            f"Feature mismatch: model reads {len(used)} columns (vector width {width}), "
            f"schema has {len(columns)}, absent {absent}. Train again."
        )
