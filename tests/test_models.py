import time

import duckdb
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from gableframe.config import Settings
from gableframe.models import candidates
from gableframe.models.candidates import (
    check_features,
    fit_stages,
    predict_all,
    prepare,
    train_candidates,
    used_columns,
    whole_model,
)
from gableframe.models import tuning
from gableframe.plans import catalog
from gableframe.models.tuning import best_trial, booster_parameters, check_tunable, search_space, tune

CFG = Settings().with_(
    train={"forest_trees": 5, "forest_depth": 4, "boost_rounds": 5, "boost_rate": 0.3, "max_bins": 32},
    tune={"n_trials": 3, "rounds": (2, 4), "depth": (2, 3)},
)


def panel(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 10, 100] + [5, 0, 50]
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.1 * x[:, 2] + rng.normal(size=n) + np.where(x[:, 0] > 5, 20, 0)
    rows = [
        (i, "train" if i % 4 else "eval", *map(float, r), None, float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))
    ]
    return spark.createDataFrame(
        rows, "row_id int, split string, a double, b double, c double, empty double, price double"
    ), x, y


@pytest.fixture(scope="module")
def data(spark):
    return panel(spark)


@pytest.fixture(scope="module")
def prepared(data):
    done = prepare(data[0], CFG)
    yield done
    done.release()


def predictions(prepared, name, df):
    model = whole_model(prepared, fit_stages(name, prepared, CFG.train))
    return np.array([r.prediction for r in model.transform(df).orderBy("row_id").select("prediction").collect()])


def test_columns_without_values_are_left_out(prepared):
    assert prepared.columns == ("a", "b", "c", "empty")
    model = whole_model(prepared, fit_stages("linear_regression", prepared, CFG.train))
    assert used_columns(model) == ["a", "b", "c"]
    check_features(model, prepared.columns)
    with pytest.raises(ValueError, match="mismatch"):
        check_features(model, ["a", "b"])


@pytest.mark.parametrize("name, alpha", [("linear_regression", 0.0), ("ridge", 1.0)])
def test_linear_models_equal_the_normal_equations(prepared, data, name, alpha):
    df, x, y = data
    train = np.arange(len(y)) % 4 != 0
    mean, dev = x[train].mean(0), x[train].std(0)
    z = (x - mean) / dev
    w = np.linalg.solve(z[train].T @ z[train] + alpha * np.eye(3), z[train].T @ (y[train] - y[train].mean()))
    assert predictions(prepared, name, df) == pytest.approx(y[train].mean() + z @ w, abs=1e-6)


def test_ridge_differs_from_ols_with_a_strong_penalty(spark, data):
    strong = CFG.with_(train={"ridge_alpha": 500.0})
    done = prepare(data[0], strong)
    df, x, y = data
    train = np.arange(len(y)) % 4 != 0
    z = (x - x[train].mean(0)) / x[train].std(0)
    w = np.linalg.solve(z[train].T @ z[train] + 500 * np.eye(3), z[train].T @ (y[train] - y[train].mean()))
    model = whole_model(done, fit_stages("ridge", done, strong.train))
    got = [r.prediction for r in model.transform(df).orderBy("row_id").select("prediction").collect()]
    done.release()
    assert got == pytest.approx(y[train].mean() + z @ w, abs=1e-6)


def test_dummy_predicts_the_train_mean(prepared, data):
    df, _, y = data
    assert predictions(prepared, "dummy", df) == pytest.approx(np.full(len(y), y[np.arange(len(y)) % 4 != 0].mean()))


def test_missing_features_are_imputed_and_missing_targets_left_out(spark, data):
    df, x, y = data
    holes = df.withColumn("b", F.when(F.col("row_id") % 5 == 1, float("nan")).otherwise(F.col("b")))
    holes = holes.withColumn("price", F.when(F.col("row_id") != 2, F.col("price")))
    done = prepare(holes, CFG, ["b"])
    ids = np.arange(len(y))
    train = (ids % 4 != 0) & (ids != 2)
    b = np.where(ids % 5 == 1, np.nan, x[:, 1])
    b = np.where(np.isnan(b), np.nanmean(b[train]), b)
    slope, intercept = np.polyfit(b[train], y[train], 1)
    assert done.stats.n == train.sum()
    assert predictions(done, "linear_regression", holes) == pytest.approx(intercept + slope * b, abs=1e-6)
    done.release()


def test_all_candidates_beat_the_dummy(prepared, tmp_path, data):
    models, metrics = train_candidates(prepared, CFG)
    table = {(r.model, r.split, r.metric): r.value for r in metrics.collect()}
    assert len(table) == 5 * 3 * 3
    for name in ("linear_regression", "ridge", "random_forest", "gbt"):
        assert table[name, "eval", "rmse"] < table["dummy", "eval", "rmse"]
        gap = table[name, "eval", "rmse"] - table[name, "train", "rmse"]
        assert table[name, "gap", "rmse"] == pytest.approx(gap)
    assert abs(table["dummy", "train", "r2"]) < 1e-9
    for name, model in models.items():
        model.write().overwrite().save(str(tmp_path / name))
        again = PipelineModel.load(str(tmp_path / name))
        first = model.transform(data[0]).agg(F.sum("prediction")).first()[0]
        assert again.transform(data[0]).agg(F.sum("prediction")).first()[0] == pytest.approx(first)


def test_fits_at_a_time_share_one_scaler(data, monkeypatch):
    fits, fit = [], candidates.StandardScaler.fit

    def slow(self, df):
        fits.append(df)
        time.sleep(1)
        return fit(self, df)

    monkeypatch.setattr(candidates.StandardScaler, "fit", slow)
    with prepare(data[0], CFG) as done:
        train_candidates(done, CFG, ["linear_regression", "ridge"])
    assert len(fits) == 1


def test_the_dearest_fit_begins_first(prepared, monkeypatch):
    begun, fit = [], candidates.fit_stages
    monkeypatch.setattr(candidates, "fit_stages", lambda name, *rest: begun.append(name) or fit(name, *rest))
    models, _ = train_candidates(prepared, CFG.with_(train={"parallel_fits": 1}), ["ridge", "dummy", "gbt"])
    assert begun == ["gbt", "ridge", "dummy"] and list(models) == ["ridge", "dummy", "gbt"]


def test_all_candidates_are_fitted_at_full_size(spark, data, monkeypatch):
    """The query once fitted 5 trees of depth 6 and 8 rounds."""
    asked = []

    def asked_for(prepared, cfg, names):
        asked.extend(candidates.build_estimator(name, cfg.train, prepared.stats) for name in names)
        return {}, spark.createDataFrame([("dummy", "eval", "rmse", 1.0)], "model string, split string, metric string, value double")

    monkeypatch.setattr(catalog, "_features", lambda *_: (data[0], None))
    monkeypatch.setattr(catalog.learners, "train_candidates", asked_for)
    assert catalog.all_candidates(spark, "").count() == 1
    forest, boost = asked[3:]
    assert len(asked) == 5
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMaxBins()) == (200, 30, 256)
    assert (boost.getMaxIter(), boost.getMaxDepth(), boost.getMaxBins(), boost.getStepSize()) == (500, 6, 256, 0.05)


def test_a_forest_of_parts_is_one_model(prepared, data, tmp_path, monkeypatch):
    train, learner = prepared.train(), candidates.build_estimator("random_forest", CFG.train, prepared.stats)
    alone = learner.fit(train)
    same = candidates.fit_forest(learner, train)
    told = [[t.toDebugString.split("\n", 1)[1] for t in model.trees] for model in (same, alone)]
    assert told[0] == told[1]
    monkeypatch.setattr(candidates, "FOREST_PART", 2)
    made = candidates.fit_forest(learner, train)
    told = [t.toDebugString.split("\n", 1)[1] for t in made.trees]
    assert len(told) == len(set(told)) == made.getNumTrees == 5 and made.numFeatures == alone.numFeatures
    assert made.getMaxDepth() == CFG.train.forest_depth and sum(made.featureImportances) == pytest.approx(1)
    rows = [r[0] for r in train.select("features").limit(20).collect()]
    got = [made.predict(r) for r in rows]
    assert got == pytest.approx([np.mean([t.predict(r) for t in made.trees]) for r in rows])
    whole_model(prepared, [made]).write().overwrite().save(str(tmp_path / "forest"))
    again = PipelineModel.load(str(tmp_path / "forest"))
    check_features(again, prepared.columns[:3])
    assert again.stages[-1].getNumTrees == 5 and [again.stages[-1].predict(r) for r in rows] == got
    found = [r.prediction for r in again.transform(data[0]).orderBy("row_id").select("prediction").collect()]
    assert found == [r.prediction for r in whole_model(prepared, [made]).transform(data[0]).orderBy("row_id").select("prediction").collect()]


def test_predictions_scale_once(prepared):
    fitted = {name: fit_stages(name, prepared, CFG.train) for name in ("linear_regression", "ridge")}
    found = predict_all(prepared, fitted)
    assert found.columns == ["split", "label", "p_linear_regression", "p_ridge"]
    assert found._jdf.queryExecution().analyzed().toString().count("AS scaled_features") == 1


def test_unknown_model_and_no_target(prepared, data):
    with pytest.raises(ValueError, match="Unsupported"):
        train_candidates(prepared, CFG, ["svm"])
    with pytest.raises(ValueError, match="price"):
        prepare(data[0].drop("price"), CFG)


def test_holdout_never_enters_a_fit(spark, data):
    extra = data[0].limit(50).withColumn("split", F.lit("holdout")).withColumn("price", F.lit(1e9))
    done = prepare(data[0].unionByName(extra), CFG, ["a"])
    assert done.frame.where("split = 'holdout'").count() == 0 and done.stats.mean < 1e3
    done.release()


def test_sampled_training_has_the_exact_size(data):
    done = prepare(data[0], CFG.with_(train={"sample_fraction": 0.5}), ["a"])
    sizes = {r["split"]: r["count"] for r in done.frame.groupBy("split").count().collect()}
    assert sizes == {"train": 150, "eval": 50}
    done.release()


def test_search_space_equals_sql(spark):
    cfg = CFG.with_(tune={"n_trials": 40, "rounds": (200, 800), "depth": (3, 10)}).tune
    got = search_space(spark, cfg).orderBy("trial_number").collect()
    u = "CAST('0x' || substr(md5('42|' || i || '|{}'), 1, 13) AS BIGINT) / pow(16, 13)"
    sql = (
        f"SELECT CAST(200 + floor({u.format('n_estimators')} * 601) AS INT), "
        f"CAST(3 + floor({u.format('max_depth')} * 8) AS INT), "
        f"exp(ln(0.01) + {u.format('learning_rate')} * (ln(0.3) - ln(0.01))), "
        f"0.5 + {u.format('subsample')} * 0.5, CAST(1 + floor({u.format('min_child_weight')} * 10) AS INT) "
        "FROM range(40) t(i) ORDER BY i"
    )
    want = duckdb.sql(sql).fetchall()
    names = ("n_estimators", "max_depth", "learning_rate", "subsample", "min_child_weight")
    for row, expected in zip(got, want, strict=True):
        assert [row[n] for n in names] == pytest.approx(list(expected))
        assert 200 <= row.n_estimators <= 800 and 3 <= row.max_depth <= 10
        assert 0.01 <= row.learning_rate <= 0.3 and 1e-8 <= row.reg_alpha <= 10 and 0 <= row.gamma <= 5
    assert len({r.learning_rate for r in got}) == 40


def test_tuning_picks_the_lowest_error_and_repeats(spark, prepared):
    result = tune(prepared, CFG, spark)
    trials = result.trials.orderBy("trial_number").collect()
    assert [t.trial_number for t in trials] == [0, 1, 2]
    best = min(trials, key=lambda t: (t.rmse, t.trial_number))
    assert result.best_params["n_estimators"] == best.n_estimators
    rmse = result.metrics.where("split = 'eval' AND metric = 'rmse'").first().value
    assert rmse == pytest.approx(best.rmse)
    assert set(booster_parameters(result.best_params)) >= {"maxIter", "minInstancesPerNode"}


def test_a_killed_search_goes_on(spark, prepared, tmp_path, monkeypatch):
    """Three trials are finished when the driver is lost; they are not fitted again."""
    cfg = CFG.with_(tune={"n_trials": 5, "rounds": (2, 3), "depth": (2, 3), "parallel_trials": 1})
    want = tuning.tune(prepared, cfg, spark)
    fit, fitted = tuning._fit, []

    def lost(*args):
        if len(fitted) == 3:
            raise KeyboardInterrupt
        fitted.append(args[2]["trial_number"])
        return fit(*args)

    ledger = str(tmp_path / "ledger")
    monkeypatch.setattr(tuning, "_fit", lost)
    with pytest.raises(KeyboardInterrupt):
        tuning.tune(prepared, cfg, spark, ledger)
    later = []
    monkeypatch.setattr(tuning, "_fit", lambda *args: later.append(args[2].get("trial_number")) or fit(*args))
    got = tuning.tune(prepared, cfg, spark, ledger)
    assert fitted == [0, 1, 2] and later == [3, 4, None]  # the last fit is that of the best parameters
    columns = sorted(want.trials.columns)
    assert [tuple(r) for r in got.trials.select(columns).orderBy("trial_number").collect()] == [tuple(r) for r in want.trials.select(columns).orderBy("trial_number").collect()]
    assert got.best_params == want.best_params
    other = tuning.Ledger(spark, ledger, prepared, cfg.with_(train={"seed": 7}))
    assert other.known(tuning.search_space(spark, cfg.tune).first().asDict()) is None


def test_best_trial_and_guard(spark):
    trials = spark.createDataFrame([(0, 3.0), (2, 1.0), (1, 1.0), (3, None)], "trial_number int, rmse double")
    assert best_trial(trials).first().trial_number == 1
    check_tunable("gbt", CFG.tune)
    for name in ("ridge", None):
        with pytest.raises(ValueError):
            check_tunable(name, CFG.tune)
