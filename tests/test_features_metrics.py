import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gableframe.config import BroadcastBound, Settings
from gableframe.operators.encode import (
    Encoders,
    apply_encoders,
    apply_frequency,
    apply_target,
    fit_encoders,
    fit_frequency,
    fit_target,
    load_encoders,
    save_encoders,
)
from gableframe.operators.features import add_date_features, align_features, drop_unused, engineer_features
from gableframe.operators.metrics import best_model, evaluate, evaluate_candidates, scored_error, scored_rows, with_gap
from gableframe.operators.sampling import first_rows, sample_exact
from gableframe.operators.scale import column_means, impute_means, standardize
from gableframe.schema import feature_columns

CFG = Settings()
COLUMNS = (
    "split string, date string, city_full string, city string, zipcode bigint, "
    "median_sale_price double, median_list_price double, price double"
)
TRAIN = [
    ("train", "2020-01-01", "atlanta", "ATL", 30301, 100000.0, 120000.0, 200000.0),
    ("train", "2020-02-01", "atlanta", "ATL", 30301, 110000.0, 130000.0, 220000.0),
    ("train", "2020-03-01", "miami", "MIA", 33101, 120000.0, 140000.0, 300000.0),
]


def moved(split, zips, cities):
    return [
        (split, *row[1:2], city, row[3], zip_, *row[5:])
        for row, zip_, city in zip(TRAIN, zips, cities, strict=True)
    ]


@pytest.fixture()
def panel(spark):
    rows = TRAIN + moved("eval", (30301, 99999, 33101), ("atlanta", "unknown", "miami"))
    rows += moved("holdout", (99999, 30301, 33101), ("unknown", "atlanta", "miami"))
    return spark.createDataFrame(rows, COLUMNS)


def smoothed(n, mean, prior):
    w = 1 / (1 + math.exp(-(n - 20) / 10))
    return prior * (1 - w) + mean * w


def test_date_features_follow_the_date(spark):
    df = spark.createDataFrame([(1999, "2020-05-02", 9.0)], "year int, date string, price double")
    out = add_date_features(df)
    assert out.columns == ["date", "year", "quarter", "month", "price"]
    assert tuple(out.first())[1:4] == (2020, 2, 5)
    with pytest.raises(ValueError):
        add_date_features(df.drop("date"))


def test_frequency_counts_null_and_unknown(spark, rows):
    train = spark.createDataFrame([(1,), (1,), (2,), (None,)], "zipcode bigint")
    table = fit_frequency(train, "zipcode")
    assert rows(table) == [(1, 2), (2, 1), (None, 1)]
    other = spark.createDataFrame([(1,), (3,), (None,)], "zipcode bigint")
    assert rows(apply_frequency(other, "zipcode", table, CFG.broadcast)) == [(1, 2), (3, 0), (None, 1)]
    assert apply_frequency(spark.range(1), "zipcode", table, CFG.broadcast).columns == ["id"]
    with pytest.raises(ValueError):
        fit_frequency(spark.range(1), "zipcode")


@pytest.mark.parametrize("bound", [BroadcastBound(), BroadcastBound(max_rows=0)])
def test_missing_floating_keys_are_one_value(spark, rows, bound):
    train = spark.createDataFrame([(None,), (float("nan"),), (0.0,), (-0.0,)], "zipcode double")
    table = fit_frequency(train, "zipcode")
    assert rows(table) == [(0.0, 2), (None, 2)]
    assert [r.zipcode_freq for r in apply_frequency(train, "zipcode", table, bound).collect()] == [2, 2, 2, 2]


@pytest.mark.parametrize("bound", [BroadcastBound(), BroadcastBound(max_rows=0)])
def test_target_encoding_values(spark, bound):
    labels = [("a", 10.0)] * 30 + [("b", 40.0)] * 2 + [(None, 100.0)] + [("c", None), ("c", float("nan"))]
    train = spark.createDataFrame(labels, "city_full string, price double")
    fitted = fit_target(train, "city_full", "price", CFG.features)
    prior = (300 + 80 + 100) / 33
    assert fitted.prior == pytest.approx(prior)
    other = spark.createDataFrame([("a",), ("b",), (None,), ("c",), ("new",)], "city_full string")
    got = {r[0]: r[1] for r in apply_target(other, "city_full", fitted, bound).collect()}
    assert got["a"] == pytest.approx(smoothed(30, 10, prior))
    assert got["b"] == pytest.approx(smoothed(2, 40, prior))
    assert got[None] == pytest.approx(smoothed(1, 100, prior))
    assert got["c"] == got["new"] == pytest.approx(prior)


def test_features_of_all_splits(panel):
    features, encoders = engineer_features(panel, CFG)
    assert features.columns == [
        "split", "year", "quarter", "month", "median_list_price", "price", "zipcode_freq", "city_full_encoded",
    ]
    for split, freq in (("train", [2, 2, 1]), ("eval", [2, 0, 1]), ("holdout", [0, 2, 1])):
        part = features.where(F.col("split") == split).orderBy("month")
        assert [r["zipcode_freq"] for r in part.collect()] == freq
    assert encoders.target.prior == pytest.approx(240000)
    eval_codes = {r["month"]: r["city_full_encoded"] for r in features.where("split = 'eval'").collect()}
    assert eval_codes[2] == pytest.approx(240000)
    assert eval_codes[1] == pytest.approx(smoothed(2, 210000, 240000))


def test_eval_rows_never_change_the_encoders(panel, rows):
    changed = panel.withColumn("price", F.when(F.col("split") == "train", F.col("price")).otherwise(F.lit(1.0)))
    first, second = engineer_features(panel, CFG)[1], engineer_features(changed, CFG)[1]
    assert rows(first.frequency) == rows(second.frequency)
    assert rows(first.target.table) == rows(second.target.table)


def test_encoders_without_their_columns_are_skipped(panel):
    features, encoders = engineer_features(panel.drop("zipcode", "city_full"), CFG)
    assert encoders == Encoders(None, None)
    assert "zipcode_freq" not in features.columns


def test_encoders_saved_and_loaded(spark, panel, rows, tmp_path):
    train = panel.where("split = 'train'")
    encoders = fit_encoders(train, CFG.features)
    save_encoders(encoders, str(tmp_path / "all"))
    loaded = load_encoders(spark, str(tmp_path / "all"))
    expected = apply_encoders(train, encoders, CFG.features, CFG.broadcast)
    assert rows(apply_encoders(train, loaded, CFG.features, CFG.broadcast)) == rows(expected)
    save_encoders(Encoders(encoders.frequency, None), str(tmp_path / "one"))
    assert load_encoders(spark, str(tmp_path / "one")).target is None
    assert load_encoders(spark, str(tmp_path / "none")) == Encoders(None, None)


def test_drops_ignore_absent(spark):
    df = spark.createDataFrame([(1, 2)], "zipcode int, price int")
    assert drop_unused(df, CFG.features.drop_columns).columns == ["price"]


def test_alignment_and_record_policy(spark):
    df = spark.createDataFrame([(2.0, 3.0, None)], "b double, c double, d double")
    out = align_features(df, ["a", "b", "d"])
    assert out.columns == ["a", "b", "d"] and tuple(out.first()) == (0, 2.0, None)
    assert tuple(align_features(df, ["a", "d"], fill_nulls=["d"]).first()) == (0, 0.0)


def test_feature_columns_must_be_numeric(spark):
    df = spark.createDataFrame([(1, True, "x", 1.0)], "a int, b boolean, c string, price double")
    with pytest.raises(ValueError, match=r"\['b', 'c'\]"):
        feature_columns(df, "price")
    with pytest.raises(ValueError, match="price"):
        feature_columns(df.drop("price"), "price")
    assert feature_columns(df.drop("b", "c"), "price") == ["a"]


def test_imputation_and_scaling(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, None), (None, 5.0, None), (3.0, 5.0, None), (float("nan"), 5.0, None)],
        "a double, b double, c double",
    )
    means = column_means(df, ["a", "b", "c"])
    assert means == {"a": 2.0, "b": 5.0, "c": None}
    filled = impute_means(df, means)
    assert filled.columns == ["a", "b"] and [r.a for r in filled.collect()] == [1.0, 2.0, 3.0, 2.0]
    scaled = standardize(filled, filled, ["a", "b"])
    a = np.array([1.0, 2.0, 3.0, 2.0])
    assert [r.a for r in scaled.collect()] == pytest.approx((a - 2) / a.std())
    assert {r.b for r in scaled.collect()} == {0.0}


def pairs(spark, values):
    return spark.createDataFrame(values, "y double, p double")


def test_metric_values(spark):
    y, p = np.array([1.0, 2.0, 4.0]), np.array([2.0, 4.0, 8.0])
    row = evaluate(pairs(spark, [*zip(y.tolist(), p.tolist()), (None, 1.0), (1.0, None), (float("nan"), 2.0)]), "y", "p").first()
    assert row.mae == pytest.approx(np.abs(y - p).mean())
    assert row.rmse == pytest.approx(math.sqrt(((y - p) ** 2).mean()))
    assert row.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()) and row.r2 < 0


def test_r2_of_constant_and_single_targets(spark):
    assert evaluate(pairs(spark, [(3.0, 3.0), (3.0, 3.0)]), "y", "p").first().r2 == 1.0
    assert evaluate(pairs(spark, [(3.0, 3.0), (3.0, 4.0)]), "y", "p").first().r2 == 0.0
    assert math.isnan(evaluate(pairs(spark, [(3.0, 3.0)]), "y", "p").first().r2)


def test_gap(spark):
    long = spark.createDataFrame(
        [
            ("m", "train", "mae", 10.0), ("m", "train", "rmse", 20.0), ("m", "train", "r2", 0.95),
            ("m", "eval", "mae", 15.0), ("m", "eval", "rmse", 35.0), ("m", "eval", "r2", 0.90),
            ("m", "train", "only_train", 1.0),
        ],
        "model string, split string, metric string, value double",
    )
    gap = {r.metric: r.value for r in with_gap(long).where("split = 'gap'").collect()}
    assert gap == pytest.approx({"mae": 5, "rmse": 15, "r2": -0.05})
    assert with_gap(long).where("metric = 'only_train'").count() == 1


def test_many_models_in_one_pass_equal_single_evaluation(spark):
    df = spark.createDataFrame(
        [("train", 1.0, 1.5, 2.0), ("train", 2.0, 2.5, 2.0), ("eval", 5.0, 4.0, 2.0), ("eval", 6.0, 7.0, 2.0)],
        "split string, y double, p double, q double",
    )
    long = {(r.model, r.split, r.metric): r.value for r in evaluate_candidates(df, "y", {"p": "p", "q": "q"}).collect()}
    for model in "pq":
        for row in evaluate(df, "y", model, ["split"]).collect():
            for metric in ("mae", "rmse", "r2"):
                assert long[model, row.split, metric] == pytest.approx(row[metric])


def metrics_table(spark, values):
    rows = [(m, "eval", "rmse", v) for m, v in values]
    return spark.createDataFrame(rows, "model string, split string, metric string, value double")


def test_best_model(spark):
    table = metrics_table(spark, [("dummy", 10.0), ("ridge", 5.0), ("forest", 5.0)])
    assert best_model(table, ["dummy", "ridge", "forest"]).first().model == "ridge"
    assert best_model(table, ["dummy", "forest", "ridge"]).first().model == "forest"
    assert best_model(table, ["dummy", "ridge"], direction="max").first().model == "dummy"
    with pytest.raises(ValueError):
        best_model(table, [])
    with pytest.raises(Exception, match="Missing metric 'rmse' for models: gbt"):
        best_model(table, ["dummy", "gbt"]).collect()


def test_scored_rows(spark, rows):
    df = pairs(spark, [(900.0, 1000.0), (1100.0, 1001.0), (None, 1.0), (1.0, None)])
    assert rows(scored_rows(df, "y", "p"), "absolute_error") == [(100.0,), (99.0,)]
    row = scored_error(df, "y", "p").first()
    assert (row.n_rows, row.mae) == (2, 99.5) and row.rmse == pytest.approx(math.sqrt((100**2 + 99**2) / 2))


@pytest.mark.parametrize("n, fraction, size", [(10, 0.25, 2), (10, 0.35, 4), (1000, 0.5, 500), (5000, 0.999, 4995), (3, 0.1, 0)])
def test_sample_is_exact_and_seeded(spark, rows, n, fraction, size):
    df = spark.range(n)
    drawn = sample_exact(df, fraction, 42, ["id"])
    assert drawn.columns == ["id"]
    got = rows(drawn)
    assert len(got) == len(set(got)) == size
    assert got == rows(sample_exact(df.repartition(7), fraction, 42, ["id"]))
    if n == 1000:
        assert got != rows(sample_exact(df, fraction, 43, ["id"]))


@pytest.mark.parametrize("fraction", [None, 0, 1, -1, 2.0])
def test_sample_without_a_fraction_is_whole(spark, fraction):
    assert sample_exact(spark.range(7), fraction, 42, ["id"]).count() == 7


def test_preview(spark):
    assert [r.id for r in first_rows(spark.range(50), 3, [F.desc("id")]).collect()] == [49, 48, 47]
    with pytest.raises(ValueError):
        first_rows(spark.range(5), 1001, ["id"])
