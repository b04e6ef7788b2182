"""Registered queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import SPLITS
from ..functions import labels
from ..functions.dates import date_parts
from ..functions.numbers import lenient_double, nan_to_null
from ..functions.text import normalize_city, normalize_metro
from ..models import candidates as learners
from ..models.scoring import Artifacts, rows_predicted, score_records, score_table, scoring_metrics, with_actuals
from ..models.tuning import tune
from ..operators import clean as cleaning
from ..operators import encode, metrics, requests, sampling, scale
from ..operators.features import add_date_features, align_features, drop_unused, engineer_features
from ..operators.splits import rows_of_split, split_by_date, split_profile
from ..schema import REQUEST_FIELDS
from ..sources import registry, tables
from ..sources.standin import SETTINGS, listings, listings_from_orders, metros, table
from ..sources.workspace import materialize, scratch_path
from ..streaming.score import CurrentArtifacts, read_request_stream, read_sink, score_request_stream, score_stream
from .jobs import model_info

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# Small learner sizes of the queries of a single learner or search: one pass over the data
# per level and round.
SMALL = SETTINGS.with_(
    train={"forest_trees": 5, "forest_depth": 6, "boost_rounds": 8, "boost_rate": 0.3, "max_bins": 64},
    tune={"n_trials": 3, "rounds": (3, 6), "depth": (2, 4)},
)
# Features of the models whose predictions SQL can reproduce.
ONE_FEATURE = ("homes_sold",)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _tagged(spark, sf, rows=None):
    return split_by_date(listings(spark, sf) if rows is None else rows, SETTINGS.split)


def _written(spark, sf):
    """The listings, joined once and written: queries that fit on them and score them too
    read them several times."""
    return materialize(listings(spark, sf), "listings")


def _cleaned(spark, sf, rows=None):
    return cleaning.clean(
        _tagged(spark, sf, rows), metros(spark, sf), SETTINGS.clean, SETTINGS.broadcast, group=["split"]
    )


def _train(df):
    return df.where("split = 'train'")


def _kept(spark, sf, rows=None):
    """Cleaned rows, written once: several operators read them."""
    return materialize(_cleaned(spark, sf, rows), "cleaned")


def _rounded(df, *columns, digits=2):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- split -----------------------------------------------------------------


@query
def temporal_split(spark, sf):
    return _tagged(spark, sf)


@query
def eval_rows(spark, sf):
    """The orders of the eval period, by a range that reaches the files."""
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderdate", "date")
    return rows_of_split(orders, SETTINGS.split, "eval")


@query
def profile_of_splits(spark, sf):
    return split_profile(_tagged(spark, sf), SETTINGS.split)


# --- text and numbers ------------------------------------------------------


@query
def normalize_city_names(spark, sf):
    return listings(spark, sf).select("row_id", normalize_city(F.col("city_full")).alias("city_full"))


@query
def normalize_metro_names(spark, sf):
    return metros(spark, sf).select("row_id", normalize_metro(F.col("metro_full")).alias("metro_full"))


@query
def city_mapping(spark, sf):
    return cleaning.normalize_cities(listings(spark, sf), SETTINGS.clean).select("row_id", "city_full")


def _text_prices(spark, sf):
    rows = listings(spark, sf)
    text = F.col("median_list_price").cast("decimal(12,2)").cast("string")
    price = F.when(F.col("inventory").isNotNull(), F.coalesce(text, F.lit("not specified")))
    return rows.select("row_id", price.alias("median_list_price"))


@query
def lenient_numbers(spark, sf):
    rows = _text_prices(spark, sf)
    return rows.withColumn("value", lenient_double(rows, "median_list_price"))


@query
def null_when_nan(spark, sf):
    rows = listings(spark, sf).select("row_id", "median_list_price")
    price = F.col("median_list_price")
    found = nan_to_null(rows.withColumn("median_list_price", F.coalesce(price, F.lit(float("nan")))))
    return found.withColumns({"is_null": price.isNull(), "is_nan": F.coalesce(F.isnan(price), F.lit(False))})


@query
def parsed_dates(spark, sf):
    """Dates that arrive as text."""
    text = listings(spark, sf).select("row_id", F.date_format("date", "yyyy-MM-dd").alias("date"))
    tagged = split_by_date(text, SETTINGS.split)
    return tagged.select("row_id", F.to_date("date").alias("date"), "split", *[
        v.alias(k) for k, v in date_parts(F.col("date")).items()
    ])


# --- cleaning --------------------------------------------------------------


@query
def lookup_keep_first(spark, sf):
    return cleaning.lookup_keep_first(metros(spark, sf), SETTINGS.clean)


@query
def lookup_from_file(spark, sf):
    """The lookup as an ordered CSV file without row ids, read back."""
    path = scratch_path(spark, "metros") + ".csv"
    tables.write_csv(metros(spark, sf).orderBy("row_id").drop("row_id"), path)
    return cleaning.lookup_keep_first(tables.read_lookup(spark, path, SETTINGS.clean), SETTINGS.clean)


def _placed(spark, sf):
    return cleaning.merge_locations(
        listings(spark, sf), metros(spark, sf), SETTINGS.clean, SETTINGS.broadcast
    )


@query
def location_join(spark, sf):
    return _placed(spark, sf).select("row_id", "city_full", "lat", "lng")


@query
def unmatched_cities(spark, sf):
    return cleaning.unmatched_cities(_placed(spark, sf), SETTINGS.clean)


@query
def dedup_keep_first(spark, sf):
    return cleaning.drop_duplicates_keep_first(_tagged(spark, sf), SETTINGS.clean, group=["split"])


@query
def outlier_filter(spark, sf):
    return cleaning.drop_price_outliers(_text_prices(spark, sf), SETTINGS.clean)


@query
def cleaning_audit(spark, sf):
    return cleaning.cleaning_audit(_tagged(spark, sf), SETTINGS.clean)


@query
def clean_listings(spark, sf):
    return _cleaned(spark, sf)


# --- features --------------------------------------------------------------


@query
def date_features(spark, sf):
    return add_date_features(listings(spark, sf))


@query
def freq_fit(spark, sf):
    return encode.fit_frequency(_train(_cleaned(spark, sf)), "zipcode")


@query
def freq_apply(spark, sf):
    rows = _kept(spark, sf)
    fitted = materialize(encode.fit_frequency(_train(rows), "zipcode"), "frequency")
    applied = encode.apply_frequency(rows, "zipcode", fitted, SETTINGS.broadcast)
    return applied.select("row_id", "split", "zipcode", "zipcode_freq")


@query
def target_fit(spark, sf):
    fitted = encode.fit_target(_train(_cleaned(spark, sf)), "city_full", "price", SETTINGS.features)
    return _rounded(fitted.table, "mean", "city_full_encoded")


@query
def target_apply(spark, sf):
    rows = _kept(spark, sf)
    fitted = encode.fit_target(_train(rows), "city_full", "price", SETTINGS.features)
    applied = encode.apply_target(rows, "city_full", fitted, SETTINGS.broadcast)
    return _rounded(applied.select("row_id", "split", "city_full", "city_full_encoded"), "city_full_encoded")


@query
def drop_unused_columns(spark, sf):
    return drop_unused(listings(spark, sf), SETTINGS.features.drop_columns)


def _features(spark, sf, rows=None):
    return engineer_features(_kept(spark, sf, rows), SETTINGS)


@query
def feature_frame(spark, sf):
    return _rounded(_features(spark, sf)[0], "city_full_encoded")


@query
def schema_align(spark, sf):
    columns = ["inventory", "park", "median_list_price", "homes_sold"]
    return align_features(listings(spark, sf), columns, ["row_id"])


@query
def missing_policy_record(spark, sf):
    columns = ["inventory", "park", "median_list_price", "homes_sold"]
    return align_features(listings(spark, sf), columns, ["row_id"], fill_nulls=columns)


# --- requests --------------------------------------------------------------


def _requests(spark, sf, rows=None, *extra):
    """Listings as typed requests."""
    rows = listings(spark, sf) if rows is None else rows
    return rows.select(
        *extra,
        F.col("row_id").alias("request_id"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "city_full",
        "city",
        "zipcode",
        "median_sale_price",
        "median_list_price",
        "homes_sold",
        "inventory",
        "price",
    )


@query
def missing_fields(spark, sf):
    rows = _requests(spark, sf)
    names = requests.missing_fields(rows)
    return rows.select(
        "request_id",
        F.array_join(names, ",").alias("missing_features"),
        F.size(names).alias("missing_optional_count"),
    )


@query
def raw_names(spark, sf):
    rows = _requests(spark, sf).select("request_id", F.col("homes_sold").alias("total_population"))
    return requests.to_raw_names(rows)


def _json_requests(spark, sf, rows=None):
    """Listings and event properties as JSON text. Some listings carry a text for
    the price, a numeric text for the zip code, or no city; events are no requests
    at all."""
    rows = listings(spark, sf) if rows is None else rows
    price = F.when(
        F.col("median_list_price").isNull() & F.col("inventory").isNotNull(), F.lit('"not specified"')
    ).otherwise(F.coalesce(F.col("median_list_price").cast("decimal(12,2)").cast("string"), F.lit("null")))
    zipcode = F.col("zipcode").cast("string")
    quoted = F.concat(F.lit('"'), zipcode, F.lit('"'))
    text = F.concat(
        F.lit('{"date": "'),
        F.date_format("date", "yyyy-MM-dd"),
        F.lit('", "city_full": "'),
        F.trim("city_full"),
        F.when(F.col("city") == "MACHINERY", F.lit('"')).otherwise(F.concat(F.lit('", "city": "'), "city", F.lit('"'))),
        F.lit(', "zipcode": '),
        F.when(F.col("homes_sold") > 100, quoted).otherwise(zipcode),
        F.lit(', "median_list_price": '),
        price,
        F.lit("}"),
    )
    sent = rows.select(F.concat(F.lit("listing-"), F.col("row_id").cast("string")).alias("request_id"), text.alias("body"))
    events = table(spark, sf, "events").select(
        F.concat(F.lit("event-"), F.col("event_id").cast("string")).alias("request_id"),
        F.col("props").alias("body"),
    )
    return sent.unionByName(events)


@query
def request_contract(spark, sf):
    parsed = requests.parse_requests(_json_requests(spark, sf), "body")
    return parsed.select(
        "request_id",
        F.array_join("reject_reasons", ",").alias("reject_reasons"),
        F.col("request.zipcode").alias("zipcode"),
        F.col("request.median_list_price").alias("median_list_price"),
    )


def _batches(spark, sf, rows=None):
    """Batches of senders who send runs of 1500 orders, 1100 at once and then the
    rest: some are beyond the limit and some within it, however many orders there are."""
    order = F.expr("row_id div 2")
    part = F.when(F.pmod(order, F.lit(1500)) < 1100, "first").otherwise("rest")
    batch = F.concat_ws("-", F.expr("row_id div 3000").cast("string"), part)
    rows = listings(spark, sf) if rows is None else rows
    return rows.withColumn("batch_id", batch)


@query
def batch_limit(spark, sf):
    return requests.batch_sizes(_batches(spark, sf), "batch_id", SETTINGS.score)


@query
def preview_rows(spark, sf):
    return sampling.first_rows(listings(spark, sf), 20, ["date", "row_id"])


# --- learners --------------------------------------------------------------


@query
def mean_impute(spark, sf):
    rows = _kept(spark, sf).select("row_id", "split", "median_list_price", "homes_sold")
    columns = ["median_list_price", "homes_sold"]
    filled = scale.impute_means(rows, scale.column_means(_train(rows), columns))
    return _rounded(filled, *columns)


@query
def standard_scale(spark, sf):
    rows = _kept(spark, sf).select("row_id", "split", "median_list_price", "inventory")
    columns = ["median_list_price", "inventory"]
    return _rounded(scale.standardize(rows, _train(rows), columns), *columns, digits=6)


def _one_feature(spark, sf, name):
    rows = _kept(spark, sf)
    with learners.prepare(rows, SETTINGS, ONE_FEATURE) as prepared:
        model = learners.whole_model(prepared, learners.fit_stages(name, prepared, SETTINGS.train))
    scored = model.transform(rows).select("row_id", "split", F.col("prediction").alias("predicted_price"))
    return _rounded(scored, "predicted_price")


@query
def dummy_model(spark, sf):
    return _one_feature(spark, sf, "dummy")


@query
def ols_one_feature(spark, sf):
    return _one_feature(spark, sf, "linear_regression")


@query
def ridge_one_feature(spark, sf):
    return _one_feature(spark, sf, "ridge")


def _city_model(spark, sf):
    """Labelled rows with two predictions: the train mean and the city encoding."""
    rows = _kept(spark, sf)
    fitted = encode.fit_target(_train(rows), "city_full", "price", SETTINGS.features)
    encoded = encode.apply_target(rows, "city_full", fitted, SETTINGS.broadcast)
    return encoded.where(F.col("price").isNotNull()).select(
        "row_id", "split", "price", F.lit(fitted.prior).alias("p_dummy"), F.col("city_full_encoded").alias("p_city")
    )


def _city_metrics(spark, sf):
    return metrics.with_gap(
        metrics.evaluate_candidates(_city_model(spark, sf), "price", {"dummy": "p_dummy", "city": "p_city"})
    )


@query
def regression_metrics(spark, sf):
    found = metrics.evaluate(_city_model(spark, sf), "price", "p_city", ["split"])
    return _rounded(_rounded(found, "mae", "rmse"), "r2", digits=8)


@query
def metric_gap(spark, sf):
    return _rounded(_city_metrics(spark, sf), "value", digits=3)


@query
def best_model(spark, sf):
    return _rounded(metrics.best_model(_city_metrics(spark, sf), ["dummy", "city"]), "value")


@query
def exact_sample(spark, sf):
    train = materialize(_train(_tagged(spark, sf)).select("row_id", "date", "zipcode"), "train")
    return sampling.sample_exact(train, 0.3, SETTINGS.train.seed, ["row_id"])


def _prepared(spark, sf, cfg=SMALL):
    return learners.prepare(materialize(_features(spark, sf)[0], "features"), cfg)


def _learner(spark, sf, *names, cfg=SMALL):
    with _prepared(spark, sf, cfg) as prepared:
        found = materialize(learners.train_candidates(prepared, cfg, names)[1], "metrics")
    return _rounded(found, "value", digits=4)


def _wide_model(name, features):
    """A linear model on every column of the feature table."""
    with learners.prepare(features, SETTINGS) as prepared:
        return learners.whole_model(prepared, learners.fit_stages(name, prepared, SETTINGS.train))


def _wide_predictions(spark, sf, name):
    features = materialize(_features(spark, sf)[0], "features")
    scored = _wide_model(name, features).transform(features)
    return scored.select("row_id", "split", F.round("prediction").alias("predicted_price"))


@query
def ols_full(spark, sf):
    return _wide_predictions(spark, sf, "linear_regression")


@query
def ridge_full(spark, sf):
    return _wide_predictions(spark, sf, "ridge")


@query
def random_forest(spark, sf):
    return _learner(spark, sf, "random_forest")


@query
def gbt(spark, sf):
    return _learner(spark, sf, "gbt")


@query
def all_candidates(spark, sf):
    """Every candidate at the full size of the settings, as the training job fits it."""
    return _learner(spark, sf, *SETTINGS.train.candidates, cfg=SETTINGS)


@query
def tuned_trials(spark, sf):
    with _prepared(spark, sf) as prepared:
        return tune(prepared, SMALL, spark).trials


# --- scoring ---------------------------------------------------------------


def _artifacts(spark, sf, rows=None):
    """The linear model on all features, saved and loaded again, with its encoders;
    the version is that of the saved files."""
    features, encoders = _features(spark, sf, rows)
    features = materialize(features, "features")
    path = f"{scratch_path(spark, 'model')}/best_model"
    _wide_model("linear_regression", features).write().overwrite().save(path)
    skip = {"split", "row_id", SETTINGS.features.target_column}
    columns = tuple(c for c in features.columns if c not in skip)
    return Artifacts(PipelineModel.load(path), encoders, columns, version=registry.version_text(spark, path, "local"))


@query
def prediction_output(spark, sf):
    rows = _city_model(spark, sf).select("row_id", "price", F.col("p_city").alias("predicted_price"))
    out = with_actuals(rows, "price", SETTINGS.score)
    return _rounded(out, "predicted_price", "prediction_error")


def _with_unpriced(spark, sf):
    rows = _kept(spark, sf)
    fitted = encode.fit_target(_train(rows), "city_full", "price", SETTINGS.features)
    encoded = encode.apply_target(rows, "city_full", fitted, SETTINGS.broadcast)
    return encoded.select("row_id", "price", F.col("city_full_encoded").alias("predicted_price"))


@query
def scored_rows(spark, sf):
    out = metrics.scored_rows(_with_unpriced(spark, sf), "price", "predicted_price")
    return _rounded(out, "predicted_price", "absolute_error")


@query
def scored_error(spark, sf):
    return _rounded(metrics.scored_error(_with_unpriced(spark, sf), "price", "predicted_price"), "mae", "rmse")


def _file_scored(spark, sf):
    rows = _written(spark, sf)
    holdout = _tagged(spark, sf, rows).where("split = 'holdout'").drop("split")
    return score_table(holdout, _artifacts(spark, sf, rows), metros(spark, sf), SETTINGS)


@query
def file_scoring(spark, sf):
    scored = _rounded(_file_scored(spark, sf), "city_full_encoded")
    return _rounded(scored, "predicted_price", "prediction_error", digits=0)


@query
def file_scoring_metrics(spark, sf):
    found = scoring_metrics(_file_scored(spark, sf), SETTINGS.score)
    return _rounded(_rounded(found, "mae", "rmse"), "r2", digits=8)


def _shown(scored):
    """Without the model version: the files of a fit that is repeated differ in their time stamps."""
    shown = scored.withColumn("missing_features", F.array_join("missing_features", ",")).drop("model_version")
    return _rounded(shown, "predicted_price", digits=0)


@query
def request_scoring(spark, sf):
    rows = _written(spark, sf)
    return _shown(score_records(_requests(spark, sf, rows), _artifacts(spark, sf, rows), metros(spark, sf), SETTINGS))


@query
def batch_scoring(spark, sf):
    """Requests of accepted batches only; predictions per batch."""
    rows = _written(spark, sf)
    good = requests.accepted_batches(_batches(spark, sf, rows), "batch_id", SETTINGS.score, SETTINGS.broadcast)
    sent = _requests(spark, sf, good, "batch_id")
    scored = score_records(
        sent, _artifacts(spark, sf, rows), metros(spark, sf), SETTINGS, ["batch_id", "request_id"]
    )
    return rows_predicted(scored, "batch_id", SETTINGS.score)


@query
def stream_score(spark, sf):
    """The order table, one file or a folder of files, as a stream, scored into Parquet, read back."""
    orders = table(spark, sf, "orders")
    stream = (
        spark.readStream.schema(orders.schema).parquet(f"{sf}/orders.parquet*")
    )
    sent = _requests(spark, sf, listings_from_orders(spark, sf, stream))
    sink = scratch_path(spark, "stream")
    running = score_stream(
        sent, _artifacts(spark, sf), metros(spark, sf), SETTINGS, f"{sink}/rows", f"{sink}/checkpoint"
    )
    running.awaitTermination()
    return _shown(spark.read.parquet(f"{sink}/rows"))


def _nested(spark, sf, rows):
    """Batches as their senders write them, from runs of 1600 orders: 1100 at once,
    200 with nothing wrong, 200 as ``_json_requests`` has them (some without a city or
    with a text for the price), 100 with a key beside the records; and the events,
    which are no batches. A batch holds one such run at most."""
    order = F.expr("row_id div 2")
    at = F.pmod(order, F.lit(1600))
    kind = F.when(at < 1100, "large").when(at < 1300, "clean").when(at < 1500, "mixed").otherwise("noted")
    sent = _json_requests(spark, sf, rows)
    numbered = sent.where("request_id LIKE 'listing-%'").withColumn("row_id", F.expr("substring(request_id, 9)").cast("bigint"))
    numbered = numbered.withColumns({"kind": kind, "run": F.expr("row_id div 3200")})
    whole = F.regexp_replace(F.regexp_replace("body", '"not specified"', "null"), '"(, "zipcode")', '", "city": "ANY"$1')
    whole = F.when(F.contains("body", F.lit('"city":')), F.regexp_replace("body", '"not specified"', "null")).otherwise(whole)
    record = F.when(F.col("kind").isin("clean", "noted"), whole).otherwise(F.col("body"))
    packed = numbered.withColumn("record", record).groupBy("run", "kind").agg(F.sort_array(F.collect_list(F.struct("row_id", "record"))).alias("held"))
    records = F.array_join(F.transform("held", lambda r: r["record"]), ", ")
    noted = F.when(F.col("kind") == "noted", F.lit('"note": 1, ')).otherwise(F.lit(""))
    body = F.concat(F.lit("{"), noted, F.lit('"records": ['), records, F.lit("]}"))
    batches = packed.select(F.concat_ws("-", "kind", F.col("run").cast("string")).alias("batch_id"), body.alias("body"))
    return batches.unionByName(sent.where("request_id LIKE 'event-%'").select(F.col("request_id").alias("batch_id"), "body"))


@query
def nested_batches(spark, sf):
    """Nested batches, each scored or refused as a whole."""
    rows = _written(spark, sf)
    parsed = materialize(requests.parse_batches(_nested(spark, sf, rows), "body", SETTINGS.score), "nested")
    sent = requests.batch_records(parsed, "batch_id")
    scored = score_records(sent, _artifacts(spark, sf, rows), metros(spark, sf), SETTINGS, ["batch_id", "position"])
    predicted = scored.groupBy("batch_id").agg(F.count("predicted_price").alias("rows_predicted"), F.round(F.sum("predicted_price"), -2).alias("predicted_sum"))
    return parsed.join(predicted, "batch_id", "left").select(
        "batch_id", "n_records", F.array_join("reject_reasons", ",").alias("reject_reasons"), "rows_predicted", "predicted_sum"
    )


@query
def stream_requests(spark, sf):
    """Raw JSON requests put into a folder, as a stream of several batches with two sinks."""
    folder = scratch_path(spark, "stream-requests")
    rows = _written(spark, sf)
    # two batches, however many files there are: as many as a shuffle has tasks
    n = max(3, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    _json_requests(spark, sf, rows).repartition(2 * n).write.json(f"{folder}/in")
    current = CurrentArtifacts(lambda: "fixed", lambda _: _artifacts(spark, sf, rows))
    running = score_request_stream(
        read_request_stream(spark, f"{folder}/in", files_each=n), current, metros(spark, sf), SETTINGS, f"{folder}/out", f"{folder}/checkpoint"
    )
    running.awaitTermination()
    scored = read_sink(spark, f"{folder}/out", "scored")
    refused = read_sink(spark, f"{folder}/out", "refused").select("request_id", F.array_join("reject_reasons", ",").alias("reasons"))
    return scored.select("request_id", F.round("predicted_price").alias("predicted_price"), F.col("reject_reason").alias("reasons")).unionByName(refused, allowMissingColumns=True)


# --- sources, sinks, registry ----------------------------------------------


@query
def csv_round_trip(spark, sf):
    rows = _requests(spark, sf)
    path = scratch_path(spark, "export") + ".csv"
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, types={**REQUEST_FIELDS, "request_id": "bigint"}, row_id=None)


@query
def upload_requests(spark, sf):
    path = scratch_path(spark, "upload") + ".csv"
    tables.write_csv(_requests(spark, sf).drop("request_id"), path)
    uploaded = tables.read_upload(spark, path)
    return uploaded.groupBy("zipcode").agg(F.count("*").alias("n_rows"), F.max("median_list_price").alias("highest"))


@query
def split_files(spark, sf):
    """Train and eval rows from a written split table; holdout is pruned."""
    path = scratch_path(spark, "splits")
    tables.write_splits(_tagged(spark, sf), path)
    return tables.read_splits(spark, path, ("train", "eval")).select("row_id", "date", "price", "split")


@query
def rerun_splits(spark, sf):
    """All splits written, then written again without holdout rows."""
    path = scratch_path(spark, "splits")
    tagged = _tagged(spark, sf)
    tables.write_splits(tagged, path, produced=SPLITS)
    tables.write_splits(tagged.where("split <> 'holdout'"), path, produced=SPLITS)
    return tables.read_splits(spark, path).select("row_id", "date", "price", "split")


@query
def encoder_files(spark, sf):
    path = scratch_path(spark, "encoders")
    encode.save_encoders(encode.fit_encoders(_train(_kept(spark, sf)), SETTINGS.features), path)
    loaded = encode.load_encoders(spark, path)
    rows = loaded.target.table.withColumn("prior", F.lit(loaded.target.prior))
    return _rounded(rows.select("city_full", "n", "city_full_encoded", "prior"), "city_full_encoded", "prior")


def _monthly_artifacts(spark, sf):
    """Every month of every split as one registered version of its split."""
    month = F.date_trunc("month", F.col("date").cast("timestamp")).cast("date").cast("string")
    loads = _tagged(spark, sf).groupBy("split", month.alias("month")).agg(F.count("*").alias("n_rows"))
    records = loads.select(
        F.concat(F.lit("listings_"), "split").alias("name"),
        F.lit("dataset").alias("type"),
        F.concat(F.lit("splits/split="), "split", F.lit("/month="), "month").alias("path"),
        "month",
        "n_rows",
        F.array(F.lit("latest"), F.col("month")).alias("aliases"),
    )
    return registry.numbered(records, ["month"])


@query
def registry_latest(spark, sf):
    return registry.resolve(_monthly_artifacts(spark, sf)).select("name", "version", "path", "n_rows")


@query
def preferred_artifact(spark, sf):
    """The first registered name of a list wins; the first one is not there."""
    names = ["tuned_regressor", "listings_eval", "listings_train"]
    return registry.preferred(_monthly_artifacts(spark, sf), names).select("name", "version", "path", "n_rows")


@query
def registry_lineage(spark, sf):
    """Every version has the one before it as its input."""
    before = F.concat_ws(":v", "name", (F.col("version") - 1).cast("string"))
    inputs = F.when(F.col("version") > 1, F.array(before)).otherwise(F.array().cast("array<string>"))
    return registry.parents(_monthly_artifacts(spark, sf).withColumn("inputs", inputs))


@query
def registry_ancestors(spark, sf):
    """Every version has the one before it as its input, and every third one the first
    version of train as well."""
    before = F.concat_ws(":v", "name", (F.col("version") - 1).cast("string"))
    inputs = F.when(F.col("version") > 1, F.array(before)).otherwise(F.array().cast("array<string>"))
    both = F.when(F.col("version") % 3 == 0, F.concat(inputs, F.array(F.lit("listings_train:v1")))).otherwise(inputs)
    return registry.ancestors(_monthly_artifacts(spark, sf).withColumn("inputs", both))


@query
def registry_append(spark, sf):
    """Each period registered with its number of rows, then the later two again."""
    store = registry.Registry(spark, scratch_path(spark, "registry"))
    sizes = {r["split"]: r["n"] for r in _tagged(spark, sf).groupBy("split").agg(F.count("*").alias("n")).collect()}
    for name in (*SPLITS, "eval", "holdout"):
        store.register(f"listings_{name}", "dataset", store.folder, "split", metadata={"n_rows": sizes.get(name, 0)}, required=[sf])
    return store.artifacts().select("name", "version", F.col("metadata")["n_rows"].cast("bigint").alias("n_rows"), F.array_join("aliases", ",").alias("aliases"))


@query
def run_log(spark, sf):
    """Two steps with the rows they passed, and one that fails."""
    store = registry.Registry(spark, scratch_path(spark, "registry"))
    for step, rows in (("split", _tagged(spark, sf)), ("clean", _cleaned(spark, sf))):
        with store.step(step) as note:
            passed = Observation()
            rows.observe(passed, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
            note["rows"] = passed.get["n"]
    try:
        with store.step("scoring"):
            raise FileNotFoundError("Input not found: none.csv")
    except FileNotFoundError:
        pass
    return store.runs().select("step", "status", "n_rows", "error")


@query
def metric_log(spark, sf):
    found = _city_metrics(spark, sf)
    key = labels.metric_key(F.col("model"), F.col("split"), F.col("metric"))
    return _rounded(found.select(key.alias("key"), "value"), "value", digits=3)


@query
def model_labels(spark, sf):
    best = _rounded(metrics.best_model(_city_metrics(spark, sf), ["dummy", "city"]), "value")
    model, metric, value = F.col("model"), F.col("metric"), F.col("value")
    return best.select(
        labels.best_description(model, metric, value).alias("description"),
        F.array_join(labels.best_tags(model, metric), ",").alias("tags"),
        F.array_join(labels.best_aliases(model, metric), ",").alias("aliases"),
    )


@query
def loaded_model_info(spark, sf):
    info = model_info(spark, _artifacts(spark, sf))
    return info.select("status", "version", "source", "n_features", F.array_join("train_columns", ",").alias("train_columns"))


# --- flagship --------------------------------------------------------------


@query
def baseline_report(spark, sf):
    """Raw tables to metrics: split, clean, encode on train, apply, and the
    train-mean baseline next to the city encoding on every split."""
    found = metrics.evaluate_candidates(
        _city_model(spark, sf), "price", {"dummy": "p_dummy", "city": "p_city"}
    )
    return _rounded(found, "value", digits=3)
