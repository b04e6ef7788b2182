import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from gableframe.config import BroadcastBound, Settings
from gableframe.models.scoring import Artifacts, rows_predicted, score_records, score_table, scoring_metrics
from gableframe.operators.encode import Encoders, TargetEncoding
from gableframe.operators.requests import (
    accepted_batches,
    batch_records,
    batch_sizes,
    explode_batches,
    missing_fields,
    parse_batches,
    parse_requests,
    to_raw_names,
)
from gableframe.schema import DEMOGRAPHIC_NAMES, OPTIONAL_FIELDS, REQUEST_FIELDS, check_request_columns
from gableframe.streaming.score import CurrentArtifacts, read_request_stream, read_sink, score_request_stream, score_stream

CFG = Settings()
TRAIN_COLUMNS = ("year", "quarter", "month", "median_list_price", "lat", "lng", "zipcode_freq", "city_full_encoded")
GOOD = {"date": "2022-01-01", "city_full": "Atlanta-Sandy Springs-Alpharetta", "city": "ATL", "zipcode": 30301}


@pytest.fixture()
def artifacts(spark):
    """A model that tells its inputs: 1000 + list price / 1000 + frequency, and
    a million more when the latitude is missing."""
    statement = (
        "SELECT *, 1000 + median_list_price / 1000 + zipcode_freq + IF(lat IS NULL, 1000000, 0) AS prediction "
        "FROM __THIS__"
    )
    frequency = spark.createDataFrame([(30301, 5), (15213, 3)], "zipcode bigint, zipcode_freq bigint")
    target = spark.createDataFrame(
        [("atlanta-sandy springs-roswell", 9, 1.0, 77.0)],
        "city_full string, n bigint, mean double, city_full_encoded double",
    )
    model = PipelineModel(stages=[SQLTransformer(statement=statement)])
    return Artifacts(model, Encoders(frequency, TargetEncoding(target, 55.0)), TRAIN_COLUMNS, "m@sha256:0@local")


@pytest.fixture()
def metros(spark):
    return spark.createDataFrame(
        [(0, "Atlanta-Sandy Springs-Roswell, GA", 33.75, -84.39)], "row_id int, metro_full string, lat double, lng double"
    )


def parsed(spark, *bodies):
    texts = [(i, b if b is None or isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    out = parse_requests(spark.createDataFrame(texts, "request_id int, body string"), "body")
    return [(r.request, r.reject_reasons) for r in out.orderBy("request_id").collect()]


def test_contract_accepts(spark):
    full = {**GOOD, **{n: 1.5 for n in OPTIONAL_FIELDS}, "price": 3}
    lax = {**GOOD, "zipcode": "30301", "bank": "12.5", "mall": None}
    whole = {**GOOD, "zipcode": 30301.0}
    for request, reasons in parsed(spark, GOOD, full, lax, whole):
        assert reasons == [] and request.zipcode == 30301 and request.date == "2022-01-01"
    assert parsed(spark, lax)[0][0].bank == 12.5
    assert set(parsed(spark, full)[0][0].asDict()) == set(REQUEST_FIELDS)


@pytest.mark.parametrize(
    "body, reasons",
    [
        ({k: v for k, v in GOOD.items() if k != "zipcode"}, ["missing:zipcode"]),
        ({**GOOD, "unknown_column": 1}, ["unknown:unknown_column"]),
        ({**GOOD, "zipcode": 30301.5}, ["type:zipcode"]),
        ({**GOOD, "zipcode": None}, ["type:zipcode"]),
        ({**GOOD, "city": 5}, ["type:city"]),
        ({**GOOD, "bank": "many"}, ["type:bank"]),
        ({**GOOD, "bank": "1d"}, ["type:bank"]),
        ({**GOOD, "bank": [1]}, ["type:bank"]),
        ({**GOOD, "date": "soon"}, ["date:date"]),
        ({"k": 1}, ["missing:city", "missing:city_full", "missing:date", "missing:zipcode", "unknown:k"]),
        ("{bad", ["invalid"]),
        ("[1]", ["invalid"]),
        (None, ["invalid"]),
    ],
)
def test_contract_rejects(spark, body, reasons):
    assert parsed(spark, body) == [(None, reasons)]


def test_column_contract(spark):
    df = spark.createDataFrame([tuple(GOOD.values())], "date string, city_full string, city string, zipcode bigint")
    check_request_columns(df)
    with pytest.raises(ValueError, match="zipcode"):
        check_request_columns(df.drop("zipcode"))
    with pytest.raises(ValueError, match="surprise"):
        check_request_columns(df.withColumn("surprise", F.lit(1)))


def test_missing_report(spark):
    df = spark.createDataFrame([(1.0, None, float("nan"))], "bank double, price double, mall double")
    names = df.select(missing_fields(df).alias("m")).first().m
    assert len(OPTIONAL_FIELDS) == 33 and len(names) == 32
    assert "bank" not in names and "mall" in names and "price" not in names


def test_raw_names(spark):
    df = spark.range(1).select(*[F.lit(1).alias(n) for n in DEMOGRAPHIC_NAMES], F.lit(1).alias("bank"))
    assert to_raw_names(df).columns == [*DEMOGRAPHIC_NAMES.values(), "bank"]


@pytest.mark.parametrize("bound", [BroadcastBound(), BroadcastBound(max_rows=0)])
def test_batch_limits(spark, bound):
    df = spark.range(2101).select(F.when(F.col("id") < 1000, "ok").when(F.col("id") < 2001, "big").otherwise("x").alias("b"))
    sizes = {r.b: (r.n_records, r.accepted) for r in batch_sizes(df, "b", CFG.score).collect()}
    assert sizes == {"ok": (1000, True), "big": (1001, False), "x": (100, True)}
    assert accepted_batches(df, "b", CFG.score, bound).count() == 1100


def test_nested_batches(spark):
    df = spark.createDataFrame(
        [("a", ["x", "y"]), ("b", []), ("c", None), ("d", ["z"] * 1001)], "batch_id string, records array<string>"
    )
    records, rejected = explode_batches(df, "batch_id", "records", CFG.score)
    assert [tuple(r) for r in records.orderBy("position").collect()] == [("a", 0, "x"), ("a", 1, "y")]
    assert {(r[0], r[1]) for r in rejected.collect()} == {("b", 0), ("c", 0), ("d", 1001)}


def test_batches_are_taken_or_refused_whole(spark):
    extra = {**GOOD, "unknown_column": 1}
    short = {k: v for k, v in GOOD.items() if k != "city"}
    bodies = {
        "good": {"records": [GOOD, {**GOOD, "zipcode": "15213", "bank": None}]},
        "empty": {"records": []},
        "most": {"records": [GOOD] * 1000},
        "large": {"records": [short] * 1001},
        "one bad": {"records": [GOOD, {**short, "bank": "x"}, GOOD, extra]},
        "quoted": {"records": [json.dumps(GOOD), 5, None]},
        "no array": {"records": GOOD},
        "null": {"records": None},
        "other": {"items": [GOOD], "a": 1},
        "noted": {"records": [GOOD], "note": 1},
        "array": "[]",
        "text": "records",
        "none": None,
    }
    rows = [(k, b if b is None or isinstance(b, str) else json.dumps(b)) for k, b in bodies.items()]
    out = parse_batches(spark.createDataFrame(rows, "batch_id string, body string"), "body", CFG.score)
    found = {r.batch_id: (r.n_records, r.reject_reasons) for r in out.collect()}
    assert found == {
        "good": (2, []),
        "empty": (0, ["too_few"]),
        "most": (1000, []),
        "large": (1001, ["too_many"]),
        "one bad": (4, ["records[1].missing:city", "records[1].type:bank", "records[3].unknown:unknown_column"]),
        "quoted": (3, ["records[0].invalid", "records[1].invalid", "records[2].invalid"]),
        "no array": (None, ["type:records"]),
        "null": (None, ["type:records"]),
        "other": (None, ["missing:records", "unknown:a", "unknown:items"]),
        "noted": (1, ["unknown:note"]),
        "array": (None, ["invalid"]),
        "text": (None, ["invalid"]),
        "none": (None, ["invalid"]),
    }
    records = batch_records(out, "batch_id")
    assert records.groupBy("batch_id").count().where("batch_id = 'most' AND count = 1000").count() == 1
    assert [(r.position, r.zipcode, r.bank) for r in records.where("batch_id = 'good'").orderBy("position").collect()] == [(0, 30301, None), (1, 15213, None)]
    alone = parse_requests(spark.createDataFrame([(0, json.dumps(GOOD))], "request_id int, body string"), "body").first().request
    assert records.where("batch_id = 'good' AND position = 0").drop("batch_id", "position").first() == alone
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_raw_stream_equals_batch_after_a_restart(spark, artifacts, metros, tmp_path):
    """One file a batch; the model cannot be loaded in the third batch, and the batch that
    had been written before the stop is run again."""
    bodies = [(str(i), json.dumps({**GOOD, "median_list_price": 1000.0 * i} if i % 3 else {"date": "x", "zipcode": i})) for i in range(40)]
    rows = spark.createDataFrame(bodies, "request_id string, body string")
    source, sink, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    rows.repartition(5).write.json(source)
    calls = []

    def failing():
        calls.append(1)
        if len(calls) == 3:
            raise OSError("no model")
        return artifacts

    def start(models):
        score_request_stream(read_request_stream(spark, source, 1), models, metros, CFG, sink, mark).awaitTermination()

    with pytest.raises(StreamingQueryException, match="no model"):
        start(failing)
    done = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    (tmp_path / "checkpoint" / "commits" / str(done)).unlink()  # as if the driver had been lost before the commit
    (tmp_path / "checkpoint" / "commits" / f".{done}.crc").unlink(missing_ok=True)
    start(lambda: artifacts)
    checked = parse_requests(rows, "body")
    want = score_records(checked.where("request IS NOT NULL").select("request_id", "request.*"), artifacts, metros, CFG)
    got = read_sink(spark, sink, "scored").select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    refused = read_sink(spark, sink, "refused").collect()
    assert sorted((r.request_id, r.body, r.reject_reasons) for r in refused) == sorted(tuple(r) for r in checked.where("request IS NULL").select("request_id", "body", "reject_reasons").collect())
    assert len(refused) == 14


def test_artifacts_follow_their_reference(artifacts):
    names, loaded = iter(["a:v1", "a:v1", "a:v2", "a:v2"]), []
    current = CurrentArtifacts(lambda: next(names), lambda name: loaded.append(name) or artifacts)
    for _ in range(4):
        current()
    assert loaded == ["a:v1", "a:v2"]


REQUESTS = "request_id int, date string, city_full string, city string, zipcode bigint, median_list_price double"


def request_rows(spark):
    city = GOOD["city_full"]
    return spark.createDataFrame(
        [
            (1, "2022-01-01", city, "ATL", 30301, 120000.0),
            (2, "2022-01-01", city, "ATL", 30301, 120000.0),
            (3, "2022-02-01", "Pittsburgh", "PIT", 99999, None),
            (4, "2022-02-01", city, "ATL", 30301, 19000001.0),
        ],
        REQUESTS,
    )


EXPECTED = {1: 1125.0, 2: 1125.0, 3: 1001000.0, 4: None}


def test_records_are_scored_on_their_own(spark, artifacts, metros):
    out = score_records(request_rows(spark), artifacts, metros, CFG)
    got = {r.request_id: r for r in out.collect()}
    assert {k: r.predicted_price for k, r in got.items()} == EXPECTED
    assert got[4].reject_reason == "price_above_limit" and got[1].reject_reason is None
    assert got[1].missing_optional_count == 32 and got[3].missing_optional_count == 33
    assert got[1].model_version == "m@sha256:0@local"


def test_a_bad_record_does_not_fail_the_others(spark, artifacts, metros):
    bad = spark.createDataFrame(
        [(5, "soon", "x", "X", 1, 1.0), (6, None, "x", "X", 1, 1.0), (7, "2022-01-01", None, "X", 1, 1.0)], REQUESTS
    )
    out = score_records(request_rows(spark).unionByName(bad), artifacts, metros, CFG)
    got = {r.request_id: (r.predicted_price, r.reject_reason) for r in out.collect()}
    assert {k: v[0] for k, v in got.items() if k < 5} == EXPECTED
    assert got[5] == (None, "invalid_date") and got[6] == got[7] == (None, "missing_required")


def test_rows_predicted_per_batch(spark, artifacts, metros):
    rows = request_rows(spark).withColumn("batch_id", F.when(F.col("request_id") < 3, "a").otherwise("b"))
    out = score_records(rows, artifacts, metros, CFG, ["batch_id", "request_id"])
    assert {tuple(r) for r in rows_predicted(out, "batch_id", CFG.score).collect()} == {("a", 2), ("b", 1)}


def test_stream_equals_batch(spark, artifacts, metros, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    request_rows(spark).repartition(3).write.parquet(source)
    stream = spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", 1).parquet(source)
    query = score_stream(stream, artifacts, metros, CFG, sink, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    batch = score_records(request_rows(spark), artifacts, metros, CFG)
    got = sorted(map(repr, spark.read.parquet(sink).select(*batch.columns).collect()))
    assert got == sorted(map(repr, batch.collect()))


def test_file_scoring_cleans_first(spark, artifacts, metros):
    rows = request_rows(spark).withColumnRenamed("request_id", "row_id").withColumn("price", F.lit(1000.0))
    out = score_table(rows, artifacts, metros, CFG)
    assert out.columns == ["row_id", *TRAIN_COLUMNS, "predicted_price", "actual_price", "prediction_error"]
    got = {r.row_id: r for r in out.collect()}
    assert set(got) == {1, 3}
    assert got[1].prediction_error == 125.0 and got[1].city_full_encoded == 77.0
    assert got[3].predicted_price is None and got[3].city_full_encoded == 55.0 and got[3].lat is None
    assert scoring_metrics(out, CFG.score).first().mae == 125.0
    unknown = score_table(rows.drop("price"), artifacts, metros, CFG)
    assert scoring_metrics(unknown, CFG.score) is None


def test_required_fields_are_read_once_and_only_wrong_numbers_are_named(spark):
    """all 35 number fields went through interpreted functions three times for every record."""
    texts = [
        '{"date": "2020-01-01", "city_full": "a", "city": "b", "zipcode": "12", "price": "1e2", "inventory": null}',
        '{"date": "2020-01-01", "city_full": "a", "city": 7, "zipcode": 1.5, "price": "1d", "bank": "x", "zz": 1, "zz": 2}',
        '{"date": "x", "zipcode": "y"}',
    ]
    sent = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    parsed = parse_requests(sent, "body")
    found = {r["id"]: r for r in parsed.collect()}
    assert (found[0]["request"]["zipcode"], found[0]["request"]["price"], found[0]["request"]["inventory"]) == (12, 100.0, None)
    assert found[0]["reject_reasons"] == [] and found[1]["request"] is None and found[2]["request"] is None
    assert found[1]["reject_reasons"] == ["type:bank", "type:city", "type:price", "type:zipcode", "unknown:zz"]
    assert found[2]["reject_reasons"] == ["date:date", "missing:city", "missing:city_full", "type:zipcode"]
    assert "zip_with" not in parsed._jdf.queryExecution().optimizedPlan().toString()
