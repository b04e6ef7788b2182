from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gableframe.config import SPLITS, BroadcastBound, Settings
from gableframe.operators.clean import (
    clean,
    cleaning_audit,
    drop_duplicates_keep_first,
    drop_price_outliers,
    lookup_keep_first,
    merge_locations,
    unmatched_cities,
)
from gableframe.operators.lookup import fits_broadcast, hot_keys, lookup_join
from gableframe.operators.splits import rows_of_split, split_by_date, split_profile

CFG = Settings()
SALTED = BroadcastBound(max_rows=0, salts=4)
METROS = "row_id int, metro_full string, lat double, lng double"


@pytest.fixture()
def metros(spark):
    return spark.createDataFrame(
        [
            (0, " Atlanta-Sandy Springs-Roswell, GA ", 33.75, -84.39),
            (1, "Atlanta–Sandy Springs-Roswell, GA", 99.99, 99.99),
            (2, None, 1.0, 2.0),
        ],
        METROS,
    )


def dated(spark, *days):
    return spark.createDataFrame([(d, i) for i, d in enumerate(days)], "date string, price int")


def test_split_boundaries_and_null_dates(spark, rows):
    df = dated(spark, "2022-03-01", "2019-12-31", "2021-06-01", "2020-01-01", None, "2022-01-01")
    got = rows(split_by_date(df, CFG.split), "price", "split")
    assert got == [(0, "holdout"), (1, "train"), (2, "eval"), (3, "eval"), (5, "holdout")]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_split_of_typed_dates(spark, rows, kind):
    df = dated(spark, "2019-12-31", "2020-01-01").withColumn("date", F.col("date").cast(kind))
    assert rows(split_by_date(df, CFG.split), "price", "split") == [(0, "train"), (1, "eval")]


def test_split_errors(spark):
    with pytest.raises(ValueError, match="date"):
        split_by_date(spark.range(1), CFG.split)
    with pytest.raises(ValueError, match="earlier"):
        split_by_date(dated(spark, "2020-01-01"), CFG.with_(split={"eval_start": "2022-01-01"}).split)


def test_split_profile(spark, rows):
    df = split_by_date(dated(spark, "2019-01-01", "2019-05-01", "2020-02-02"), CFG.split)
    day = datetime
    assert rows(split_profile(df, CFG.split)) == [
        ("eval", 1, 2, day(2020, 2, 2), day(2020, 2, 2)),
        ("train", 2, 2, day(2019, 1, 1), day(2019, 5, 1)),
    ]


@pytest.mark.parametrize("bound", [BroadcastBound(), SALTED])
def test_locations_mapped_joined_null_safe(spark, metros, rows, bound):
    df = spark.createDataFrame(
        [(1, "Atlanta-Sandy Springs-Alpharetta"), (2, "Nowhere"), (3, None)], "id int, city_full string"
    )
    out = merge_locations(df, metros, CFG.clean, bound)
    assert out.columns == ["id", "city_full", "lat", "lng"]
    assert rows(out) == [
        (1, "atlanta-sandy springs-roswell", 33.75, -84.39),
        (2, "nowhere", None, None),
        (3, None, 1.0, 2.0),
    ]
    assert rows(unmatched_cities(out, CFG.clean)) == [("nowhere",)]


def test_lookup_keeps_first_row(spark, metros, rows):
    assert ("atlanta-sandy springs-roswell", 33.75, -84.39) in rows(lookup_keep_first(metros, CFG.clean))
    assert lookup_keep_first(metros, CFG.clean).count() == 2


def test_location_skips(spark, metros, rows):
    with_places = spark.createDataFrame([(" A ", 10.0, 20.0)], "city_full string, lat double, lng double")
    assert rows(merge_locations(with_places, metros, CFG.clean, CFG.broadcast)) == [("a", 10.0, 20.0)]
    plain = spark.createDataFrame([(" A ",)], "city_full string")
    assert rows(merge_locations(plain, None, CFG.clean, CFG.broadcast)) == [("a",)]
    assert rows(merge_locations(plain, metros.drop("lat"), CFG.clean, CFG.broadcast)) == [("a",)]
    no_city = spark.createDataFrame([(1,)], "x int")
    assert merge_locations(no_city, metros, CFG.clean, CFG.broadcast).columns == ["x"]
    with pytest.raises(ValueError, match="only one"):
        merge_locations(with_places.drop("lng"), metros, CFG.clean, CFG.broadcast)


def test_broadcast_is_bound_by_rows_and_bytes(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    assert fits_broadcast(df, BroadcastBound(max_rows=100))
    assert not fits_broadcast(df, BroadcastBound(max_rows=99))
    assert not fits_broadcast(df, BroadcastBound(max_bytes=100))
    assert fits_broadcast(df.limit(0), BroadcastBound(max_rows=0))


def test_salted_join_equals_broadcast_with_a_hot_key(spark, rows):
    hot = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    hot = hot.withColumn("k", F.when(F.col("id") % 11 != 0, F.col("k")))
    lookup = spark.createDataFrame([(None, -1)] + [(i, i * i) for i in range(40)], "key int, v int")
    lookup = lookup.withColumn("key", F.col("key").cast("bigint"))
    broadcast = lookup_join(hot, lookup, "k", "key", ["v"], BroadcastBound())
    salted = lookup_join(hot, lookup, "k", "key", ["v"], SALTED)
    assert salted.count() == 3000 and rows(salted) == rows(broadcast)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "__salt" in plan


def test_only_hot_keys_are_written_and_rows_counted_once(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id")).alias("k"))
    hot = hot_keys(df, "k", SALTED)
    folder = hot.inputFiles()[0].rsplit("/", 1)[0]
    assert spark.read.parquet(folder).count() == 1
    assert hot_keys(df.where("k IS NOT NULL"), "k", SALTED).count() == 0


def test_only_hot_keys_are_salted_and_maps_are_allowed(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in hot_keys(df, "k", SALTED).collect()] == [(None,)]
    with_map = df.withColumn("m", F.create_map(F.lit("a"), "id"))
    lookup = spark.range(4000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    found = lookup_join(with_map, lookup, "k", "key", ["v"], SALTED)
    assert found.columns == ["id", "k", "m", "v"]
    assert found.count() == 4000 and found.where("v = 2 * k").count() == 2000 and found.where("v IS NULL").count() == 2000
    assert lookup_join(with_map.limit(0), lookup, "k", "key", ["v"], SALTED).count() == 0


def test_nested_columns_count_against_the_bound(spark):
    df = spark.range(10).select(F.array_repeat(F.lit("x" * 50), 100).alias("a"))
    assert not fits_broadcast(df, BroadcastBound(max_bytes=10_000))


def test_duplicates_keep_first_by_date_then_row(spark, rows):
    df = spark.createDataFrame(
        [
            (3, "2020-03-01", 2020, 99999, 300000),
            (2, "2020-02-01", 2021, 12345, 100000),
            (1, "2020-01-01", 2020, 12345, 100000),
            (0, "2020-01-01", 2019, 12345, 100000),
            (4, None, 2020, 12345, 100000),
        ],
        "row_id int, date string, year int, zipcode int, price int",
    )
    assert rows(drop_duplicates_keep_first(df, CFG.clean), "row_id", "date", "year") == [
        (0, "2020-01-01", 2019),
        (3, "2020-03-01", 2020),
    ]


def test_duplicates_null_nan_and_zero_compare_equal(spark, rows):
    nan = float("nan")
    df = spark.createDataFrame(
        [(0, None, 0.0), (1, None, -0.0), (2, nan, 1.0), (3, nan, 1.0), (4, 1.0, 1.0)],
        "row_id int, a double, b double",
    )
    assert rows(drop_duplicates_keep_first(df, CFG.clean), "row_id") == [(0,), (2,), (4,)]


def test_duplicates_only_ignored_columns_or_no_order(spark):
    only = spark.createDataFrame([("2020", 1), ("2020", 1)], "date string, year int")
    assert drop_duplicates_keep_first(only, CFG.clean).count() == 2
    with pytest.raises(ValueError, match="row order"):
        drop_duplicates_keep_first(only.withColumn("x", F.lit(1)), CFG.clean)


def test_duplicates_are_bound_by_split(spark):
    df = spark.createDataFrame(
        [(0, "train", 5), (1, "eval", 5), (2, "train", 5)], "row_id int, split string, price int"
    )
    assert drop_duplicates_keep_first(df, CFG.clean, group=["split"]).count() == 2
    assert drop_duplicates_keep_first(df.drop("split"), CFG.clean).count() == 1


def test_hot_duplicates_shrink_before_the_shuffle(spark):
    df = spark.range(1000).select(F.col("id").alias("row_id"), (F.col("id") % 2).alias("x"), F.lit("d").alias("date"))
    plan = drop_duplicates_keep_first(df, CFG.clean)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_outliers_numeric_and_text(spark, rows):
    numbers = spark.createDataFrame(
        [(19000000.0,), (19000001.0,), (None,), (float("nan"),), (float("inf"),)], "median_list_price double"
    )
    kept = rows(drop_price_outliers(numbers, CFG.clean))
    assert [repr(r[0]) for r in kept] == ["19000000.0", "None", "nan"]
    text = spark.createDataFrame([("100000",), ("invalid",), ("20000000",), (None,)], "median_list_price string")
    assert rows(drop_price_outliers(text, CFG.clean)) == [("100000",), ("invalid",), (None,)]
    assert drop_price_outliers(spark.range(3), CFG.clean).count() == 3


def test_clean_equals_the_steps_in_their_order(spark, metros, rows):
    df = spark.createDataFrame(
        [
            (0, "2020-01-01", "Nowhere", 5.0),
            (1, "2019-01-01", " NOWHERE", 5.0),
            (2, "2020-01-01", "Nowhere", 2e7),
            (3, "2020-01-01", "atlanta-sandy springs-roswell", None),
        ],
        "row_id int, date string, city_full string, median_list_price double",
    )
    whole = clean(df, metros, CFG.clean, CFG.broadcast)
    steps = merge_locations(df, metros, CFG.clean, CFG.broadcast)
    steps = drop_price_outliers(drop_duplicates_keep_first(steps, CFG.clean), CFG.clean)
    assert rows(whole) == rows(steps) == [
        (1, "2019-01-01", "nowhere", 5.0, None, None),
        (3, "2020-01-01", "atlanta-sandy springs-roswell", None, 33.75, -84.39),
    ]


def test_audit_counts(spark, rows):
    df = spark.createDataFrame(
        [(i, "d", "train", p) for i, p in enumerate([1.0, 1.0, 2e7, 2e7, None])] + [(9, "d", "eval", 3.0)],
        "row_id int, date string, split string, median_list_price double",
    )
    assert rows(cleaning_audit(df, CFG.clean)) == [
        ("eval", "duplicates", 1, 1, 0),
        ("eval", "price_outliers", 1, 1, 0),
        ("train", "duplicates", 5, 3, 2),
        ("train", "price_outliers", 3, 2, 1),
    ]


def test_rows_of_a_split_reach_the_scan(spark, tmp_path):
    days = spark.sql("SELECT id, timestamp '2019-12-30' + make_interval(0, 0, 0, 0, 12 * id) AS date FROM range(1600)")
    cfg = Settings().split
    for kind in ("timestamp", "timestamp_ntz", "date", "string"):
        path = str(tmp_path / kind)
        days.union(spark.sql("SELECT -1L, CAST(NULL AS timestamp)")).withColumn("date", F.col("date").cast(kind)).write.parquet(path)
        table = spark.read.parquet(path)
        tagged = split_by_date(table, cfg)
        for name in SPLITS:
            got = rows_of_split(table, cfg, name)
            assert got.schema == tagged.schema
            assert sorted(map(tuple, got.collect())) == sorted(tuple(r) for r in tagged.where(F.col("split") == name).collect())
        if kind != "string":
            plan = rows_of_split(table, cfg, "eval")._jdf.queryExecution().executedPlan().toString()
            assert "GreaterThanOrEqual(date,2020-01-01" in plan and "LessThan(date,2022-01-01" in plan
    with pytest.raises(ValueError, match="Unknown split"):
        rows_of_split(table, cfg, "test")


def test_a_stream_beyond_the_bound_is_neither_broadcast_nor_repeated(spark, tmp_path):
    """16 copies of the lookup went to the driver, as its file looked small."""
    spark.createDataFrame([(i % 5, i) for i in range(40)], "k long, i long").write.parquet(f"{tmp_path}/in")
    spark.createDataFrame([(i, i * 10) for i in range(4)], "key long, v long").write.parquet(f"{tmp_path}/lookup")
    lookup = spark.read.parquet(f"{tmp_path}/lookup")
    stream = spark.readStream.schema("k long, i long").parquet(f"{tmp_path}/in")
    bound = BroadcastBound(max_rows=3)
    joined = lookup_join(stream, lookup, "k", "key", ["v"], bound)
    writer = joined.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state")
    writer.trigger(availableNow=True).start().awaitTermination()
    found = {(r["i"], r["v"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert found == {(i, None if i % 5 == 4 else i % 5 * 10) for i in range(40)}
    assert "sequence" not in joined._jdf.queryExecution().logical().toString()
    rows = spark.read.parquet(f"{tmp_path}/in")
    for df, salted in ((rows, True), (spark.range(400).select(F.col("id").alias("k"), F.col("id").alias("i")), False)):
        plan = lookup_join(df, lookup, "k", "key", ["v"], BroadcastBound(max_rows=3))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and ("__salt" in plan) == salted
