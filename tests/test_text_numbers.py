import re

import pandas as pd
import pytest
from conftest import SF
from pyspark.sql import functions as F

from gableframe.functions.numbers import lenient_double, nan_to_null, seeded_key, uniform_from
from gableframe.functions.text import normalize_city, normalize_metro, replace_mapped


def one(spark, column_fn, value):
    return spark.createDataFrame([(value,)], "v string").select(column_fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "text, city",
    [
        ("  Atlanta—Sandy   Springs ", "atlanta-sandy springs"),
        (None, None),
        ("", ""),
        ("a  b\x1cc\x85", "a b c"),
        ("　Zürich–Nord\t\n", "zürich-nord"),
    ],
)
def test_city_text(spark, text, city):
    assert one(spark, normalize_city, text) == city


def test_city_text_with_any_white_space(spark):
    """Every white space, alone and in runs, at the ends and inside, beside dashes and a final sigma."""
    spaces = [*" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2009\u200a\u2028\u2029\u202f\u205f\u3000", "", "  ", " \t", "\t "]
    texts = [f"{a}ΟΔΟΣ–X{b}Y—ΣΣ{a}" for a in spaces for b in spaces]
    found = spark.createDataFrame([(t,) for t in texts], "v string").select("v", normalize_city(F.col("v"))).collect()
    for text, city in found:
        dashed = text.lower().replace("–", "-").replace("—", "-")
        assert city == re.sub(r"[\s\x1c-\x1f]+", " ", dashed).strip(" "), repr(text)


def test_even_city_text_is_not_rewritten(spark):
    plan = spark.createDataFrame([("a",)], "v string").select(normalize_city(F.col("v")))
    assert "rlike" in plan._jdf.queryExecution().analyzed().toString().lower()


@pytest.mark.parametrize(
    "text, metro",
    [
        (" Atlanta-Sandy Springs-Roswell, GA ", "atlanta-sandy springs-roswell"),
        ("Washington-Arlington-Alexandria, DC-VA-MD-WV", "washington-arlington-alexandria"),
        ("no comma", "no comma"),
        ("a ,b,c", "a "),
        (None, None),
    ],
)
def test_metro_text(spark, text, metro):
    assert one(spark, normalize_metro, text) == metro


def test_city_text_equals_brute_force_on_whole_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r[0]: r[1] for r in docs.select("doc_id", normalize_city(F.col("text"))).collect()}
    for doc_id, text in docs.collect():
        want = re.sub(r"\s+", " ", re.sub("[–—]", "-", text.strip().lower())).strip()
        assert got[doc_id] == want, doc_id


def test_mapping_is_one_pass_on_whole_values(spark):
    mapping = {"A—X": "b-x", "b-x": "c-x"}
    assert one(spark, lambda c: replace_mapped(c, mapping), "a-x") == "b-x"
    assert one(spark, lambda c: replace_mapped(c, mapping), "a-x y") == "a-x y"
    assert one(spark, lambda c: replace_mapped(c, mapping), None) is None


def test_numbers_in_text_equal_pandas(spark):
    texts = ["1d", "12F", "100", " 100 ", "1e5", "inf", "-Infinity", "nan", "0x1p3", "", "abc", "1.", ".", ".5"]
    texts += ["1_000", "+3", " ", None, "1,000", "20000000"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(lenient_double(df, "v")).collect()]
    want = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce").tolist()
    assert [None if g is None or g != g else g for g in got] == [None if w != w else w for w in want]


def test_nan_to_null_leaves_other_types(spark):
    df = spark.createDataFrame([(float("nan"), "NaN", 1), (2.0, None, None)], "a double, b string, c int")
    assert [tuple(r) for r in nan_to_null(df).collect()] == [(None, "NaN", 1), (2.0, None, None)]


def test_uniforms_depend_on_seed_and_are_even(spark):
    df = spark.range(4000)
    u = df.select(uniform_from(seeded_key(7, F.col("id"))).alias("u"), uniform_from(seeded_key(8, F.col("id"))).alias("w"))
    row = u.agg(F.avg("u"), F.min("u"), F.max("u"), F.corr("u", "w")).first()
    assert abs(row[0] - 0.5) < 0.02 and 0 <= row[1] < 0.01 and 0.99 < row[2] < 1 and abs(row[3]) < 0.05
