"""Whole flow against a pandas brute force, with hot groups, nulls and copies."""

import numpy as np
import pandas as pd
import pytest

from gableframe.config import BroadcastBound, Settings
from gableframe.operators.clean import clean
from gableframe.operators.features import engineer_features
from gableframe.operators.splits import split_by_date

COLUMNS = "row_id bigint, date string, city_full string, zipcode bigint, median_list_price double, price double"


def table(seed, n=3000):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        day = f"20{rng.integers(18, 24)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}"
        kind = rng.integers(3)
        if kind == 0:  # a third of all rows are copies of one another but for the date
            rows.append((i, day, " Hot—City ", 1, 5e5, 1e5))
        elif kind == 1:
            rows.append((i, day, None, None, None if rng.integers(2) else float("nan"), float(rng.integers(3)) * 1e5))
        else:
            city = f"City {rng.integers(4)}" if rng.integers(5) else "dc_metro"
            price = float(rng.choice([1e5, 19_000_000, 19_000_001, 3e7]))
            target = None if rng.integers(9) == 0 else float(rng.integers(1, 9)) * 1e5
            rows.append((i, None if rng.integers(20) == 0 else day, city, int(rng.integers(1, 9)), price, target))
    return rows


METROS = [(0, "Hot–City, XX", 1.0, 2.0), (1, "hot-city", 9.0, 9.0), (2, None, 3.0, 4.0), (3, "City 1, A", 5.0, 6.0)]


def expected(rows):
    df = pd.DataFrame(rows, columns=["row_id", "date", "city_full", "zipcode", "median_list_price", "price"])
    df["date"] = pd.to_datetime(df["date"])
    df = df[df["date"].notna()].copy()
    df["split"] = np.where(df["date"] < "2020-01-01", "train", np.where(df["date"] < "2022-01-01", "eval", "holdout"))
    mapping = {"dc_metro": "washington-arlington-alexandria"}
    df["city_full"] = df["city_full"].map(
        lambda c: None if pd.isna(c) else (lambda t: mapping.get(t, t))(c.strip().lower().replace("—", "-"))
    )
    df = df.sort_values(["date", "row_id"])
    same = ["split", "city_full", "zipcode", "median_list_price", "price"]
    df = df.drop_duplicates(subset=same, keep="first")
    df = df[df["median_list_price"].isna() | (df["median_list_price"] <= 19_000_000)]
    places = {"hot-city": (1.0, 2.0), None: (3.0, 4.0), "city 1": (5.0, 6.0)}
    train = df[df["split"] == "train"]
    freq = train.groupby("zipcode", dropna=False).size()
    known = train[train["price"].notna()]
    prior = known["price"].mean()
    stats = known.assign(city_full=known["city_full"].fillna("<none>")).groupby("city_full")["price"].agg(["count", "mean"])
    w = 1 / (1 + np.exp(-(stats["count"] - 20) / 10))
    code = prior * (1 - w) + stats["mean"] * w
    out = {}
    for r in df.itertuples():
        zipcode = None if pd.isna(r.zipcode) else r.zipcode
        counts = {None if pd.isna(k) else k: v for k, v in freq.items()}
        lat, lng = places.get(r.city_full, (None, None))
        city = "<none>" if r.city_full is None else r.city_full
        out[r.row_id] = (r.split, r.date.year, lat, lng, counts.get(zipcode, 0), code.get(city, prior))
    return out


@pytest.mark.parametrize("seed, bound", [(1, BroadcastBound()), (2, BroadcastBound(max_rows=0, salts=3))])
def test_flow_equals_pandas(spark, seed, bound):
    rows = table(seed)
    cfg = Settings(broadcast=bound)
    tagged = split_by_date(spark.createDataFrame(rows, COLUMNS).repartition(5), cfg.split)
    metros = spark.createDataFrame(METROS, "row_id int, metro_full string, lat double, lng double")
    cleaned = clean(tagged, metros, cfg.clean, cfg.broadcast, group=["split"])
    features, _ = engineer_features(cleaned, cfg)
    got = {
        r.row_id: (r.split, r.year, r.lat, r.lng, r.zipcode_freq, r.city_full_encoded) for r in features.collect()
    }
    want = expected(rows)
    assert set(got) == set(want) and len(want) < len(rows) * 2 / 3
    for key, value in want.items():
        assert got[key][:5] == value[:5], key
        assert got[key][5] == pytest.approx(value[5])
