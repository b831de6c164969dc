"""Bucketed windows, fills, numbering and medians against pandas, with a zone that holds most rows."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcast.operators import clean, cv, features, forecast, ordered, quality
from gridcast.operators.exact import exact_median
from gridcast.operators.ordered import drop_halo, local_window, number_rows, time_bucket, with_halo

SCHEMA = "zone string, for_date timestamp_ntz, id long, x double"
ORDER = ("for_date", "id")


def series(seed, n=400, nulls=True):
    """Irregular stamps with repeats, long gaps and null dates; zone A holds two thirds."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        zone = rng.choice("AAAABC")
        day = rng.choice([0, 1, 2, 3, 9, 40, 41, 90])
        date = dt.datetime(2024, 1, 1) + dt.timedelta(days=day, minutes=30 * rng.randrange(20))
        if nulls and rng.random() < 0.03:
            date = None
        x = rng.choice([None, 0.0, 0.0, float(rng.randrange(1, 50))])
        rows.append((zone, date, i, x))
    rows.append(("lone", dt.datetime(2024, 5, 5), n, 7.0))
    rows.append(("zeros", dt.datetime(2024, 5, 5), n + 1, 0.0))
    rows.append(("zeros", dt.datetime(2024, 5, 9), n + 2, 0.0))
    return rows


def frame(rows):
    return pd.DataFrame(rows, columns=["zone", "for_date", "id", "x"]).sort_values(
        ["zone", "for_date", "id"], na_position="last")


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("seconds", [3600, 86400, 30 * 86400])
def test_row_halo_equals_plain_window(spark, seed, seconds):
    df = spark.createDataFrame(series(seed), SCHEMA).repartition(7)
    for before, after in [(1, 0), (5, 0), (7, 3)]:
        rows = with_halo(df, ["zone"], ORDER, before=before, after=after, seconds=seconds)
        cols = ["zone", "id"]
        w = local_window(["zone"], ORDER).rowsBetween(-before, after)
        got = drop_halo(rows.withColumn("ids", F.collect_list("id").over(w))).select(*cols, "ids")
        plain = Window.partitionBy("zone").orderBy(
            F.col("for_date").asc_nulls_last(), "id").rowsBetween(-before, after)
        want = df.withColumn("ids", F.collect_list("id").over(plain)).select(*cols, "ids")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_grid_halo_equals_row_halo(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(z, start + dt.timedelta(minutes=30 * i), i, float(i % 17) + k)
            for k, z in enumerate("AB") for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    args = {"column": "x", "keys": ["zone"], "order": ["for_date"]}
    a = features.add_rolling(df, grid=True, **args)
    b = features.add_rolling(df, grid=False, **args)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rolling_matches_pandas(spark):
    rows = [r for r in series(3, nulls=False)]
    got = features.add_rolling(
        spark.createDataFrame(rows, SCHEMA), "x", ["zone"], ORDER, seconds=86400).toPandas().set_index("id")
    for _, g in frame(rows).groupby("zone"):
        x = g.set_index("id").x
        want = {
            "x_roll_mean_3": x.rolling(3, min_periods=1).mean(),
            "x_roll_mean_6": x.rolling(6, min_periods=1).mean(),
            "x_roll_std_6": x.rolling(6, min_periods=1).std().fillna(0),
            "x_diff_1": x.diff().fillna(0),
            "x_pct_change_1": x.pct_change(fill_method=None).replace([np.inf, -np.inf], 0).fillna(0),
        }
        for name, w in want.items():
            np.testing.assert_allclose(got.loc[x.index, name].astype(float), w, atol=1e-9, err_msg=name)


@pytest.mark.parametrize("seconds", [3600, 7 * 86400])
def test_fill_matches_pandas(spark, seconds):
    rows = series(4)
    df = spark.createDataFrame(rows, SCHEMA)
    got = clean.fill_zero_target(df, ["zone"], "x", ORDER, seconds).toPandas().set_index("id").x
    for zone, g in frame(rows).groupby("zone"):
        want = g.set_index("id").x.replace(0, np.nan).ffill().bfill()
        np.testing.assert_array_equal(got.loc[want.index].astype(float), want, err_msg=zone)


def test_numbering_matches_pandas(spark):
    rows = series(5)
    df = spark.createDataFrame(rows, SCHEMA)
    got = number_rows(df, ["zone"], ORDER, time_bucket("for_date", 86400), "no", "n").toPandas().set_index("id")
    want = frame(rows)
    want["no"] = want.groupby("zone").cumcount() + 1
    assert got.no.to_dict() == want.set_index("id").no.to_dict()
    assert (got.n == got.zone.map(want.zone.value_counts())).all()


@pytest.mark.parametrize("sketch", [None, 2])
def test_median_is_exact(spark, monkeypatch, sketch):
    """Also with a sketch so coarse that the bracket is useless."""
    if sketch:
        monkeypatch.setattr("gridcast.operators.exact._SKETCH", 8)
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"zone": rng.choice(list("AAAB"), 5000), "a": rng.normal(size=5000),
                        "b": rng.integers(0, 4, 5000).astype(float)})
    pdf.loc[rng.random(5000) < 0.2, "a"] = np.nan
    pdf = pd.concat([pdf, pd.DataFrame({"zone": ["C", "D", "D"], "a": [np.nan, 1.0, 4.0], "b": [5.0, 1.0, 1.0]})])
    df = spark.createDataFrame(pdf).withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in "ab"})
    got = exact_median(df, ["zone"], ["a", "b"]).toPandas().set_index("zone").sort_index()
    want = pdf.groupby("zone")[["a", "b"]].median()
    np.testing.assert_allclose(got[["a", "b"]].astype(float), want, atol=0)


def test_timegaps(spark):
    rows = series(7)
    got = dict(map(tuple, quality.timegap_count(
        spark.createDataFrame(rows, SCHEMA), ["zone"], seconds=86400).collect()))
    for zone, g in frame(rows).groupby("zone"):
        d = g.for_date.dropna().diff().dropna()
        assert got[zone] == int((d > pd.Timedelta("45min")).sum())


def test_sequences_keep_null_features(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("A", start + dt.timedelta(minutes=30 * i), i, None if i == 3 else float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    seq = {r.id: r.seq for r in features.add_sequences(df, ["x", "id"], 4, False, ["zone"], seconds=3600).collect()}
    assert seq[3] is None
    assert seq[5] == [[1.0, 1.0], [2.0, 2.0], [None, 3.0], [4.0, 4.0]]
    cur = {r.id: r.seq for r in features.add_sequences(df, ["x"], 4, True, ["zone"], seconds=3600).collect()}
    assert cur[2] is None and cur[3] == [[0.0], [1.0], [2.0], [None]]


def test_clock_lags_skip_gaps_and_keep_repeats(spark):
    t = dt.datetime(2024, 1, 1)
    h = dt.timedelta(hours=1)
    rows = [("A", t, 0, 1.0), ("A", t + 24 * h, 1, 2.0), ("A", t + 24 * h, 2, 2.0), ("A", t + 72 * h, 3, 4.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: (r.d1, r.d2) for r in features.add_clock_lags(df, {"d1": 24, "d2": 48}, "x").collect()}
    assert got == {0: (None, None), 1: (1.0, None), 2: (1.0, None), 3: (None, 2.0)}
    unique = df.where("id <> 2")
    a = features.add_clock_lags(unique, {"d1": 24, "d2": 48}, "x")
    b = features.add_clock_lags(unique, {"d1": 24, "d2": 48}, "x", unique=True)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_densify(spark):
    t = dt.datetime(2024, 1, 1, 23, 0)
    rows = [("A", t, 0, 1.0), ("A", t + dt.timedelta(hours=26), 1, 2.0), ("B", t, 2, 3.0)]
    got = features.densify_grid(spark.createDataFrame(rows, SCHEMA), {"x": None, "id": None}).collect()
    a = sorted(r.for_date for r in got if r.zone == "A")
    assert a == [t + dt.timedelta(minutes=30 * i) for i in range(53)]
    assert sum(r.x is not None for r in got) == 3 and len(got) == 54


def test_folds_match_expanding_split(spark):
    for n in (3, 6, 23, 64):
        start = dt.datetime(2024, 1, 1)
        rows = [("A", start + dt.timedelta(hours=5 * i), i, float(i)) for i in range(n)]
        got = cv.cv_folds(spark.createDataFrame(rows, SCHEMA), seconds=86400).collect()
        size = n // 6
        for k in range(5):
            lo = n - (5 - k) * size
            val = sorted(r.id for r in got if r.fold == k + 1 and r.role == "validation")
            train = sorted(r.id for r in got if r.fold == k + 1 and r.role == "train")
            assert val == list(range(lo, lo + size))
            assert train == list(range(lo))


def test_cv_without_scored_rows_is_infinite(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("A", start + dt.timedelta(hours=i), i, 0.5) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("x", "requirement")
    assert cv.cv_mape(df, "id").collect()[0].cv_mape == float("inf")


def test_ridge_recovers_a_plane_and_survives_constant_features(spark):
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=300), rng.normal(size=300)
    pdf = pd.DataFrame({"zone": ["A"] * 300, "split": ["train"] * 200 + ["test"] * 100, "a": a, "b": b,
                        "c": 1.0, "requirement": 5 + 2 * a - 3 * b})
    out = forecast.zone_ridge(spark.createDataFrame(pdf), ["a", "b", "c"], penalty=0.0).toPandas()
    np.testing.assert_allclose(out.pred, out.requirement, atol=1e-5)


@pytest.mark.parametrize("seconds", [86400, ordered.EQUAL])
def test_fill_does_not_depend_on_how_rows_arrive(spark, seconds):
    """Repeated stamps and many null dates: known values of a stamp fill its placeholders."""
    rows = [("A", "train", dt.datetime(2024, 1, 1 + i % 3) if i % 5 else None, float(i % 4 * 5)) for i in range(60)]
    rows += [("B", "train", dt.datetime(2024, 1, 1), v) for v in (0.0, 9.0, 5.0)] + [("C", "train", None, 0.0), ("C", "train", dt.datetime(2024, 1, 2), 4.0)]
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "zone string, split string, for_date timestamp_ntz, requirement double").repartition(seed + 2)
        out = clean.fill_zero_target(df, seconds=seconds).collect()
        found.add(tuple(sorted((r.zone, str(r.for_date), r.requirement) for r in out)))
    assert len(found) == 1
    got = found.pop()
    assert [r[2] for r in got if r[0] == "B"] == [5.0, 9.0, 9.0] and [r[2] for r in got if r[0] == "C"] == [4.0, 4.0]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_buckets_change_no_window(spark, seed):
    df = spark.createDataFrame(series(seed), SCHEMA).repartition(7)
    for a, b in [(features.add_rolling(df, "x", ["zone"], ORDER, seconds=s) for s in (86400, ordered.EQUAL)),
                 (cv.cv_folds(df, ["zone"], order=ORDER, seconds=s) for s in (86400, ordered.EQUAL))]:
        key = lambda r: tuple(str(round(v, 9)) if isinstance(v, float) else str(v) for v in r)
        assert sorted(map(key, a.collect())) == sorted(map(key, b.select(a.columns).collect()))
