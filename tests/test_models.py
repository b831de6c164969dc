"""Sequence regression without laid-out windows, forecasters as estimators, and successive halving."""

import datetime as dt
import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast import config as C
from gridcast.operators import cv, forecast, halving, models, sequence
from gridcast.operators.ordered import EQUAL, with_bucket
from gridcast.plans import registry

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "zone string, split string, for_date timestamp_ntz, requirement double, a double, b double"


def rows(n=400, seed=1, nulls=True, offset=0.0):
    r, out = random.Random(seed), []
    for z in "AB":
        y = 50.0
        for i in range(n):
            a, b = offset + r.gauss(0, 3), r.gauss(5, 1)
            y = 0.7 * y + 15 + 0.8 * (a - offset) + b + r.gauss(0, 0.3)
            out.append((z, "train" if i < n * 0.8 else "test", T0 + dt.timedelta(minutes=30 * i), y, None if nulls and r.random() < 0.03 else a, b))
    return out


@pytest.fixture(scope="module")
def series(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(6).cache()


def close(got, want, keys=("zone", "for_date"), column="pred", rel=1e-9):
    g, w = ({tuple(r[k] for k in keys): r[column] for r in x.collect()} for x in (got, want))
    assert g.keys() == w.keys() and {k for k, v in g.items() if v is None} == {k for k, v in w.items() if v is None}
    assert all(v is None or v == pytest.approx(w[k], rel=rel, abs=1e-8) for k, v in g.items())
    return g


@pytest.mark.parametrize("carry", [True, False])
@pytest.mark.parametrize("length", [1, 6])
def test_equal_to_laid_out_windows(spark, series, carry, length):
    args = dict(features=["requirement", "a", "b"], length=length, carry=carry, penalty=1e-3)
    got = close(sequence.sequence_ridge(series, seconds=20 * 3600, **args), forecast.sequence_forecast(series, **args))
    assert sum(v is not None for v in got.values()) > 300


def test_gram_is_that_of_the_windows():
    x = np.random.default_rng(1).normal(size=(30, 3))
    for first, last, length in [(0, 0, 1), (2, 20, 4), (5, 5, 6), (0, 24, 6)]:
        flat = np.array([x[t:t + length].ravel() for t in range(first, last + 1)])
        assert np.allclose(sequence.window_gram(x, first, last, length), flat.T @ flat)


@pytest.mark.parametrize("make", [
    lambda: models.RidgeForecaster(features=["a", "b"], penalty=0.1),
    lambda: models.SequenceForecaster(features=["requirement", "b"], length=3),
    lambda: models.NaiveForecaster(hours=24),
    lambda: models.TreeForecaster(features=["a", "b"], trees=2, depth=2)])
def test_fit_save_load_predict(spark, series, tmp_path, make):
    estimator = make()
    estimator.write().save(str(tmp_path / "estimator"))
    estimator = type(estimator).load(str(tmp_path / "estimator"))
    model = estimator.fit(series)
    model.write().save(str(tmp_path / "model"))
    again = type(model).load(str(tmp_path / "model"))
    assert again.uid == model.uid and again.get("features") == model.get("features")
    got = close(again.transform(series), model.transform(series), rel=0)
    assert any(v is not None for v in got.values())
    weights = again.featureImportances().groupBy("zone").agg(F.sum("importance").alias("s")).collect()
    assert all(r.s == pytest.approx(1) for r in weights) and (len(weights) == 2 or isinstance(model, models.NaiveModel))


def test_estimators_equal_the_functions(series):
    model = models.RidgeForecaster(features=["a", "b"], penalty=0.1).fit(series)
    close(model.transform(series), forecast.zone_ridge(series, ["a", "b"], penalty=0.1))


def test_halving_finds_the_winner_of_the_full_search(spark, series):
    train = series.where("split = 'train'")
    trials = [{"penalty": p} for p in (1e-3, 1.0, 30.0, 1e4)]
    best, ledger = halving.halving_search(train, models.RidgeForecaster(), ["a", "b"], trials, folds=4)
    full = halving.full_search(train, models.RidgeForecaster(), ["a", "b"], trials, folds=4)
    assert {(r.zone, r.trial, round(r.best_cv_mape, 9)) for r in best.collect()} == {(r.zone, r.trial, round(r.best_cv_mape, 9)) for r in full.collect()}
    assert best.collect()[0].n_fits < full.collect()[0].n_fits == 16
    seen = ledger.collect()
    for z in "AB":
        counts = [sum(r.zone == z and r.rung == k for r in seen) for k in range(3)]
        assert counts == [4, 2, 1] and [{r.folds for r in seen if r.rung == k} for k in range(3)] == [{1}, {2}, {4}]


def test_trees_are_tuned_per_zone(series):
    best, ledger = halving.halving_search(series.where("split = 'train'"), models.TreeForecaster(step=0.3), ["a", "b"],
                                          [{"trees": 1, "depth": 1}, {"trees": 3, "depth": 3}], folds=2)
    assert {r.zone: r.trial for r in best.collect()} == {"A": 1, "B": 1} and ledger.count() == 6


def test_cv_mape_does_not_mind_an_offset(spark):
    df = spark.createDataFrame(rows(nulls=False), SCHEMA)
    plain = {r.zone: r.cv_mape for r in cv.cv_mape(df, "a").collect()}
    moved = {r.zone: r.cv_mape for r in cv.cv_mape(df.withColumn("a", F.col("a") + 1e9), "a").collect()}
    assert plain.keys() == moved.keys() and all(moved[z] == pytest.approx(m, abs=1e-5) for z, m in plain.items())
    line = df.withColumn("requirement", 3 * F.col("b") + 7).withColumn("b", F.col("b") + 2.0**30)
    assert all(r.cv_mape < 1e-5 and r.n_folds == 5 for r in cv.cv_mape(line, "b").collect())


def test_equal_buckets_hold_about_as_many_rows(spark):
    """One dense day and a third of null dates."""
    df = spark.range(30_000).select(F.lit("A").alias("zone"), F.when(F.col("id") % 3 > 0, F.lit(T0).cast("timestamp_ntz") + F.expr(
        "make_dt_interval(CASE WHEN id % 3 = 1 THEN 0 ELSE id DIV 300 END, 0, 0, id % 86400)")).alias("for_date"), "id")
    sizes = sorted(r["count"] for r in with_bucket(df, ["zone"], ["for_date"], EQUAL, [F.col("id")]).groupBy("_bucket").count().collect())
    assert len(sizes) > 4 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_tree_settings_share_their_rows(spark, series, monkeypatch):
    """Settings fitted together scale the rows once, and give what each gives alone."""
    made, real = [], forecast.GbtRows
    monkeypatch.setattr(forecast, "GbtRows", lambda *a: made.append(1) or real(*a))
    base = models.TreeForecaster(features=["a", "b"], trees=2, step=0.3)
    maps = [{base.depth: 2}, {base.depth: 3}, {base.depth: 2, base.target: "a"}]
    rows = series.orderBy("zone", "for_date").coalesce(1).localCheckpoint()
    together = base.fit(rows, maps[:2])
    assert len(made) == 1
    said = lambda m: sorted(map(str, m.transform(rows).collect()))
    assert [said(m) for m in together] == [said(base.fit(rows, x)) for x in maps[:2]]
    made.clear()
    assert said(base.fit(rows, maps)[2]) == said(base.fit(rows, maps[2])) and len(made) == 4


def test_the_registered_search_grows_all_trees(spark, series, monkeypatch):
    """Its settings leave the number of trees alone, so that must be the full one."""
    asked = []
    monkeypatch.setattr(registry, "_complete_train", lambda *a: series)
    monkeypatch.setattr(registry.halving, "halving_search", lambda df, estimator, names, trials, **kw: asked.append((estimator, trials)) or (df, df))
    registry.QUERIES["param_search_trees"](spark, "unread")
    (estimator, trials), = asked
    assert estimator.get("trees") == C.TREES_MODULAR["maxIter"] and all("trees" not in t for t in trials)


def test_tree_settings_are_fitted_side_by_side(series, monkeypatch):
    """Settings overlap, no more than so many at once, and come back in their order."""
    at, most, lock, real = [0], [0], threading.Lock(), forecast.GbtRows.fit

    def fit(self, *a):
        with lock:
            at[0] += 1
            most[0] = max(most[0], at[0])
        try:
            return real(self, *a)
        finally:
            with lock:
                at[0] -= 1

    monkeypatch.setattr(forecast.GbtRows, "fit", fit)
    base = models.TreeForecaster(features=["a", "b"], trees=2)
    made = base.fit(series, [{base.depth: d} for d in (3, 1, 2, 1, 3, 2)])
    assert [m.trees.trees[0].depth for m in made] == [3, 1, 2, 1, 3, 2] and 1 < most[0] <= models.SIDE_BY_SIDE
