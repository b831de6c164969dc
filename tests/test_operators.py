"""Operators on small frames with the edge cases: nulls, ties, zeros, unseen values, committed figures."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.functions import blend, dates, scores
from gridcast.operators import blends, clean, compare, dashboard, features, forecast, importance, metrics, monitor, quality, slices
from gridcast.operators.forecast import fit_gbt, sequence_forecast
from gridcast.operators.ordered import number_rows, time_bucket
from gridcast.plans import inputs as I
from gridcast.plans.daily import attach, prepare, ridge, run_daily, sequence, trees, write_daily
from gridcast.plans.standalone import next_history, run_standalone, write_standalone
from gridcast.plans.tuning import tune
from gridcast.sources import history as hist
from gridcast.sources import tables, zones
from gridcast.streaming import streams

T = dt.datetime(2024, 1, 27, 12)
SF = "/root/testdata/sf0.001"


def one(df):
    return df.collect()[0]


def test_dates_parse_day_first_and_lenient(spark):
    texts = ["22/06/2026 00:30:00", "3/4/2024 5:06", "03/04/2024", "2024-04-03 05:06:00", "13/13/2024 00:00:00", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(dates.parse_for_date(F.col("t"))).collect()]
    d = dt.datetime
    assert got == [d(2026, 6, 22, 0, 30), d(2024, 4, 3, 5, 6), d(2024, 4, 3), d(2024, 4, 3, 5, 6), None, None, None]


def test_blends(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (None, None, None), (4.0, None, 8.0), (None, None, 5.0)],
                               "a double, b double, c double")
    w = {"a": 0.5, "b": 0.5, "c": 0.0}
    rows = df.select(blend.simple_average(["a", "b", "c"]), blend.strict_average(["a", "b", "c"]),
                     blend.weighted_average(w)).collect()
    assert [tuple(r) for r in rows] == [(1.5, None, 1.5), (None, None, None), (6.0, None, 4.0), (5.0, None, None)]


def test_metrics_masks_and_empty_zone(spark):
    rows = [("A", 10.0, 11.0), ("A", 0.0, 5.0), ("A", None, 5.0), ("A", 20.0, None), ("A", -4.0, -5.0), ("B", 0.5, 1.0)]
    df = spark.createDataFrame(rows, "zone string, actual double, p double")
    got = {r.zone: r for r in metrics.metrics_zone_model(df, {"m": "p"}).collect()}
    a = got["A"]
    assert a.MAPE == pytest.approx(17.5) and a.MAE == 1.0 and a.RMSE == 1.0 and a.BIAS == 0.0
    assert (a.n_rows_total, a.n_rows_scored, a.n_rows_excluded_zero_actual) == (5, 2, 1)
    assert got["B"].MAPE is None and got["B"].n_rows_scored == 0
    full = {r.zone: r for r in metrics.with_all_rows(metrics.metrics_zone_model(df, {"m": "p"})).collect()}
    assert full["ALL"].MAPE == pytest.approx(17.5) and full["ALL"].n_rows_total == 6


def test_all_row_agrees_with_published_run(spark):
    """Zone scores of one published run and the ALL rows published with them."""
    zone_rows = [
        ("CAC", 1.1028025389049942, 20), ("MAC", 4.2672, 20), ("NAC", 1.5967, 20), ("NEC", 3.6378, 20), ("SAC", 2.0626, 20),
    ]
    lstm = [("CAC", 4.5395, 15), ("MAC", 1.8857, 15), ("NAC", 9.5019, 15), ("NEC", 11.4648, 15), ("SAC", 4.3703, 15)]
    rows = [(z, "XGBoost", m, m, m, m, 288, n, 268) for z, m, n in zone_rows]
    rows += [(z, "LSTM", m, m, m, m, 288, n, 268) for z, m, n in lstm]
    df = spark.createDataFrame(rows, "zone string, model string, MAPE double, MAE double, RMSE double, BIAS double, "
                               "n_rows_total long, n_rows_scored long, n_rows_excluded_zero_actual long")
    got = {r.model: r for r in metrics.summary_all_weighted(df).collect()}
    assert got["XGBoost"].MAPE == pytest.approx(2.5334, abs=1e-4)
    assert got["LSTM"].MAPE == pytest.approx(6.3524, abs=1e-4)
    assert (got["LSTM"].n_rows_scored, got["LSTM"].n_rows_total) == (75, 1440)


def test_clean_order_of_drop_and_infinity(spark):
    rows = [(T, "1.5"), (T, "inf"), (T, "n/a"), (T, "NaN"), (None, "2")]
    df = spark.createDataFrame(rows, "for_date timestamp_ntz, requirement string")
    got = [r.requirement for r in clean.clean_rows(df, ["requirement"]).collect()]
    assert sorted(got, key=str) == [1.5, None]


def test_encode_unseen_null_and_sorted(spark):
    rows = [("A", "train", "b"), ("A", "train", "a"), ("A", "train", "aa"), ("A", "test", "z"), ("A", "test", None),
            ("B", "train", "b"), ("A", "test", "b")]
    df = spark.createDataFrame(rows, "zone string, split string, v string").withColumn("raw", F.col("v"))
    got = {(r.zone, r.split, r.raw): r.v for r in clean.encode_category(df, ["v"], fit=F.col("split") == "train").collect()}
    assert got == {("A", "train", "a"): 0, ("A", "train", "aa"): 1, ("A", "train", "b"): 2, ("A", "test", "z"): -1,
                   ("A", "test", None): -1, ("B", "train", "b"): 0, ("A", "test", "b"): 2}


def test_feature_selection(spark):
    df = spark.createDataFrame([("A", "train", T, 1.0, 1, None, 2.0, "x", True), ("A", "test", T, 1.0, None, 3, 2.0, "x", True)],
                               "zone string, split string, for_date timestamp_ntz, requirement double, a int, b int, "
                               "REQUIREMENT_LAG_1D double, t string, f boolean")
    names = clean.select_features(df.schema, df.schema)
    assert names == ["a", "b"]
    assert one(clean.bool_to_int(df)).f == 1


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([("A", "train", 3.0), ("A", "train", 3.0)], "zone string, split string, x double")
    fit = clean.minmax_fit(df, ["x"], F.col("split") == "train")
    back = clean.minmax_inverse(clean.minmax_scale(df, fit, {"x": "s"}), fit, {"s": ("x", "r")})
    assert [(r.s, r.r) for r in back.collect()] == [(0.0, 3.0)] * 2


def test_importance_of_constant_and_zero_total(spark):
    df = spark.createDataFrame([("A", 1.0, 5.0, 1.0), ("A", 2.0, 5.0, 2.0), ("B", 1.0, 1.0, 3.0), ("B", 1.0, 1.0, 4.0)],
                               "zone string, a double, k double, requirement double")
    table = importance.importance_pct(importance.corr_importance(df, ["a", "k"]))
    got = {(r.zone, r.feature): (r.importance, r.importance_pct) for r in table.collect()}
    assert got[("A", "a")] == (pytest.approx(1.0), pytest.approx(100.0))
    assert got[("A", "k")] == (0.0, 0.0) and got[("B", "a")] == (0.0, 0.0)


def test_slices(spark):
    rows = [("A", T, 0.0), ("A", T + dt.timedelta(days=1), 5.0), ("B", T, None), ("B", T - dt.timedelta(days=1), 2.0)]
    df = spark.createDataFrame(rows, "zone string, for_date timestamp_ntz, actual double")
    assert slices.today(df, "2024-01-27").count() == 2
    assert slices.yesterday(df, "2024-01-27").count() == 1
    assert slices.future(df).count() == 1
    assert slices.future_standalone(df, "2024-01-27").count() == 2
    assert {(r.zone, r.for_date) for r in slices.latest_per_zone(df).collect()} == {("A", T + dt.timedelta(days=1)), ("B", T)}
    assert slices.latest_global(df).count() == 1


def test_peak_takes_the_first_of_ties(spark):
    rows = [("A", T + dt.timedelta(minutes=30 * i), v) for i, v in enumerate([1.0, 9.0, None, 9.0])]
    df = spark.createDataFrame(rows, "zone string, for_date timestamp_ntz, v double")
    assert one(dashboard.peak_topk(df, "v")).peak_time == T + dt.timedelta(minutes=30)


HISTORY = "zone string, for_date timestamp_ntz, actual double, pred_ensemble double, run_timestamp string, run_date date"


def test_plan_uses_the_newest_earlier_run(spark):
    d = dt.date
    rows = [
        ("A", T, 0.0, 1.0, "20240125_060000", d(2024, 1, 25)), ("A", T, 0.0, 2.0, "20240126_060000", d(2024, 1, 26)),
        ("A", T, 0.0, 3.0, "20240126_180000", d(2024, 1, 26)), ("A", T, 0.0, 4.0, "20240127_060000", d(2024, 1, 27)),
        ("B", T - dt.timedelta(days=1), 0.0, 5.0, "20240126_060000", d(2024, 1, 26)),
        ("C", T, 0.0, 6.0, "20240127_060000", d(2024, 1, 27)),
    ]
    df = spark.createDataFrame(rows, HISTORY)
    got = {r.zone: tuple(r)[1:] for r in dashboard.plan_asof(df, "2024-01-27").collect()}
    assert got == {"A": (3.0, 3.0, "2024-01-26"), "B": (None, None, "2024-01-26")}
    whole = {r.zone: r.plan_total_mw for r in dashboard.plan_asof(df, "2024-01-27", whole_run_date=True).collect()}
    assert whole["A"] == 5.0


def test_bias_needs_rows_and_moves_only_future(spark):
    day = dt.timedelta(minutes=30)
    rows = [("A", T + day * i, 10.0, 12.0, "r", None) for i in range(24)] + [("B", T, 10.0, 12.0, "r", None)] * 23
    corr = monitor.bias_compute(spark.createDataFrame(rows, HISTORY))
    assert [tuple(r) for r in corr.collect()] == [("A", -2.0, 24)]
    df = spark.createDataFrame([("A", T, 0.0, 1.0, None), ("A", T, 5.0, 1.0, 1.0), ("B", T, 0.0, 1.0, 1.0), ("A", T, None, 1.0, 1.0)],
                               "zone string, for_date timestamp_ntz, actual double, pred_a double, pred_b double")
    got = sorted((tuple(r)[0], tuple(r)[2:]) for r in monitor.bias_apply(df, corr).na.fill(-9.0).collect())
    assert got == sorted([("A", (0.0, 0.0, -9.0)), ("A", (5.0, 1.0, 1.0)), ("B", (0.0, 1.0, 1.0)), ("A", (-9.0, 1.0, 1.0))])


def test_drift_reasons(spark):
    reg = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "zone string")
    rows = [("A", T, 7.126), ("B", T, 1.0), ("D", T, None), ("C", T - dt.timedelta(days=9), 50.0)]
    h = spark.createDataFrame(rows, "zone string, for_date timestamp_ntz, ape_ensemble double")
    now = F.lit("2024-01-28").cast("timestamp_ntz")
    got = {r.zone: (r.drift, r.reason) for r in monitor.drift_recent_mape(h, reg, now).collect()}
    assert got == {"A": (True, "MAPE 7.13% > threshold 5.0% over last 3 days"), "B": (False, "MAPE 1.00% OK"),
                   "C": (False, "insufficient recent data"), "D": (False, "MAPE nan% OK")}
    none = monitor.drift_recent_mape(h.where("false"), reg, now).collect()
    assert {r.reason for r in none} == {"no history"}


def test_drift_flags_and_alerts(spark):
    shift = spark.createDataFrame([("A", "z_score_vs_train", -2.5), ("B", "z_score_vs_train", 1.6),
                                   ("C", "z_score_vs_train", 1.49), ("D", "z_score_vs_train", None)],
                                  "zone string, metric string, value double")
    assert {(r.zone, r.severity) for r in monitor.drift_flags(shift).collect()} == {("A", "critical"), ("B", "warning")}
    met = spark.createDataFrame([("A", "Ensemble_XGB_LGBM", 3.1, 1.0), ("A", "Ensemble_XGB_LGBM_LSTM", 9.0, -2.0),
                                 ("ALL", "Ensemble_XGB_LGBM", 9.0, 1.0), ("B", "XGBoost", 9.0, 1.0),
                                 ("B", "Ensemble_XGB_LGBM", 3.0, 1.0), ("C", "Ensemble_XGB_LGBM", None, 1.0)],
                                "zone string, model string, MAPE double, BIAS double")
    got = sorted(r.message for r in monitor.mape_alerts(met).collect())
    assert got == ["A: the ensemble is off by 3.10% on average, above the limit of 3.0% (bias 1.0 MW)",
                   "A: the ensemble is off by 9.00% on average, above the limit of 3.0% (bias -2.0 MW)"]


def test_shift_in_prior_years_only(spark):
    def rows(split, year, values):
        return [("A", split, dt.datetime(year, 6, 1 + i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows("train", 2023, [10.0, 20.0]) + rows("train", 2024, [90.0]) + rows("test", 2024, [0.0, 40.0]),
                               "zone string, split string, for_date timestamp_ntz, requirement double")
    as_coded = {r.metric: r.value for r in monitor.shift_zscore(df).collect()}
    prior = {r.metric: r.value for r in monitor.shift_zscore(df, prior_years=True).collect()}
    assert as_coded["same_month_history_mean"] == 40.0 and prior["same_month_history_mean"] == 15.0
    assert as_coded["test_realized_n_rows"] == 1.0
    assert prior["z_score_vs_same_month_history"] == round(25 / 50 ** 0.5, 3)


def test_tied_config_keeps_its_zone(spark):
    met = spark.createDataFrame([("A", "org", "Ensemble", 2.0), ("A", "tuned", "Ensemble", 2.0), ("B", "org", "Ensemble", 1.0),
                                 ("B", "tuned", "Ensemble", 3.0), ("C", "org", "Ensemble", 1.0)],
                                "reg string, config string, model string, MAPE double").withColumns(
        {c: F.lit(0.0) for c in ("MAE", "BIAS")})
    comp = compare.config_compare(met)
    assert {(r.reg, r.winner, r.MAPE_diff) for r in comp.collect()} == {("A", "tie", 0.0), ("B", "org", -2.0)}
    pred = spark.createDataFrame([("A", "org"), ("A", "tuned"), ("B", "org"), ("B", "tuned")], "reg string, config string")
    assert {tuple(r) for r in compare.config_best(pred, comp).collect()} == {("A", "tuned"), ("B", "org")}


def test_weight_search_finds_the_mix(spark):
    rows = [("A", T + dt.timedelta(minutes=30 * i), 100.0 + i, 100.0 + i + 4, 100.0 + i - 6,
             None if i < 3 else 500.0) for i in range(60)]
    df = spark.createDataFrame(rows, "zone string, for_date timestamp_ntz, actual double, pred_a double, pred_b double, pred_c double")
    best = one(blends.weight_search(df, ["pred_a", "pred_b", "pred_c"]))
    assert (best.pred_a, best.pred_b, best.pred_c, best.n_rows_used) == (0.6, 0.4, 0.0, 60)
    assert blends.weight_search(df.limit(40), ["pred_a", "pred_b", "pred_c"]).count() == 0


def test_weights_fall_back(spark):
    default = {"a": 0.5, "b": 0.5}
    stored = spark.createDataFrame([({"a": 0.2, "b": 0.8}, "1"), ({"a": 0.1, "b": 0.9}, "2")],
                                   "weights map<string,double>, updated_at string")
    assert tuple(one(hist.weights_load(stored, default))) == (0.1, 0.9)
    assert tuple(one(hist.weights_load(stored.where("false"), default))) == (0.5, 0.5)
    other = spark.createDataFrame([({"a": 1.0}, "9")], "weights map<string,double>, updated_at string")
    assert tuple(one(hist.weights_load(stored.unionByName(other), default))) == (0.5, 0.5)


def test_history_folder_and_snapshot(spark, tmp_path):
    df = spark.createDataFrame([("A", T, 5.0, 6.0)], "zone string, for_date timestamp_ntz, actual double, pred_ensemble double")
    path = str(tmp_path / "history")
    schema = hist.tag_run(df, "20240126_060000").schema
    assert hist.read_history(spark, path, schema).count() == 0
    for ts in ("20240126_060000", "20240127_060000"):
        hist.history_append(df, path, ts)
    back = hist.read_history(spark, path, schema)
    assert back.count() == 2 and hist.history_latest(back).collect()[0].run_timestamp == "20240127_060000"
    assert hist.scored_history(back).count() == 2 and hist.scored_history(back, dedup="latest").count() == 1
    tables.snapshot_run(df, str(tmp_path), "x")
    with pytest.raises(Exception, match="(?i)exists"):
        tables.snapshot_run(df, str(tmp_path), "x")


def test_zone_files_from_a_registry(spark, tmp_path):
    root = tmp_path / "zone files + more"
    root.mkdir()
    (root / "A_train.csv").write_text("for_date,requirement,Temp_W\n01/02/2024 00:30:00,5,20\n")
    (root / "A_test.csv").write_text("requirement,Temp_W,for_date\n6,21,02/02/2024 00:30:00\n")
    spark.createDataFrame([("03/02/2024 00:30:00", "7")], "for_date string, requirement string").write.option("header", True).csv(
        str(root / "B_train"))
    paths = {"A": {"train": str(root / "A_train.csv"), "test": str(root / "A_test.csv")}, "B": {"train": f"{root}/B_train/"}}
    got = zones.parse_dates(zones.scan_zone_csv(spark, zones.zone_registry(spark, paths)))
    assert {(r.zone, r.split, r.for_date.day, r.requirement, r.Temp_W) for r in got.collect()} == {
        ("A", "train", 1, "5", "20"), ("A", "test", 2, "6", "21"), ("B", "train", 3, "7", None)}
    gone = zones.zone_registry(spark, {**paths, "C": {"train": str(root / "none.csv")}})
    with pytest.raises(FileNotFoundError, match="none.csv"):
        zones.scan_zone_csv(spark, gone)
    kept = zones.scan_zone_csv(spark, gone, missing="skip")
    assert kept.count() == 3 and [r.zone for r in zones.zones_failed(gone, kept).collect()] == ["C"]


def test_quality_counts_null_and_repeated_dates(spark):
    rows = [("A", "train", T, 0.0), ("A", "train", T, None), ("A", "train", None, 1.0), ("A", "train", None, 1.0)]
    df = spark.createDataFrame(rows, "zone string, split string, for_date timestamp_ntz, requirement double")
    got = {r.check: r.value for r in quality.diagnostics(df, ["x"]).collect()}
    assert (got["train_rows"], got["train_duplicate_dates"], got["train_missing_total"], got["test_rows"]) == (4, 2, 3, 0)
    v = one(quality.validate_split(df, ["requirement"], ["requirement"]))
    assert (v.n_rows, v.total_missing, v.duplicate_timestamps, v.zero_lag_rows, v.time_gaps_30min) == (4, 1, 2, 1, 0)


STREAM = "zone string, for_date string, requirement string"


def _deliver(spark, root, rows, files=1, per_batch=64, ingest=True):
    spark.createDataFrame(rows, STREAM).repartition(files).write.mode("append").option("header", True).csv(f"{root}/in")
    if ingest:
        streams.stream_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/cp", spark.createDataFrame([], STREAM).schema, per_batch)


def _series_rows(spark, root):
    return sorted((r.zone, r.for_date, r.requirement) for r in streams.read_series(spark, f"{root}/out").collect())


@pytest.mark.parametrize("files,per_batch", [(1, 1), (3, 1), (30, 64), (30, 4)])
def test_stream_loses_nothing_however_it_is_cut(spark, tmp_path, files, per_batch):
    rows = [("A", f"{d:02d}/01/2024 {h:02d}:00:00", str(d)) for d in range(1, 29) for h in range(0, 24, 6)]
    _deliver(spark, tmp_path, rows + [("A", "bad", "1"), ("B", None, "2")], files, per_batch)
    assert [(r[1].day, r[2]) for r in _series_rows(spark, tmp_path)] == [(d, float(d)) for d in range(1, 29) for _ in range(4)]
    assert sorted(str(r.for_date_text) for r in streams.read_rejects(spark, f"{tmp_path}/out").collect()) == ["None", "bad"]


def test_newest_delivery_of_a_slot_wins(spark, tmp_path):
    _deliver(spark, tmp_path, [("A", "10/01/2024 00:00:00", "0"), ("A", "10/01/2024 00:30:00", "0")])
    _deliver(spark, tmp_path, [("A", "10/01/2024 00:00:00", "900"), ("A", "01/01/2024 00:00:00", "3")])
    _deliver(spark, tmp_path, [("A", "10/01/2024 00:30:00", "950"), ("A", "11/01/2024 00:00:00", "n/a")])
    assert [(r[1].day, r[1].minute, r[2]) for r in _series_rows(spark, tmp_path)] == [
        (1, 0, 3.0), (10, 0, 900.0), (10, 30, 950.0), (11, 0, None)]


def test_streams_report_open_days(spark, tmp_path):
    p = spark.createDataFrame([("A", T + dt.timedelta(hours=h), 110.0 if h != 5 else None) for h in range(60)],
                              "zone string, for_date timestamp_ntz, pred double")
    a = p.select("zone", "for_date", F.lit(100.0).alias("actual"))
    a.write.parquet(f"{tmp_path}/in")
    live = spark.readStream.schema(a.schema).parquet(f"{tmp_path}/in")
    streams.stream_daily_mape(live, p, "pred", f"{tmp_path}/out", f"{tmp_path}/cp")
    streams.stream_daily_mape(live, p, "pred", f"{tmp_path}/out", f"{tmp_path}/cp")  # nothing new: nothing changes
    days = streams.read_daily_mape(spark, f"{tmp_path}/out").collect()
    assert sum(r.n_scored for r in days) == 59 and all(abs(r.daily_mape - 10) < 1e-9 for r in days)
    assert len(days) == len({(T + dt.timedelta(hours=h)).date() for h in range(60)})
    assert streams.read_daily_mape(spark, f"{tmp_path}/nothing").count() == 0


def _series(spark):
    return I.features(spark, SF)


def test_daily_run_writes_and_learns_from_history(spark, tmp_path):
    quick = {"pred_xgb": trees(maxIter=2, maxDepth=2), "pred_lgbm": ridge(), "pred_lstm": sequence(length=2)}
    h = I.history(spark, SF).withColumnsRenamed({"pred_m1": "pred_xgb", "pred_m2": "pred_lgbm", "pred_m3": "pred_lstm"})
    stored = spark.createDataFrame([], "weights map<string,double>, mape_at_optimum double, n_rows_used long, updated_at timestamp_ntz")
    now = F.lit(I.NOW).cast("timestamp_ntz")
    run = run_daily(_series(spark), I.holidays(spark), h, stored, "20240128_120000", I.RUN_DATE, now, quick)
    write_daily(run, str(tmp_path))
    p = spark.read.parquet(str(tmp_path / "predictions"))
    assert p.count() == 2 * 288
    assert p.where("pred_lstm IS NULL").groupBy("zone").count().collect()[0]["count"] == 1
    assert spark.read.parquet(str(tmp_path / "history")).where("run_date = DATE'2024-01-28'").count() == 2 * 288
    assert spark.read.parquet(str(tmp_path / "dashboard")).count() == 2
    m = spark.read.parquet(str(tmp_path / "metrics"))
    assert {r.model for r in m.where("zone = 'ALL'").collect()} == set(metrics.MODELS)


def test_standalone_run_compares_two_configs(spark):
    s = I.features(spark, SF)
    configs = {"org": {"pred_xgb": ridge(10.0), "pred_lgbm": ridge(1.0), "pred_lstm": sequence(2, carry=True)},
               "tuned": {"pred_xgb": ridge(0.1), "pred_lgbm": ridge(0.01), "pred_lstm": sequence(3, carry=True)}}
    reg = I.registry(spark, SF)
    run = run_standalone(s, reg, configs, "20240128_120000", I.RUN_DATE, F.lit(I.NOW).cast("timestamp_ntz"))
    assert run.predictions.count() == 2 * 2 * 288
    assert run.best.groupBy("reg").agg(F.countDistinct("config").alias("n")).where("n <> 1").count() == 0
    assert run.best.count() == 2 * 288
    items = {(r.item, r.zone) for r in run.manifest.collect()}
    assert ("zones_failed", "Z_EMPTY") in items and ("rows", "ALL") in items
    assert {r.reason for r in run.drift.collect()} == {"no history"}
    assert run.dashboard.count() == 2 and run.comparison.count() == 2 * 5
    first = next_history(None, run, "20240127_060000")
    assert next_history(first, run, "20240128_060000").where("run_timestamp = '20240128_060000'").count() == 2 * 288


def test_tuning_picks_a_penalty_per_zone(spark, tmp_path):
    best = tune(_series(spark), I.holidays(spark), [0.01, 1.0], str(tmp_path / "best"))
    assert best.count() == 2
    assert {r.n_trials for r in spark.read.parquet(str(tmp_path / "best")).collect()} == {2}


def test_row_scores(spark):
    df = spark.createDataFrame([(10.0, 12.0), (0.5, 1.0), (None, 1.0)], "actual double, p double")
    rows = scores.add_ape(df, ["p"]).collect()
    assert [r.ape_p for r in rows] == [20.0, None, None]
    e = scores.add_row_errors(df, {"t": "p"}).collect()
    assert (e[0].abs_error_t, e[0].bias_t, e[1].ape_t, e[2].ape_t) == (2.0, 2.0, 100.0, None)


def test_trees_share_one_fit_over_zones_of_any_size(spark):
    start = dt.datetime(2024, 1, 1)
    rows = []
    for zone, level in (("A", 10.0), ("B", 1000.0)):
        for i in range(400):
            split = "train" if i < 300 else "test"
            hour = i % 24
            rows.append((zone, split, start + dt.timedelta(hours=i), hour, level * (2.0 if 8 <= hour < 20 else 1.0)))
    df = spark.createDataFrame(rows, "zone string, split string, for_date timestamp_ntz, hour int, requirement double")
    fit = fit_gbt(df.where("split = 'train'"), ["hour"], maxIter=5, maxDepth=3)
    out = fit.predict(df.where("split = 'test'"))
    worst = out.select(F.max(F.abs(F.col("pred") / F.col("requirement") - 1))).collect()[0][0]
    assert worst < 0.05
    assert fit.importance(spark, "m").collect()[0].importance == 1.0


def test_sequence_warm_up(spark):
    rows = [("A", "train" if i < 40 else "test", T + dt.timedelta(minutes=30 * i), float(i % 5), float(i % 5))
            for i in range(60)]
    df = spark.createDataFrame(rows, "zone string, split string, for_date timestamp_ntz, x double, requirement double")
    own = sequence_forecast(df, ["x"], length=4, carry=False).where("split = 'test'")
    carried = sequence_forecast(df, ["x"], length=4, carry=True).where("split = 'test'")
    assert own.where("pred IS NULL").count() == 3 and carried.where("pred IS NULL").count() == 0
    assert own.count() == carried.count() == 20


def _wide(spark, n=400, k=44, zones=("A", "B", None)):
    r = np.random.default_rng(5)
    rows = []
    for z, zone in enumerate(zones):
        x = r.standard_normal((n, k)) * (1 + np.arange(k)) + 1000 * z
        x[:, 3:4] = 7.0
        y = x @ np.linspace(-1, 1, k) + r.standard_normal(n) + 1e6
        for i in range(n):
            rows.append((zone, "train" if i < n - 50 else "test", T + dt.timedelta(minutes=30 * i), float(y[i]), *map(float, x[i])))
    names = [f"f{i}" for i in range(k)]
    return spark.createDataFrame(rows, "zone string, split string, for_date timestamp_ntz, requirement double, "
                                 + ", ".join(f"{c} double" for c in names)), names


def test_ridge_on_many_features_agrees_with_numpy(spark):
    df, names = _wide(spark)
    got = forecast.zone_ridge(df.repartition(5), names, penalty=0.1).toPandas()
    assert len(got) == 1200
    for zone, part in got.groupby("zone"):
        train = part[part.split == "train"]
        x, y = train[names].to_numpy(), train.requirement.to_numpy()
        sd = x.std(axis=0)
        on = sd > 1e-9
        z = (x[:, on] - x[:, on].mean(axis=0)) / sd[on]
        beta = np.linalg.solve(z.T @ z / len(z) + 0.1 * np.eye(on.sum()), z.T @ (y - y.mean()) / len(z))
        want = y.mean() + (part[names].to_numpy()[:, on] - x[:, on].mean(axis=0)) / sd[on] @ beta
        assert np.abs(want - part.pred).max() < 1e-6
    assert got[got.zone.isna()].pred.isna().all()  # a null zone matches no model


def test_moments_merge_and_keep_null_keys(spark):
    df, names = _wide(spark, n=60, k=3)
    for r in forecast.moments(df.repartition(7), ["zone"], names).collect():
        x = df.where(F.col("zone").eqNullSafe(F.lit(r.zone))).select(*names).toPandas().to_numpy()
        m = forecast.Moments.read(r.moments, 3)
        assert m.n == 60 and np.allclose(m.mean, x.mean(axis=0)) and np.allclose(m.products, np.cov(x.T, bias=True) * 60)


def test_sequence_over_all_features_is_planned_quickly(spark):
    df, names = _wide(spark, n=300, zones=("A",))
    out = sequence_forecast(df, names, length=6, penalty=0.1).where("split = 'test'")
    assert out.where("pred IS NOT NULL").count() == 50


def test_a_zone_without_a_feature_still_gets_forecasts(spark):
    df, names = _wide(spark, k=4, zones=("A", "B"))
    df = df.withColumn("f1", F.when(F.col("zone") == "A", F.col("f1"))).withColumn("f2", F.when(F.col("split") == "train", F.col("f2")))
    kept = clean.zone_features(df, names)
    assert {(r.zone, r.feature) for r in kept.collect()} == {("A", "f0"), ("A", "f1"), ("A", "f3"), ("B", "f0"), ("B", "f3")}
    ready = clean.without_absent(clean.impute_train_median(df, names), kept, names)
    assert forecast.zone_ridge(ready, names).where("split = 'test' AND pred IS NULL").count() == 0


def test_repeated_stamps_keep_the_number_of_rows(spark):
    df, names = _wide(spark, n=80, k=2, zones=("A",))
    df = df.withColumnsRenamed({"f0": "REQUIREMENT_LAG_3D", "f1": "REQ_LAST168H"})
    twice = df.unionByName(df.where("split = 'test'").limit(5)).withColumn("tariff", F.lit("x"))
    table, found = prepare(twice, I.holidays(spark))
    assert "tariff" in found  # text features reach the models as codes
    preds = attach(table, {"a": ridge(), "b": ridge(1.0), "c": ridge(10.0)}, found)
    assert preds.count() == 55 and preds.where("a IS NULL").count() == 0


def test_row_numbers_keep_null_keys_and_unique_is_checked(spark):
    df = spark.createDataFrame([(None, T, 1.0), (None, T + dt.timedelta(hours=1), 2.0), ("A", T, 3.0)],
                               "zone string, for_date timestamp_ntz, requirement double")
    assert sorted(r._no for r in number_rows(df, ["zone"], ["for_date"], time_bucket("for_date"), "_no").collect()) == [1, 1, 2]
    assert features.add_clock_lags(df, {"l": 1}, unique=True).count() == 3
    with pytest.raises(Exception, match="unique"):
        features.add_clock_lags(df.unionByName(df), {"l": 1}, unique=True).collect()


def test_history_ties_are_decided(spark):
    rows = [("A", T, float(v), "20240126_060000") for v in (3, 1, 2)]
    df = spark.createDataFrame(rows, "zone string, for_date timestamp_ntz, actual double, run_timestamp string")
    assert one(hist.history_latest(df.repartition(3))).actual == 3.0


def test_standalone_runs_follow_each_other(spark, tmp_path):
    s, now = I.features(spark, SF), F.lit(I.NOW).cast("timestamp_ntz")
    configs = {"org": {"pred_xgb": ridge(1.0), "pred_lgbm": ridge(0.1), "pred_lstm": ridge(0.01)}}
    reg, history = I.registry(spark, SF), None
    for ts in ("20240127_060000", "20240128_060000"):
        run = run_standalone(s, reg, configs, ts, I.RUN_DATE, now, history)
        path = write_standalone(run, str(tmp_path), ts, history)
        history = spark.read.parquet(path)
        assert history.count() == 2 * 288 and history.where(F.col("run_timestamp") != ts).count() == 0
    assert {r.reason for r in spark.read.parquet(str(tmp_path / "drift")).collect()} != {"no history"}
    assert spark.read.parquet(str(tmp_path / "manifests")).select("run_ts").distinct().count() == 2
