"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions import blend, dates, scores
from gridcast.operators import (
    asof, blends, clean, compare, cv, dashboard, features, forecast, halving, importance, metrics, models, monitor, ordered, quality,
    sequence, slices,
)
from gridcast.plans import inputs as I
from gridcast.session import listing, materialize, shared_dir
from gridcast.sources import history as hist
from gridcast.sources import tables, zones
from gridcast.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = ("zone", "for_date")
LAGS = ("REQUIREMENT_LAG_3D", "REQ_LAST168H", "REQ_LAST336H", "REQ_LAST504H", "REQ_LAST672H")
IMPUTED = ("REQUIREMENT_LAG_1D", "REQUIREMENT_LAG_3D", "REQ_LAST168H", "REQ_LAST336H")
PAIR = ("REQ_LAST168H", "REQ_LAST336H")
CONFIG_MODELS = {"Ensemble": "pred"}
STANDALONE = {"M1": "pred_m1", "M2": "pred_m2", "M3": "pred_m3", "Ensemble": "pred_ensemble"}
TAGS = {"m1": "pred_m1", "m2": "pred_m2", "m3": "pred_m3", "ensemble": "pred_ensemble"}
TOKEN = "Ensemble_M1_M2"
PENALTIES = (0.001, 0.1, 1.0)
HALF_HOUR, DAY = 1800, 86400  # bucket widths: the finer one keeps buckets of single events small


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def r6(df: DataFrame, *columns: str) -> DataFrame:
    """Round to six places: sums of inexact doubles depend on their order."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def now() -> Column:
    return dates.timestamp(I.NOW)


# Sources and sinks

def _write_files(df, root):
    """One file per zone; returns (zone, path) of all files in the zones' folders."""
    df.repartition("zone").write.mode("append").partitionBy("zone").option("header", True).csv(root)
    with listing(df.sparkSession):
        listed = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(root).select("path")
    return listed.select(F.regexp_extract("path", "zone=([^/]*)", 1).alias("zone"), "path")


@query
def scan_zone_csv(spark, sf):
    """Train and test files side by side, in a folder with a blank, with their columns in another order."""
    root = f"{shared_dir(spark)}/zone files"
    raw = materialize(I.raw_series(spark, sf))
    train = materialize(_write_files(raw.where("split = 'train'").select("zone", "for_date", "requirement", "flag"), root))
    both = _write_files(raw.where("split = 'test'").select("zone", "flag", "requirement", "for_date"), root)
    test = both.join(train, "path", "left_anti").select("zone", "path")
    registry = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return zones.scan_zone_csv(spark, registry)


@query
def parse_for_date(spark, sf):
    raw = I.raw_series(spark, sf).withColumnRenamed("for_date", "for_date_str")
    return raw.select("zone", "split", "for_date_str", dates.parse_for_date(F.col("for_date_str")).alias("for_date"))


@query
def sort_series(spark, sf):
    return zones.sort_series(zones.parse_dates(I.raw_series(spark, sf)).select("zone", "for_date", "requirement"),
                             "for_date", "zone")


@query
def write_table(spark, sf):
    path = shared_dir(spark)
    tables.write_table(I.predictions(spark, sf), path)
    return spark.read.parquet(path)


@query
def snapshot_run(spark, sf):
    root = shared_dir(spark)
    tables.snapshot_run(I.predictions(spark, sf), root, I.RUNS[0][0])
    return spark.read.parquet(root)


@query
def history_append(spark, sf):
    path = shared_dir(spark)
    runs = I.history(spark, sf).drop("run_date")
    for run_ts, _, _ in I.RUNS:
        hist.history_append(runs.where(F.col("run_timestamp") == run_ts).drop("run_timestamp"), path, run_ts)
    return spark.read.parquet(path)


@query
def history_latest(spark, sf):
    return hist.history_latest(I.history(spark, sf))


@query
def scored_history(spark, sf):
    return hist.scored_history(I.history(spark, sf))


def _stored_weights(spark, sf):
    per_run = blends.inverse_mape_weights(hist.scored_history(I.history(spark, sf)), ["pred_m1", "pred_m2"],
                                          "run_timestamp")
    return per_run.select(
        F.create_map(F.lit("pred_m1"), "w_pred_m1", F.lit("pred_m2"), "w_pred_m2").alias("weights"),
        F.col("run_timestamp").alias("updated_at"))


@query
def weights_load(spark, sf):
    return r6(hist.weights_load(_stored_weights(spark, sf), {"pred_m1": 0.5, "pred_m2": 0.5}), "pred_m1", "pred_m2")


@query
def adapt_log(spark, sf):
    history, scored = I.history(spark, sf), metrics.metrics_zone_model(I.blended(spark, sf), I.MODELS)
    log = hist.adapt_log(
        monitor.bias_events(monitor.bias_compute(history), now()),
        monitor.alert_events(monitor.mape_alerts(scored, token=TOKEN), now()),
        monitor.drift_events(_flags(spark, sf), now()),
        monitor.weight_events(weight_search(spark, sf), {"pred_m1": "m1", "pred_m2": "m2", "pred_m3": "m3"}, now()))
    return r6(log, "value")


@query
def run_manifest(spark, sf):
    return hist.run_manifest(I.RUNS[-1][0], I.registry(spark, sf), I.predictions(spark, sf),
                             drift_recent_mape(spark, sf))


# Projections, filters, predicates

@query
def is_realized(spark, sf):
    return I.predictions(spark, sf).select(*KEY, "actual", scores.is_realized(F.col("actual")).alias("is_realized"))


@query
def filter_today(spark, sf):
    return slices.today(I.predictions(spark, sf), I.RUN_DATE)


@query
def filter_yesterday(spark, sf):
    return slices.yesterday(I.predictions(spark, sf), I.RUN_DATE)


@query
def filter_future(spark, sf):
    return slices.future(I.predictions(spark, sf))


@query
def filter_future_v4(spark, sf):
    return slices.future_standalone(I.standalone(spark, sf).drop("pred_ensemble"), I.RUN_DATE)


@query
def latest_per_zone(spark, sf):
    return slices.latest_per_zone(I.readings(spark, sf))


@query
def latest_global(spark, sf):
    return slices.latest_global(I.readings(spark, sf))


@query
def select_features(spark, sf):
    f = I.features(spark, sf).withColumn("reg", F.col("zone"))
    return f.select(*KEY, *clean.select_features(f.schema, f.schema))


@query
def drop_all_null_cols(spark, sf):
    """Kept features per zone; the first zone has no value of one lag, the four-week lag only reaches the test split."""
    f = I.features(spark, sf, *LAGS)
    lag = F.when(F.col("zone") != "Z0000000", F.col("REQUIREMENT_LAG_3D"))
    return clean.zone_features(f.withColumn("REQUIREMENT_LAG_3D", lag), LAGS)


@query
def bool_to_int(spark, sf):
    return clean.bool_to_int(I.raw_series(spark, sf))


def _parsed(spark, sf):
    return zones.parse_dates(I.raw_series(spark, sf))


@query
def clean_rows(spark, sf):
    return clean.clean_rows(_parsed(spark, sf), ["requirement"])


@query
def rename_tag_cols(spark, sf):
    return clean.rename_tag(I.predictions(spark, sf), {"zone": "reg"}, {"config": "tuned"})


# Cleaning and imputation

@query
def fill_zero_target(spark, sf):
    return clean.fill_zero_target(I.masked(spark, sf))


@query
def fill_readings(spark, sf):
    """Single events in buckets of equal size; every third one is a placeholder, and stamps may repeat."""
    r = I.readings(spark, sf).withColumn("requirement", F.when(F.col("event_id") % 3 == 0, 0.0).otherwise(F.col("requirement")))
    return clean.fill_zero_target(r, ["zone"], seconds=ordered.EQUAL)


@query
def fill_zero_lag(spark, sf):
    f = I.features(spark, sf, "REQUIREMENT_LAG_3D", "REQ_LAST168H")
    return clean.fill_zero_lag(f).select(*KEY, "REQUIREMENT_LAG_3D", "REQ_LAST168H")


@query
def impute_train_median(spark, sf):
    return clean.impute_train_median(materialize(I.features(spark, sf, *IMPUTED)), IMPUTED)


@query
def impute_split_median(spark, sf):
    return clean.impute_split_median(materialize(I.features(spark, sf, *IMPUTED)), IMPUTED)


@query
def densify_grid(spark, sf):
    sums = I.events(spark, sf).groupBy(I.feeder().alias("zone"), I.slot("ts").alias("for_date")).agg(
        I.exact64(F.sum("value")).alias("requirement"))
    return features.densify_grid(sums, {"requirement": None})


@query
def lag_hours(spark, sf):
    return I.features(spark, sf).drop("split")


# Window features

def _rolled(spark, sf, name):
    rolled = features.add_rolling(I.readings(spark, sf), "requirement", ["zone"], ["for_date", "event_id"],
                                  seconds=HALF_HOUR)
    return rolled.select("zone", "event_id", F.round(f"requirement_{name}", 6).alias(name))


@query
def roll_mean_3(spark, sf):
    return _rolled(spark, sf, "roll_mean_3")


@query
def roll_mean_6(spark, sf):
    return _rolled(spark, sf, "roll_mean_6")


@query
def roll_std_6(spark, sf):
    return _rolled(spark, sf, "roll_std_6")


@query
def diff_1(spark, sf):
    return _rolled(spark, sf, "diff_1")


@query
def pct_change_1(spark, sf):
    return _rolled(spark, sf, "pct_change_1")


@query
def rolling_on_grid(spark, sf):
    f = I.features(spark, sf, "REQ_LAST168H")
    out = features.add_rolling(f, grid=True).drop("requirement")
    return r6(out, *[c for c in out.columns if c.startswith("REQ_LAST168H_")])


@query
def pre_post_holiday(spark, sf):
    return features.add_holidays(I.masked(spark, sf), I.holidays(spark), grid=True).select(
        *KEY, "is_holiday", "is_pre_holiday", "is_post_holiday")


@query
def pre_post_holiday_day(spark, sf):
    return features.add_holidays(I.readings(spark, sf), I.holidays(spark), by_day=True).select(
        "event_id", "is_holiday", "is_pre_holiday", "is_post_holiday")


@query
def timegap_count(spark, sf):
    return quality.timegap_count(I.readings(spark, sf), ["zone"], seconds=HALF_HOUR)


@query
def importance_rank(spark, sf):
    return r6(importance.importance_rank(_importance(spark, sf)), "importance")


def _steps(df, length, *keep):
    return df.select(*KEY, *keep, *[F.col("seq")[i][0].alias(f"x{i + 1}") for i in range(length)])


@query
def seq_windows_fit(spark, sf):
    train = I.masked(spark, sf).where(F.col("split") == "train")
    return _steps(features.sequences_fit(train, ["requirement"], 6, grid=True), 6, "requirement")


@query
def seq_windows_predict(spark, sf):
    test = I.masked(spark, sf).where(F.col("split") == "test")
    return _steps(features.sequences_predict(test, ["requirement"], 6, grid=True), 6)


@query
def seq_windows_carry(spark, sf):
    return _steps(features.sequences_carry(I.masked(spark, sf), ["requirement"], 6, grid=True), 6)


@query
def seq_windows_rows(spark, sf):
    seq = features.add_sequences(I.readings(spark, sf), ["requirement"], 6, True, ["zone"],
                                 ["for_date", "event_id"], seconds=HALF_HOUR)
    return seq.select("zone", "event_id", *[F.col("seq")[i][0].alias(f"x{i + 1}") for i in range(6)])


# Scalar features

@query
def basic_time_features(spark, sf):
    return dates.add_basic_time_features(I.readings(spark, sf)).drop("requirement")


@query
def calendar_features(spark, sf):
    return dates.add_calendar_features(I.readings(spark, sf)).drop("requirement")


@query
def is_holiday(spark, sf):
    return features.add_is_holiday(I.readings(spark, sf), I.holidays(spark)).drop("requirement")


@query
def encode_category(spark, sf):
    coded = clean.encode_category(I.orders(spark, sf), ["o_orderpriority", "o_orderstatus"],
                                  fit=F.col("split") == "train")
    return coded.select("zone", "o_orderkey", "o_orderpriority", "o_orderstatus")


@query
def minmax_scale(spark, sf):
    f = I.features(spark, sf, "REQ_LAST168H")
    fit = clean.minmax_fit(f, ["REQ_LAST168H"], F.col("split") == "train")
    scaled = clean.minmax_scale(f, fit, {"REQ_LAST168H": "scaled"})
    back = clean.minmax_inverse(scaled, fit, {"scaled": ("REQ_LAST168H", "restored")})
    return r6(back.select(*KEY, "scaled", "restored"), "scaled", "restored")


@query
def row_errors(spark, sf):
    out = scores.add_row_errors(I.standalone(spark, sf), TAGS)
    return out.drop("is_peak", *TAGS.values())


@query
def ape_masked(spark, sf):
    p = scores.add_ape(I.predictions(spark, sf), list(I.PREDS))
    return p.select(*KEY, *[f"ape_{c}" for c in I.PREDS])


# Ensembles

@query
def ens_simple(spark, sf):
    return I.predictions(spark, sf).select(*KEY, blend.simple_average(I.PREDS).alias("pred_ensemble"))


@query
def ens_simple_strict(spark, sf):
    return I.predictions(spark, sf).select(*KEY, blend.strict_average(I.PREDS).alias("pred_ensemble"))


@query
def ens_weighted(spark, sf):
    return I.blended(spark, sf).select(*KEY, "pred_ensemble", "pred_ensemble_m1_m2")


@query
def ens_inverse_mape(spark, sf):
    out = blends.ens_inverse_mape(I.predictions(spark, sf), I.PREDS, I.history(spark, sf))
    return r6(out.select(*KEY, "pred_ensemble_w"), "pred_ensemble_w")


@query
def weight_search(spark, sf):
    return blends.weight_search(materialize(I.history(spark, sf)), I.PREDS)


# Aggregations and metrics

def _metrics(spark, sf):
    return metrics.metrics_zone_model(I.blended(spark, sf), I.MODELS)


@query
def metrics_zone_model(spark, sf):
    return r6(_metrics(spark, sf), *metrics.METRICS)


@query
def metrics_v4(spark, sf):
    return metrics.metrics_standalone(I.by_config(spark, sf), CONFIG_MODELS)


@query
def summary_all_weighted(spark, sf):
    return r6(metrics.with_all_rows(_metrics(spark, sf)), *metrics.METRICS)


@query
def summary_all_pooled(spark, sf):
    return metrics.summary_all_pooled(I.by_config(spark, sf), CONFIG_MODELS)


@query
def daily_mape(spark, sf):
    return r6(metrics.daily_mape(I.blended(spark, sf), I.MODELS), "daily_mape")


@query
def daily_mape_all_rows(spark, sf):
    return metrics.daily_mape_all_rows(I.standalone(spark, sf), STANDALONE)


@query
def daily_peak(spark, sf):
    return metrics.daily_peak(I.blended(spark, sf), {"peak_a": "pred_m1", "peak_b": "pred_ensemble"})


def _importance(spark, sf):
    return importance.corr_importance(I.features(spark, sf, *LAGS), LAGS)


@query
def corr_importance(spark, sf):
    return r6(_importance(spark, sf), "importance")


@query
def importance_pct(spark, sf):
    return r6(importance.importance_pct(_importance(spark, sf)), "importance", "importance_pct")


@query
def diagnostics(spark, sf):
    return quality.diagnostics(I.features(spark, sf, *LAGS), LAGS)


@query
def validate_split(spark, sf):
    parsed = _parsed(spark, sf).withColumn("requirement", F.col("requirement").try_cast("double"))
    return quality.validate_split(parsed, ["requirement", "for_date"], ["requirement"])


# Joins, set operations, sort, top-k

@query
def ab_merge(spark, sf):
    p = I.predictions(spark, sf)
    merged = compare.ab_merge(p.select(*KEY, "actual", F.col("pred_m1").alias("pred")),
                              p.where(F.col("pred_m3").isNotNull()).select(*KEY, F.col("pred_m3").alias("pred")))
    return metrics.daily_peak(merged, {"peak_A": "pred_A", "peak_B": "pred_B"})


def _comparison(spark, sf):
    return compare.config_compare(metrics_v4(spark, sf))


@query
def config_compare(spark, sf):
    return _comparison(spark, sf)


@query
def config_best(spark, sf):
    return compare.config_best(I.by_config(spark, sf), _comparison(spark, sf)).drop("is_peak")


@query
def correction_join(spark, sf):
    joined = monitor.correction_join(I.predictions(spark, sf), monitor.bias_compute(I.history(spark, sf)))
    return r6(joined.select(*KEY, "correction"), "correction")


@query
def month_semi(spark, sf):
    o = I.orders(spark, sf)
    kept = monitor.month_semi(o.where(F.col("split") == "train"), o.where(F.col("split") == "test"))
    return kept.select("zone", "o_orderkey", "for_date", "requirement")


@query
def plan_asof(spark, sf):
    return dashboard.plan_asof(I.history(spark, sf), I.RUN_DATE)


@query
def asof_readings(spark, sf):
    """Each event with the last one of its zone that is at least an hour older."""
    r = I.readings(spark, sf)
    left = r.select("zone", "event_id", (F.col("for_date") - F.expr("INTERVAL 1 HOUR")).alias("at"))
    return asof.as_of_join(left, r, ["zone"], "at", "for_date", ["requirement"], ties=["event_id"], seconds=HALF_HOUR).drop("at")


@query
def union_zones(spark, sf):
    p, s = I.predictions(spark, sf), I.standalone(spark, sf)
    return zones.union_zones(p.select(*KEY, "actual", "pred_m1"),
                             s.select(F.col("reg").alias("zone"), "for_date", "pred_m2"))


@query
def zones_failed(spark, sf):
    return zones.zones_failed(I.registry(spark, sf), I.predictions(spark, sf))


@query
def peak_topk(spark, sf):
    return dashboard.peak_topk(I.readings(spark, sf), "requirement")


@query
def sort_importance(spark, sf):
    return r6(importance.sort_importance(_importance(spark, sf)), "importance")


# Monitoring and adaptation

def _load_shift(spark, sf):
    return monitor.shift_zscore(I.masked(spark, sf))


@query
def shift_zscore(spark, sf):
    return monitor.shift_zscore(I.orders(spark, sf))


def _flags(spark, sf):
    # Loads of single feeders sit within one deviation of train, so the thresholds are lower here.
    return monitor.drift_flags(_load_shift(spark, sf), warn=0.5, critical=0.8)


@query
def drift_flags(spark, sf):
    return _flags(spark, sf)


@query
def drift_recent_mape(spark, sf):
    return monitor.drift_recent_mape(I.scored_log(spark, sf), I.registry(spark, sf), now())


@query
def mape_alerts(spark, sf):
    return r6(monitor.mape_alerts(metrics.with_all_rows(_metrics(spark, sf)), token=TOKEN), "MAPE", "BIAS")


@query
def bias_compute(spark, sf):
    return r6(monitor.bias_compute(I.history(spark, sf)), "correction")


@query
def bias_apply(spark, sf):
    fixed = monitor.bias_apply(I.blended(spark, sf), monitor.bias_compute(I.history(spark, sf)))
    # shares of 1/64 end in a 5 at the seventh place: nine places leave no value half-way
    return fixed.drop("is_peak").withColumns({c: F.round(c, 9) for c in I.MODELS.values()})


@query
def decision_dashboard(spark, sf):
    p = materialize(I.predictions(spark, sf))  # both inputs are made from it
    return dashboard.decision_dashboard(I.with_ensembles(p), I.history(spark, sf, p), I.RUN_DATE)


@query
def dashboard_v4(spark, sf):
    return dashboard.dashboard_standalone(I.standalone(spark, sf), I.RUN_DATE)


# Forecasters and cross-validation

def _complete_train(spark, sf):
    train = materialize(I.features(spark, sf, *PAIR).where(F.col("split") == "train"))
    return clean.impute_train_median(train, PAIR)


@query
def fc_seasonal_naive(spark, sf):
    return forecast.seasonal_naive(I.masked(spark, sf), unique=True).where(F.col("split") == "test").drop("split")


@query
def fc_zone_ols(spark, sf):
    out = forecast.zone_ols(I.features(spark, sf, "REQ_LAST168H"), "REQ_LAST168H")
    return r6(out.where(F.col("split") == "test").select(*KEY, "pred"), "pred")


@query
def fc_zone_ridge(spark, sf):
    out = forecast.zone_ridge(I.features(spark, sf, *PAIR), PAIR, penalty=0.1)
    return r6(out.where(F.col("split") == "test").select(*KEY, "pred"), "pred")


def _gbt(spark, sf, **params):
    f = I.features(spark, sf, "REQUIREMENT_LAG_3D", *PAIR)
    wide = dates.add_basic_time_features(f)
    names = ["REQUIREMENT_LAG_3D", *PAIR, "hour_auto", "dayofweek_auto"]
    fit = forecast.fit_gbt(wide.where(F.col("split") == "train"), names, **params)
    return fit.predict(wide.where(F.col("split") == "test")).select(*KEY, "requirement", "pred")


@query
def fc_gbt_a(spark, sf):
    return _gbt(spark, sf, maxIter=3, maxDepth=3, stepSize=0.05, subsamplingRate=0.9)


@query
def fc_gbt_b(spark, sf):
    return _gbt(spark, sf, maxIter=3, maxDepth=4, stepSize=0.04, subsamplingRate=1.0)


@query
def fc_sequence(spark, sf):
    out = forecast.sequence_forecast(I.masked(spark, sf), ["requirement"], length=2, grid=True, penalty=0.1)
    return r6(out.where(F.col("split") == "test").select(*KEY, "pred"), "pred")


@query
def fc_sequence_all(spark, sf):
    """Six steps of all features: lags with nulls imputed, hour and day of the week."""
    lags = ["REQUIREMENT_LAG_3D", *PAIR]
    f = materialize(dates.add_basic_time_features(I.features(spark, sf, *lags)))
    out = sequence.sequence_ridge(materialize(clean.impute_train_median(f, lags)), [*lags, "hour_auto", "dayofweek_auto"], grid=True)
    return out.where(F.col("split") == "test").select(*KEY, "requirement", "pred")


@query
def cv_folds(spark, sf):
    return cv.cv_folds(_complete_train(spark, sf).select(*KEY))


@query
def cv_folds_rows(spark, sf):
    o = I.orders(spark, sf).select("zone", "for_date", "o_orderkey")
    return cv.cv_folds(o, order=("for_date", "o_orderkey"), seconds=DAY).drop("for_date")


@query
def cv_mape(spark, sf):
    return r6(cv.cv_mape(materialize(_complete_train(spark, sf)), "REQ_LAST168H"), "cv_mape")


@query
def param_search(spark, sf):
    train = materialize(_complete_train(spark, sf))
    return r6(cv.param_search(train, PAIR, PENALTIES), "best_cv_mape")


@query
def param_search_trees(spark, sf):
    """Tree settings per zone by successive halving over the time folds."""
    train = materialize(dates.add_basic_time_features(_complete_train(spark, sf)))
    trials = [{"depth": d, "step": s} for d in (2, 4) for s in (0.1, 0.4)]
    best, _ = halving.halving_search(train, models.TreeForecaster(), [*PAIR, "hour_auto", "dayofweek_auto"], trials, folds=3)
    return best


@query
def ablation_ab(spark, sf):
    f = clean.fill_zero_lag(I.features(spark, sf, "REQUIREMENT_LAG_3D", "REQ_LAST168H"))
    both = f.withColumn("_x", (F.col("REQUIREMENT_LAG_3D") + F.col("REQ_LAST168H")) / 2)
    arms = forecast.zone_ols(forecast.zone_ols(both, "_x", out="pred_a"), "REQ_LAST168H", out="pred_b")
    out = compare.ablation_ab(arms.where(F.col("split") == "test").withColumnRenamed("requirement", "actual"),
                              {"with_lag_3d": "pred_a", "without_lag_3d": "pred_b"})
    return r6(out, "MAPE", "MAE", "BIAS", "future_min", "future_mean", "future_max")


# Streaming

@query
def stream_ingest(spark, sf):
    """Two deliveries: the first has placeholders from the 20th on, the second states these days anew."""
    root = shared_dir(spark)
    raw = I.raw_series(spark, sf).select("zone", "for_date", "requirement")
    late = F.coalesce(dates.parse_for_date(F.col("for_date")) >= dates.timestamp("2024-01-20"), F.lit(True))
    for part in (raw.withColumn("requirement", F.when(late, "0").otherwise(F.col("requirement"))), raw.where(late)):
        part.write.mode("append").option("header", True).csv(f"{root}/in")
        streams.stream_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", raw.schema)
    return streams.read_series(spark, f"{root}/out")


def _stream(spark, df, path):
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


@query
def stream_daily_mape(spark, sf):
    root = shared_dir(spark)
    p = materialize(I.predictions(spark, sf))
    actuals = _stream(spark, p.select(*KEY, "actual"), f"{root}/in")
    streams.stream_daily_mape(actuals, p, "pred_m2", f"{root}/out", f"{root}/checkpoint")
    return r6(streams.read_daily_mape(spark, f"{root}/out"), "daily_mape")


@query
def stream_drift(spark, sf):
    root = shared_dir(spark)
    p = I.predictions(spark, sf).where(scores.is_realized(F.col("actual")))
    apes = _stream(spark, p.select(*KEY, scores.ape(F.col("actual"), F.col("pred_m2")).alias("ape")), f"{root}/in")
    streams.stream_drift(apes, f"{root}/out", f"{root}/checkpoint")
    return r6(streams.read_drift(spark, f"{root}/out"), "recent_mape")
