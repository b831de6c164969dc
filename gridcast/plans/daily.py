"""The daily run: features, forecasts, blend, scores, monitoring, correction and outputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast import config as C
from gridcast.functions.blend import weighted_average
from gridcast.functions.dates import add_basic_time_features
from gridcast.functions.scores import add_ape
from gridcast.operators import (
    blends, clean, dashboard, features, forecast, importance, metrics, monitor, quality, slices,
)
from gridcast.operators.models import ForecastModel
from gridcast.session import materialize
from gridcast.sources import history as hist
from gridcast.sources import tables, zones

Forecaster = Callable[[DataFrame, Sequence[str]], DataFrame] | Estimator
"""(rows of both splits, feature names) -> the test rows (_row, pred), where ``_row`` numbers the given
rows; or an estimator of :mod:`gridcast.operators.models`, which is fitted to these rows and features
(a sequence forecaster that has features of its own keeps them)."""

ROW = "_row"


@dataclass
class DailyRun:
    run_ts: str
    predictions: DataFrame
    metrics: DataFrame
    daily_mape: DataFrame
    diagnostics: DataFrame
    importance: DataFrame
    shift: DataFrame
    drift: DataFrame
    alerts: DataFrame
    corrections: DataFrame
    new_weights: DataFrame
    log: DataFrame
    today: DataFrame
    future: DataFrame
    latest: DataFrame
    dashboard: DataFrame


def trees(**params) -> Forecaster:
    """Boosted trees; the defaults are the library's full setting, pass fewer trees to try things."""
    def predict(df: DataFrame, names: Sequence[str]) -> DataFrame:
        fit = forecast.fit_gbt(df.where(F.col("split") == "train"), names, **params)
        return fit.predict(df.where(F.col("split") == "test")).select(ROW, "pred")
    return predict


def ridge(penalty: float = 1e-3) -> Forecaster:
    def predict(df: DataFrame, names: Sequence[str]) -> DataFrame:
        return forecast.zone_ridge(df, names, penalty=penalty).where(F.col("split") == "test").select(ROW, "pred")
    return predict


def sequence(length: int = C.SEQUENCE_LENGTH, column: str = C.WEEK_LAG, carry: bool = False) -> Forecaster:
    def predict(df: DataFrame, names: Sequence[str]) -> DataFrame:
        return forecast.sequence_forecast(df, [column], length=length, carry=carry).where(
            F.col("split") == "test").select(ROW, "pred")
    return predict


DEFAULT_FORECASTERS: dict[str, Forecaster] = {
    "pred_xgb": trees(**C.TREES_MODULAR),
    "pred_lgbm": trees(**{**C.TREES_MODULAR, "seed": C.SEED + 1}),
    "pred_lstm": sequence(),
}


def numbered(df: DataFrame) -> DataFrame:
    """``df`` written with a row number, by which predictions find their rows however dates repeat."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()))


def prepare(series: DataFrame, holidays: DataFrame, exclude: Sequence[str] = C.EXCLUDED_FEATURES) -> tuple[DataFrame, list[str]]:
    """Numbered rows of both splits with features: text as codes, nulls imputed, and, per zone, 0 in
    the features that one of its splits lacks altogether; the raw target is kept as ``actual``."""
    raw = series.withColumn("actual", F.col(C.TARGET))
    built = clean.bool_to_int(add_basic_time_features(features.build_features(raw, holidays)))
    text = [f.name for f in built.schema if isinstance(f.dataType, T.StringType) and f.name not in ("zone", "split")]
    table = materialize(built)
    if text:
        table = materialize(clean.encode_category(table, text, fit=F.col("split") == "train"))
    names = clean.select_features(table.schema, table.schema, exclude, (*clean.NOT_FEATURES, "actual"))
    kept = clean.zone_features(table, names)
    imputed = clean.impute_train_median(table, names)
    return numbered(clean.without_absent(imputed, kept, names)), names


def attach(df: DataFrame, forecasters: Mapping[str, Forecaster], names: Sequence[str]) -> DataFrame:
    """Test rows with one column per forecaster, matched by row number: as many rows as there were."""
    out = df.where(F.col("split") == "test").select(ROW, "zone", "for_date", "actual")
    for column, f in forecasters.items():
        if isinstance(f, Estimator):
            pred = fitted(f, df, names).transform(df).where(F.col("split") == "test").select(ROW, F.col("pred").alias(column))
        else:
            pred = f(df, names).withColumnRenamed("pred", column)
        out = out.join(pred, ROW, "left")
    return out


def fitted(estimator: Estimator, df: DataFrame, names: Sequence[str]) -> ForecastModel:
    """The estimator's model for the given rows, with the prediction in ``pred``."""
    own = estimator.copy()
    own._set(features=own.get("features") or list(names), out="pred")
    return own.fit(df)


def series_from_files(
    spark: SparkSession, registry: DataFrame, text: Sequence[str] = (), missing: str = "error", root: str | None = None,
) -> DataFrame:
    """The series of the registered zone files: read by name, dates parsed, every column but ``text``
    coerced to numbers, rows without date or load dropped. What the runs start from."""
    rows = zones.parse_dates(zones.scan_zone_csv(spark, registry, missing, root))
    kept = {"zone", "split", "for_date", *text}
    return clean.clean_rows(rows, [c for c in rows.columns if c not in kept])


def model_importance(models: Mapping[str, ForecastModel]) -> DataFrame:
    """(zone, model, feature, importance) of fitted models."""
    parts = [m.featureImportances().select("zone", F.lit(name).alias("model"), "feature", "importance") for name, m in models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_daily(
    series: DataFrame, holidays: DataFrame, history: DataFrame, stored_weights: DataFrame,
    run_ts: str, run_date: str, now: Column, forecasters: Mapping[str, Forecaster] | None = None,
    filled_shift: bool = False,
) -> DailyRun:
    """``series``: (zone, split, for_date, requirement, lag and other feature columns).

    The shift check looks at raw actuals; ``filled_shift`` counts filled placeholders as realised.
    History and weights are those of earlier runs, so a run never learns from itself.
    """
    table, names = prepare(series, holidays)
    preds = attach(table, forecasters or DEFAULT_FORECASTERS, names).drop(ROW)
    paired = preds.withColumn("pred_ensemble_xgb_lgbm", weighted_average(C.PAIR_WEIGHTS))
    weights = hist.weights_load(stored_weights, C.DEFAULT_WEIGHTS)
    blended = materialize(add_ape(
        blends.blend_with(paired, weights, list(C.DEFAULT_WEIGHTS), "pred_ensemble"), list(C.MODELS.values())))

    scored = metrics.metrics_zone_model(blended)
    full = metrics.with_all_rows(scored)
    shift = monitor.shift_zscore(table if filled_shift else table.withColumn(C.TARGET, F.col("actual")))
    drift = monitor.drift_flags(shift)
    alerts = monitor.mape_alerts(full)
    corrections = monitor.bias_compute(history)
    corrected = monitor.bias_apply(blended, corrections)
    best = blends.weight_search(history, list(C.DEFAULT_WEIGHTS))
    log = hist.adapt_log(
        monitor.drift_events(drift, now), monitor.alert_events(alerts, now),
        monitor.bias_events(corrections, now),
        monitor.weight_events(best, {"pred_xgb": "xgb", "pred_lgbm": "lgbm", "pred_lstm": "lstm"}, now))
    return DailyRun(
        run_ts=run_ts,
        predictions=corrected,
        metrics=full,
        daily_mape=metrics.daily_mape(corrected),
        diagnostics=quality.diagnostics(table.select("zone", "split", "for_date", C.TARGET, *names), names),
        importance=importance.importance_pct(
            importance.corr_importance(table.where(F.col("split") == "train"), names)),
        shift=shift, drift=drift, alerts=alerts, corrections=corrections,
        new_weights=blends.weights_row(best, list(C.DEFAULT_WEIGHTS), now), log=log,
        today=slices.today(corrected, run_date), future=slices.future(corrected),
        latest=slices.latest_per_zone(corrected),
        dashboard=dashboard.decision_dashboard(corrected, history, run_date),
    )


def write_daily(run: DailyRun, root: str) -> None:
    """Result tables replace those of the last run; snapshot, history, log and weights only grow.

    History is appended last, after every table that reads it has been written.
    """
    for name in ("predictions", "metrics", "daily_mape", "diagnostics", "importance", "shift", "drift", "alerts",
                 "today", "future", "latest", "dashboard"):
        tables.write_table(getattr(run, name), f"{root}/{name}")
    run.log.write.mode("append").parquet(f"{root}/adaptation_log")
    run.new_weights.write.mode("append").parquet(f"{root}/weights")
    tables.snapshot_run(run.predictions, f"{root}/snapshots", run.run_ts)
    hist.history_append(run.predictions, f"{root}/history", run.run_ts)
