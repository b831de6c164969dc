"""The standalone run: clean, forecast under one or two configs, score, compare and report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast import config as C
from gridcast.functions.blend import strict_average
from gridcast.functions.scores import add_row_errors
from gridcast.operators import blends, clean, compare, dashboard, importance, metrics, monitor, quality, slices
from gridcast.operators.models import SequenceForecaster, tree_forecaster
from gridcast.plans.daily import ROW, Forecaster, attach, numbered
from gridcast.session import materialize
from gridcast.sources import history as hist
from gridcast.sources import tables

PREDS = ("pred_xgb", "pred_lgbm", "pred_lstm")
TAGS = {"xgb": "pred_xgb", "lgbm": "pred_lgbm", "lstm": "pred_lstm", "ensemble": "pred_ensemble",
        "ensemble_w": "pred_ensemble_w"}


def full_configs() -> dict[str, dict[str, Forecaster]]:
    """The two configurations at their full settings."""
    return {
        "org": {"pred_xgb": tree_forecaster(C.TREES_ORG), "pred_lgbm": tree_forecaster(C.TREES_ORG, seed=C.SEED + 1),
                "pred_lstm": SequenceForecaster(length=C.SEQUENCE_LENGTH_STANDALONE)},
        "tuned": {"pred_xgb": tree_forecaster(C.TREES_MODULAR), "pred_lgbm": tree_forecaster(C.TREES_MODULAR, seed=C.SEED + 1),
                  "pred_lstm": SequenceForecaster(length=C.SEQUENCE_LENGTH)}}


@dataclass
class StandaloneRun:
    predictions: DataFrame
    best: DataFrame
    metrics: DataFrame
    comparison: DataFrame
    quality: DataFrame
    importance: DataFrame
    drift: DataFrame
    today: DataFrame
    yesterday: DataFrame
    latest: DataFrame
    future: DataFrame
    dashboard: DataFrame
    daily_mape: DataFrame
    manifest: DataFrame


def run_standalone(
    series: DataFrame, registry: DataFrame, configs: Mapping[str, Mapping[str, Forecaster]],
    run_ts: str, run_date: str, now: Column, history: DataFrame | None = None,
    feature_names: Sequence[str] = C.SERIES_FEATURES, lags: Sequence[str] = tuple(C.LAG_COLUMNS)[:4],
) -> StandaloneRun:
    """``configs``: name -> forecasters of the three model columns (:func:`full_configs`, for one); all zones
    run in one plan."""
    present = {c.lower() for c in series.columns}
    names = [f for f in feature_names if f.lower() in present]
    checked = quality.validate_split(series, [*names, C.TARGET], [c for c in lags if c.lower() in present])
    cleaned = clean.clean_rows(series, [*names, C.TARGET])
    table = numbered(clean.impute_split_median(materialize(cleaned), names).withColumn("actual", F.col(C.TARGET)))

    peak = C.PEAK if C.PEAK.lower() in present else None
    flags = table.where(F.col("split") == "test").select(
        ROW, (F.col(peak) if peak else F.lit(0)).alias("is_peak"))
    parts = []
    for config, forecasters in configs.items():
        wide = attach(table, forecasters, names).withColumn("pred_ensemble", strict_average(PREDS))
        weighted = blends.ens_inverse_mape(wide, PREDS, history)
        parts.append(weighted.join(flags, ROW, "left").drop(ROW).withColumn("config", F.lit(config)))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    predictions = materialize(add_row_errors(stacked.withColumnRenamed("zone", "reg"), TAGS))

    scored = metrics.summary_all_pooled(predictions)
    comparison = compare.config_compare(scored.where(F.col("reg") != "ALL"))
    best = compare.config_best(predictions, comparison) if len(configs) > 1 else predictions
    by_zone = best.withColumnRenamed("reg", "zone")
    if history is None:
        drift = registry.select("zone").distinct().select(
            "zone", F.lit(False).alias("drift"), F.lit(None).cast("double").alias("recent_mape"),
            F.lit("no history").alias("reason"))
    else:
        drift = monitor.drift_recent_mape(history, registry, now)
    return StandaloneRun(
        predictions=predictions, best=best, metrics=scored, comparison=comparison, quality=checked,
        importance=importance.sort_importance(
            importance.corr_importance(table.where(F.col("split") == "train"), names)),
        drift=drift, today=slices.today(best, run_date), yesterday=slices.yesterday(best, run_date),
        latest=slices.latest_global(best), future=slices.future_standalone(best, run_date),
        dashboard=dashboard.dashboard_standalone(best, run_date), daily_mape=metrics.daily_mape_all_rows(best),
        manifest=hist.run_manifest(run_ts, registry, by_zone, drift),
    )


def write_standalone(run: StandaloneRun, root: str, run_ts: str, history: DataFrame | None = None) -> str:
    """Writes the run and the history that the next run reads; returns that history's path.

    Result tables replace those of the last run, snapshots and manifests only grow. Each run's
    history is a table of its own, named by the run, so nothing is overwritten while it is read.
    """
    for name in ("predictions", "best", "metrics", "comparison", "quality", "importance", "drift", "today", "yesterday",
                 "latest", "future", "dashboard", "daily_mape"):
        tables.write_table(getattr(run, name), f"{root}/{name}")
    tables.snapshot_run(run.best, f"{root}/snapshots", run_ts)
    tables.snapshot_run(run.manifest, f"{root}/manifests", run_ts)
    return tables.snapshot_run(next_history(history, run, run_ts), f"{root}/history", run_ts)


def next_history(history: DataFrame | None, run: StandaloneRun, run_ts: str) -> DataFrame:
    """The newest prediction per (for_date, zone) over the old history and this run."""
    tagged = hist.tag_run(run.best.withColumnRenamed("reg", "zone"), run_ts)
    return hist.history_latest(tagged if history is None else history.unionByName(tagged, allowMissingColumns=True))
