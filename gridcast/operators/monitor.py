"""Distribution shift, drift, alerts and bias correction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast import config as C
from gridcast.functions.scores import is_realized
from gridcast.sources.history import log_events, scored_history


def month_semi(train: DataFrame, test: DataFrame, target: str = "requirement") -> DataFrame:
    """Train rows in a calendar month that the realised test rows fall in, per zone."""
    months = test.where(is_realized(F.col(target))).select("zone", F.month("for_date").alias("_month")).distinct()
    return train.withColumn("_month", F.month("for_date")).join(months, ["zone", "_month"], "left_semi").select(
        *train.columns)


def shift_zscore(
    df: DataFrame, target: str = "requirement", prior_years: bool = False,
) -> DataFrame:
    """Train and realised-test means and z-scores, long (zone, metric, value).

    Rows are first reduced to (zone, split, year, month) moments; the rest works on those few rows.
    """
    y = F.col(target)
    kept = df.where(y.isNotNull() & ((F.col("split") == "train") | is_realized(y)))
    moments = kept.groupBy(
        "zone", "split", F.year("for_date").alias("y"), F.month("for_date").alias("m"),
    ).agg(F.count("*").alias("n"), F.avg(target).alias("mean"), F.var_pop(target).alias("var"))
    zone = Window.partitionBy("zone")
    is_train, is_test = F.col("split") == "train", F.col("split") == "test"
    marked = moments.select(
        "*",
        F.max(F.when(is_test, 1)).over(Window.partitionBy("zone", "m")).alias("_month_hit"),
        F.min(F.when(is_test, F.col("y"))).over(zone).alias("_test_year"),
    )
    same = is_train & (F.col("_month_hit") == 1)
    if prior_years:
        same = same & (F.col("y") < F.col("_test_year"))

    def mean_of(mask: Column) -> Column:
        return F.try_divide(F.sum(F.when(mask, F.col("mean") * F.col("n"))).over(zone),
                            F.sum(F.when(mask, F.col("n"))).over(zone))

    centred = marked.select("*", mean_of(is_train).alias("train_mean"), mean_of(same).alias("same_mean"))

    def squares(mask: Column, centre: str) -> Column:
        gap = F.col("mean") - F.col(centre)
        return F.sum(F.when(mask, (F.col("var") + gap * gap) * F.col("n")))

    def count(mask: Column) -> Column:
        return F.coalesce(F.sum(F.when(mask, F.col("n"))), F.lit(0))

    wide = centred.groupBy("zone").agg(
        F.first("train_mean").alias("train_mean"), F.first("same_mean").alias("same_mean"),
        F.try_divide(F.sum(F.when(is_test, F.col("mean") * F.col("n"))), count(is_test)).alias("test_mean"),
        count(is_test).alias("test_n"), count(same).alias("same_n"),
        F.sqrt(F.try_divide(squares(is_train, "train_mean"), count(is_train) - 1)).alias("train_std"),
        F.sqrt(F.try_divide(squares(same, "same_mean"), count(same) - 1)).alias("same_std"),
    )
    has_test = F.col("test_n") > 0
    has_same = has_test & (F.col("same_n") > 1)

    def z(mean: str, std: str) -> Column:
        return F.when(F.col(std) > 0, (F.col("test_mean") - F.col(mean)) / F.col(std))

    def row(name: str, value: Column, when: Column | None = None) -> Column:
        cell = F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
        return cell if when is None else F.when(when, cell)

    cells = F.array(
        row("train_mean", F.round("train_mean", 2)),
        row("train_std", F.round("train_std", 2)),
        row("test_realized_mean", F.round("test_mean", 2), has_test),
        row("test_realized_n_rows", F.col("test_n"), has_test),
        row("z_score_vs_train", F.round(z("train_mean", "train_std"), 3), has_test),
        row("same_month_history_mean", F.round("same_mean", 2), has_same),
        row("z_score_vs_same_month_history", F.round(z("same_mean", "same_std"), 3), has_same),
    )
    return wide.select("zone", F.inline(F.filter(cells, lambda c: c.isNotNull())))


def drift_flags(shift: DataFrame, warn: float = C.DRIFT_Z_WARN, critical: float = C.DRIFT_Z_CRITICAL) -> DataFrame:
    """Zones whose z-score against train reaches a threshold, with its severity."""
    z = shift.where(F.col("metric") == "z_score_vs_train").groupBy("zone").agg(F.max("value").alias("z_score"))
    size = F.abs("z_score")
    return z.where(size >= warn).withColumn(
        "severity", F.when(size >= critical, "critical").otherwise("warning"))


def drift_events(flags: DataFrame, now: Column) -> DataFrame:
    kind = F.when(F.col("severity") == "critical", "DRIFT_CRITICAL").otherwise("DRIFT_WARNING")
    return log_events(flags, kind, F.format_string(C.DRIFT_DETAIL, "z_score"), F.col("z_score"), now)


def drift_recent_mape(
    history: DataFrame, registry: DataFrame, now: Column, days: int = C.DRIFT_DAYS,
    threshold: float = C.DRIFT_MAPE_PCT, ape: str = "ape_ensemble",
) -> DataFrame:
    """Each registered zone's mean ensemble APE since ``now - days``, with the verdict and reason."""
    recent = history.where(F.col("for_date") >= now - F.expr(f"INTERVAL {int(days)} DAYS")).groupBy("zone").agg(
        F.round(F.avg(ape), 4).alias("recent_mape"), F.count("*").alias("_n"))
    empty = history.limit(1).agg(F.count("*") == 0).scalar()
    m = F.col("recent_mape")
    over = F.coalesce(m > threshold, F.lit(False))
    reason = (
        F.when(F.col("_n").isNull() & empty, C.REASON_NO_HISTORY)
        .when(F.col("_n").isNull(), C.REASON_NO_DATA)
        .when(m.isNull(), C.REASON_NO_SCORE)
        .when(over, F.format_string(C.REASON_DRIFT.format(threshold=threshold, days=days), m))
        .otherwise(F.format_string(C.REASON_OK, m))
    )
    return registry.select("zone").distinct().join(recent, "zone", "left").select(
        "zone", over.alias("drift"), "recent_mape", reason.alias("reason"))


def mape_alerts(metrics: DataFrame, limit: float = C.MAPE_ALERT_PCT, token: str = C.ALERT_TOKEN) -> DataFrame:
    """Zone rows of ensemble models whose MAPE is above the limit, with the alert text."""
    hit = (F.col("zone") != "ALL") & F.col("model").contains(token) & (F.col("MAPE") > limit)
    text = F.format_string(C.ALERT_TEXT.format(limit=limit), "zone", "MAPE", "BIAS")
    return metrics.where(hit).select("zone", "model", "MAPE", "BIAS", text.alias("message"))


def alert_events(alerts: DataFrame, now: Column) -> DataFrame:
    return log_events(alerts, "MAPE_ALERT", F.format_string(C.ALERT_DETAIL, "MAPE", "BIAS"),
                      F.col("MAPE"), now)


def bias_compute(
    history: DataFrame, pred: str = "pred_ensemble", min_rows: int = C.MIN_ROWS_BIAS, dedup: str | None = None,
) -> DataFrame:
    """(zone, correction, n): minus the mean error over scored history, for zones with enough rows."""
    error = F.col(pred) - F.col("actual")
    return scored_history(history, dedup).groupBy("zone").agg(
        (-F.avg(error)).alias("correction"), F.count("*").alias("n")).where(F.col("n") >= min_rows)


def bias_events(corrections: DataFrame, now: Column) -> DataFrame:
    detail = F.format_string(C.BIAS_DETAIL, -F.col("correction"), F.col("correction"), F.col("n"))
    return log_events(corrections, "BIAS_CORRECTION_COMPUTED", detail, F.col("correction"), now)


def weight_events(best: DataFrame, labels: Mapping[str, str], now: Column) -> DataFrame:
    """``labels`` maps each weight column to its short name in the log text."""
    pattern = " ".join(f"{v}=%.3f" for v in labels.values()) + " mape=%.3f n=%d"
    detail = F.format_string(pattern, *labels, "mape_at_optimum", "n_rows_used")
    return log_events(best, "WEIGHT_OPT_UPDATED", detail, F.col("mape_at_optimum"), now, F.lit("ALL"))


def correction_join(df: DataFrame, corrections: DataFrame) -> DataFrame:
    """Each row with its zone's correction, null where the zone has none."""
    return df.join(corrections.select("zone", "correction"), "zone", "left")


def bias_apply(df: DataFrame, corrections: DataFrame, preds: Sequence[str] | None = None) -> DataFrame:
    """Add the zone's correction to every prediction of rows not realised yet, not below zero."""
    preds = list(preds) if preds else [c for c in df.columns if c.startswith("pred_")]
    ahead = (F.abs("actual") < 1.0) & F.col("correction").isNotNull()
    moved = {
        p: F.when(ahead & F.col(p).isNotNull(), F.greatest(F.col(p) + F.col("correction"), F.lit(0.0)))
        .otherwise(F.col(p)) for p in preds
    }
    return correction_join(df, corrections).withColumns(moved).select(*df.columns)
