"""One row per zone for the operator: plan, yesterday's actuals and today's forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.dates import on_day
from gridcast.functions.scores import is_realized

_TIME = "yyyy-MM-dd HH:mm:ss"


def _peak_time(value: Column, when: Column) -> Column:
    """Stamp of the largest value, the earliest one on ties, as text."""
    order = F.when(when & value.isNotNull(), F.struct(value, -F.unix_micros(F.col("for_date").cast("timestamp"))))
    return F.date_format(F.max_by("for_date", order), _TIME)


def peak_topk(df: DataFrame, value: str, key: str = "zone") -> DataFrame:
    """Each zone's largest value and when it occurred, first on ties."""
    v = F.col(value)
    return df.where(v.isNotNull()).groupBy(key).agg(
        F.max(v).alias("peak"),
        F.max_by("for_date", F.struct(v, -F.unix_micros(F.col("for_date").cast("timestamp")))).alias("peak_time"))


def plan_asof(
    history: DataFrame, run_date: str, pred: str = "pred_ensemble", whole_run_date: bool = False,
) -> DataFrame:
    """What the last run before ``run_date`` predicted for that date: total and peak per zone.

    If a date saw several runs the newest counts; ``whole_run_date`` adds all of them up.
    """
    run = ["run_date"] if whole_run_date else ["run_date", "run_timestamp"]
    earlier = history.where(F.col("run_date") < F.lit(run_date).cast("date"))
    # the newest run comes from the run columns alone; then only that run's rows of the date are read
    newest = earlier.groupBy("zone").agg(F.max(F.struct(*run)).alias("r")).select("zone", "r.*")
    p = F.col(pred)
    plans = earlier.where(on_day(F.col("for_date"), run_date)).groupBy("zone", *run).agg(
        F.coalesce(F.sum(p), F.lit(0.0)).alias("s"), F.max(p).alias("m"))
    return newest.join(plans, ["zone", *run], "left").select(
        "zone", F.round("s", 2).alias("plan_total_mw"), F.round("m", 2).alias("plan_peak_mw"),
        F.date_format("run_date", "yyyy-MM-dd").alias("plan_made_on"))


def decision_dashboard(
    predictions: DataFrame, history: DataFrame, run_date: str, pred: str = "pred_ensemble",
) -> DataFrame:
    p, a = F.col(pred), F.col("actual")
    is_today = on_day(F.col("for_date"), run_date)
    scored = on_day(F.col("for_date"), run_date, -1) & is_realized(a)
    # zones and both days come from one pass, as zones without rows on these days are listed too
    per_zone = predictions.groupBy("zone").agg(
        F.round(F.avg(F.when(scored, a)), 2).alias("actual_yesterday_avg_mw"),
        F.round(F.max(F.when(scored, a)), 2).alias("peak_yesterday_mw"),
        _peak_time(a, scored).alias("peak_yesterday_time"),
        F.when(F.count_if(is_today) > 0, F.round(F.coalesce(F.sum(F.when(is_today, p)), F.lit(0.0)), 2))
        .alias("today_forecast_total_mw"),
        F.round(F.max(F.when(is_today, p)), 2).alias("today_forecast_peak_mw"),
        _peak_time(p, is_today).alias("today_forecast_peak_time"),
    )
    return per_zone.join(plan_asof(history, run_date, pred), "zone", "left").select(
        "zone", F.lit(run_date).alias("date"), "plan_total_mw", "plan_peak_mw", "plan_made_on",
        "actual_yesterday_avg_mw", "peak_yesterday_mw", "peak_yesterday_time",
        "today_forecast_total_mw", "today_forecast_peak_mw", "today_forecast_peak_time")


def dashboard_standalone(
    predictions: DataFrame, run_date: str, pred: str = "pred_ensemble", key: str = "reg",
) -> DataFrame:
    """Yesterday's average and peak, today's average, and today's peak among peak-hour rows."""
    p, a = F.col(pred), F.col("actual")
    is_today = on_day(F.col("for_date"), run_date)
    is_yesterday = on_day(F.col("for_date"), run_date, -1)
    peak_hours = is_today & (F.col("is_peak") == 1)
    return predictions.groupBy(F.col(key).alias("zone")).agg(
        F.round(F.avg(F.when(is_yesterday, a)), 2).alias("yesterday_actual_avg"),
        F.round(F.max(F.when(is_yesterday, a)), 2).alias("yesterday_peak_actual"),
        _peak_time(a, is_yesterday).alias("yesterday_peak_time"),
        F.round(F.avg(F.when(is_today, p)), 2).alias("today_forecast_avg"),
        F.round(F.max(F.when(peak_hours, p)), 2).alias("today_peak_forecast"),
        _peak_time(p, peak_hours).alias("today_peak_time"),
    ).select(F.lit(run_date).alias("date_run"), "*")
