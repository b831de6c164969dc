"""Scores per zone, model and day. All models are aggregated side by side in one pass, then turned
into rows, so the input is neither repeated per model nor shuffled before it is reduced."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.config import MODELS, STANDALONE_MODELS
from gridcast.functions.scores import ape, ape_masked, is_realized

METRICS = ("MAPE", "MAE", "RMSE", "BIAS")
COUNTS = ("n_rows_total", "n_rows_scored", "n_rows_excluded_zero_actual")


def _rows_per_model(df: DataFrame, ids: list[str], models: Mapping[str, str], fields: tuple[str, ...]) -> DataFrame:
    cells = [F.struct(F.lit(m).alias("model"), *[F.col(f"{f}_{i}").alias(f) for f in fields])
             for i, m in enumerate(models)]
    return df.select(*ids, F.inline(F.array(*cells)))


def _scores(i: int, actual: Column, pred: Column, mask: Column, digits: int | None = None) -> list[Column]:
    error = F.when(mask, pred - actual)
    values = {
        "MAPE": F.avg(F.when(mask, ape(actual, pred))),
        "MAE": F.avg(F.abs(error)),
        "RMSE": F.sqrt(F.avg(error * error)),
        "BIAS": F.avg(error),
    }
    return [(v if digits is None else F.round(v, digits)).alias(f"{k}_{i}") for k, v in values.items()]


def metrics_zone_model(
    df: DataFrame, models: Mapping[str, str] = MODELS, actual: str = "actual", key: str = "zone",
) -> DataFrame:
    """MAPE, MAE, RMSE, BIAS and row counts over valid and realised rows."""
    a = F.col(actual)
    aggs: list[Column] = []
    for i, p in enumerate(models.values()):
        valid = a.isNotNull() & F.col(p).isNotNull()
        aggs += _scores(i, a, F.col(p), valid & is_realized(a))
        aggs += [
            F.count("*").alias(f"n_rows_total_{i}"),
            F.count_if(valid & is_realized(a)).alias(f"n_rows_scored_{i}"),
            F.count_if(valid & ~is_realized(a)).alias(f"n_rows_excluded_zero_actual_{i}"),
        ]
    return _rows_per_model(df.groupBy(key).agg(*aggs), [key], models, (*METRICS, *COUNTS))


def metrics_standalone(
    df: DataFrame, models: Mapping[str, str] = STANDALONE_MODELS, keys: tuple[str, ...] = ("reg", "config"),
    actual: str = "actual", digits: int = 4,
) -> DataFrame:
    """The same four scores over all valid rows, rounded, without the realised mask."""
    return _rows_per_model(
        df.groupBy(*keys).agg(*_standalone_scores(models, actual, digits)), list(keys), models, METRICS)


def _standalone_scores(models: Mapping[str, str], actual: str, digits: int) -> list[Column]:
    a = F.col(actual)
    return [c for i, p in enumerate(models.values())
            for c in _scores(i, a, F.col(p), a.isNotNull() & F.col(p).isNotNull(), digits)]


def summary_all_pooled(
    df: DataFrame, models: Mapping[str, str] = STANDALONE_MODELS, actual: str = "actual", digits: int = 4,
) -> DataFrame:
    """Zone rows plus an ALL row per config, both computed from the rows with grouping sets."""
    sets = df.groupingSets([["reg", "config"], ["config"]], "reg", "config").agg(
        F.grouping("reg").alias("_all"), *_standalone_scores(models, actual, digits))
    named = sets.withColumn("reg", F.when(F.col("_all") == 1, F.lit("ALL")).otherwise(F.col("reg")))
    return _rows_per_model(named, ["reg", "config"], models, METRICS)


def summary_all_weighted(metrics: DataFrame) -> DataFrame:
    """An ALL row per model: scores weighted by scored rows, counts summed."""
    n = F.col("n_rows_scored")
    return metrics.groupBy("model").agg(
        F.lit("ALL").alias("zone"),
        *[F.try_divide(F.sum(F.col(m) * n), F.sum(n)).alias(m) for m in METRICS],
        *[F.sum(c).alias(c) for c in COUNTS],
    ).select("zone", "model", *METRICS, *COUNTS)


def with_all_rows(metrics: DataFrame) -> DataFrame:
    """Zone rows followed by the ALL rows, from one pass over the zone rows."""
    n = F.col("n_rows_scored")
    is_all = F.grouping("zone") == 1
    both = metrics.groupingSets([["zone", "model"], ["model"]], "zone", "model").agg(
        is_all.alias("_all"),
        *[F.when(is_all, F.try_divide(F.sum(F.col(m) * n), F.sum(n))).otherwise(F.max(m)).alias(m) for m in METRICS],
        *[F.sum(c).alias(c) for c in COUNTS])
    return both.withColumn("zone", F.when(F.col("_all"), "ALL").otherwise(F.col("zone"))).select(
        "zone", "model", *METRICS, *COUNTS)


def daily_mape(
    df: DataFrame, models: Mapping[str, str] = MODELS, actual: str = "actual", key: str = "zone",
) -> DataFrame:
    """Mean APE per date, zone and model over realised rows."""
    a = F.col(actual)
    per_day = df.where(is_realized(a)).groupBy(F.to_date("for_date").alias("date"), key).agg(
        *[F.avg(ape_masked(a, F.col(p))).alias(f"daily_mape_{i}") for i, p in enumerate(models.values())])
    return _rows_per_model(per_day, ["date", key], models, ("daily_mape",))


def daily_mape_all_rows(
    df: DataFrame, models: Mapping[str, str] = STANDALONE_MODELS, actual: str = "actual", key: str = "reg",
    digits: int = 4,
) -> DataFrame:
    a = F.col(actual)
    per_day = df.groupBy(F.to_date("for_date").alias("date"), key).agg(
        *[F.round(F.avg(ape(a, F.col(p))), digits).alias(f"MAPE_{i}") for i, p in enumerate(models.values())])
    return _rows_per_model(per_day, ["date", key], models, ("MAPE",))


def daily_peak(df: DataFrame, preds: Mapping[str, str], key: str = "zone") -> DataFrame:
    """Highest prediction per zone and date for each ``output -> column``."""
    return df.groupBy(key, F.to_date("for_date").alias("date")).agg(
        *[F.max(c).alias(o) for o, c in preds.items()])
