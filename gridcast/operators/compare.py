"""Comparing configurations and experiment arms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.scores import ape, is_realized


def ab_merge(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("zone", "for_date")) -> DataFrame:
    """Rows both arms predict, side by side; daily peaks follow with ``daily_peak``."""
    keys = list(keys)
    left = a.select(*keys, "actual", F.col("pred").alias("pred_A"))
    return left.join(b.select(*keys, F.col("pred").alias("pred_B")), keys)


def config_compare(metrics: DataFrame, first: str = "org", second: str = "tuned") -> DataFrame:
    """Scores of two configs side by side per zone and model, with the winner."""
    fields = ("MAPE", "MAE", "BIAS")
    sides = {first: F.col("config") == first, second: F.col("config") == second}
    wide = metrics.where(F.col("config").isin(first, second)).groupBy("reg", "model").agg(
        *[F.max(F.when(s, F.col(m))).alias(f"{m}_{c}") for m in fields for c, s in sides.items()],
        *[F.count_if(s).alias(f"_{c}") for c, s in sides.items()])
    x, y = F.col(f"MAPE_{first}"), F.col(f"MAPE_{second}")
    return wide.where((F.col(f"_{first}") > 0) & (F.col(f"_{second}") > 0)).select(
        "reg", "model", x, y, F.round(x - y, 4).alias("MAPE_diff"),
        F.when(x < y, first).when(y < x, second).otherwise("tie").alias("winner"),
        *[f"{m}_{c}" for m in fields[1:] for c in sides])


def config_best(
    predictions: DataFrame, comparison: DataFrame, model: str = "Ensemble", on_tie: str = "tuned",
) -> DataFrame:
    """Each zone's predictions under its winning config; a tie keeps ``on_tie``."""
    best = comparison.where(F.col("model") == model).select(
        "reg", F.when(F.col("winner") == "tie", on_tie).otherwise(F.col("winner")).alias("config"))
    return predictions.join(best, ["reg", "config"], "left_semi")


def ablation_ab(df: DataFrame, arms: dict[str, str], key: str = "zone") -> DataFrame:
    """Scores on realised rows and the range of future predictions, per zone and arm."""
    a = F.col("actual")
    aggs = []
    for i, p in enumerate(arms.values()):
        x = F.col(p)
        scored = is_realized(a) & x.isNotNull()
        ahead = F.when(F.abs(a) < 1.0, x)
        aggs += [
            F.avg(F.when(scored, ape(a, x))).alias(f"MAPE_{i}"),
            F.avg(F.when(scored, F.abs(x - a))).alias(f"MAE_{i}"),
            F.avg(F.when(scored, x - a)).alias(f"BIAS_{i}"),
            F.count_if(scored).alias(f"n_scored_{i}"),
            F.min(ahead).alias(f"future_min_{i}"), F.avg(ahead).alias(f"future_mean_{i}"),
            F.max(ahead).alias(f"future_max_{i}"),
        ]
    names = ("MAPE", "MAE", "BIAS", "n_scored", "future_min", "future_mean", "future_max")
    cells = [F.struct(F.lit(arm).alias("arm"), *[F.col(f"{n}_{i}").alias(n) for n in names])
             for i, arm in enumerate(arms)]
    return df.groupBy(key).agg(*aggs).select(key, F.inline(F.array(*cells)))
