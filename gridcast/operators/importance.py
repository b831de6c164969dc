"""Feature importance tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_GROUP = ("zone", "model")  # one row per feature, so a group is as wide as the schema, never as long as the data


def corr_importance(
    df: DataFrame, features: Sequence[str], target: str = "requirement", key: str = "zone", model: str = "corr",
) -> DataFrame:
    """Squared correlation with the target per feature; 0 where either is constant.

    Written with covariance and variances: ``corr`` divides by zero on a constant column.
    """
    y = F.col(target)
    aggs = []
    for i, f in enumerate(features):
        x = F.when(y.isNotNull(), F.col(f))
        yy = F.when(F.col(f).isNotNull(), y)
        aggs += [F.covar_pop(x, yy).alias(f"c{i}"), F.var_pop(x).alias(f"vx{i}"), F.var_pop(yy).alias(f"vy{i}")]
    cells = [
        F.struct(F.lit(f).alias("feature"), F.coalesce(F.try_divide(
            F.col(f"c{i}") * F.col(f"c{i}"), F.col(f"vx{i}") * F.col(f"vy{i}")), F.lit(0.0)).alias("importance"))
        for i, f in enumerate(features)
    ]
    return df.groupBy(key).agg(*aggs).select(key, F.lit(model).alias("model"), F.inline(F.array(*cells)))


def importance_pct(df: DataFrame) -> DataFrame:
    total = F.sum("importance").over(Window.partitionBy(*_GROUP))
    share = F.when(total > 0, F.col("importance") / total * 100).otherwise(0.0)
    return df.withColumn("importance_pct", share)


def importance_rank(df: DataFrame) -> DataFrame:
    return df.withColumn("rank", F.rank().over(
        Window.partitionBy(*_GROUP).orderBy(F.col("importance").desc_nulls_last())))


def sort_importance(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*(keys or _GROUP), F.col("importance").desc_nulls_last(), "feature")
