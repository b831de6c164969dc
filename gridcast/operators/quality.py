"""Row counts, missing cells, duplicate stamps, placeholders and gaps per split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.config import STEP_MINUTES
from gridcast.operators.ordered import BUCKET, WEEK, local_window, time_bucket

CHECKS = ("rows", "missing_total", "duplicate_dates", "target_zero_count")


def diagnostics(
    df: DataFrame, features: Sequence[str], key: str = "zone", split: str = "split",
    date: str = "for_date", target: str = "requirement",
) -> DataFrame:
    """Long (zone, check, value) table.

    Stamps are counted first, so duplicates need no distinct set of a zone's dates in one place.
    """
    columns = [c for c in df.columns if c != split]
    missing = reduce(add, [F.col(c).isNull().cast("long") for c in columns])
    per_date = df.groupBy(key, split, date).agg(
        F.count("*").alias("n"), F.sum(missing).alias("missing"),
        F.count_if(F.col(target) == 0).alias("zero"))
    per_split = per_date.groupBy(key, split).agg(
        F.sum("n").alias("rows"), F.sum("missing").alias("missing_total"),
        F.sum(F.col("n") - 1).alias("duplicate_dates"), F.sum("zero").alias("target_zero_count"))
    wide = per_split.groupBy(key).agg(*[
        F.coalesce(F.sum(F.when(F.col(split) == s, F.col(c))), F.lit(0)).alias(f"{s}_{c}")
        for c in CHECKS for s in ("train", "test")])
    names = [f"{s}_{c}" for c in CHECKS for s in ("train", "test")]
    cells = [F.struct(F.lit(n).alias("check"), F.col(n).cast("long").alias("value")) for n in names]
    cells.append(F.struct(F.lit("feature_count").alias("check"), F.lit(len(features)).cast("long").alias("value")))
    return wide.select(key, F.inline(F.array(*cells)))


def timegap_count(
    df: DataFrame, keys: Sequence[str] = ("zone", "split"), date: str = "for_date",
    step_minutes: int = STEP_MINUTES, seconds: int = WEEK,
) -> DataFrame:
    """Steps longer than one and a half grid steps, per key.

    Gaps inside a time bucket are counted there; those between buckets from each bucket's ends.
    """
    keys = list(keys)
    limit = F.expr(f"INTERVAL {int(step_minutes * 90)} SECONDS")
    rows = df.where(F.col(date).isNotNull()).select(*keys, date).withColumn(BUCKET, time_bucket(date, seconds))
    before = F.lag(date).over(local_window(keys, [date]))
    per_bucket = rows.withColumn("_gap", F.col(date) - before > limit).groupBy(*keys, BUCKET).agg(
        F.count_if("_gap").alias("_gaps"), F.min(date).alias("_first"), F.max(date).alias("_last"))
    previous = F.lag("_last").over(Window.partitionBy(*keys).orderBy(BUCKET))
    return per_bucket.withColumn("_edge", F.col("_first") - previous > limit).groupBy(*keys).agg(
        (F.sum("_gaps") + F.count_if("_edge")).alias("time_gaps_30min"))


def validate_split(
    df: DataFrame, columns: Sequence[str], lags: Sequence[str], keys: Sequence[str] = ("zone", "split"),
    date: str = "for_date", step_minutes: int = STEP_MINUTES, seconds: int = WEEK,
) -> DataFrame:
    """Missing cells, zero lags, duplicates, gaps and date range per zone and split."""
    keys = list(keys)
    zero_lag = reduce(or_, [F.coalesce(F.col(c) == 0, F.lit(False)) for c in lags]) if lags else F.lit(False)
    per_date = df.groupBy(*keys, date).agg(
        F.count("*").alias("n"), F.count_if(zero_lag).alias("zero"),
        *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)])
    miss = [f"m{i}" for i in range(len(columns))]
    stats = per_date.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"), *[F.sum(m).alias(m) for m in miss], F.sum("zero").alias("zero_lag_rows"),
        F.sum(F.col("n") - 1).alias("duplicate_timestamps"),
        F.to_date(F.min(date)).alias("date_min"), F.to_date(F.max(date)).alias("date_max"))
    gaps = timegap_count(per_date, keys, date, step_minutes, seconds)
    total = reduce(add, [F.col(m) for m in miss])
    affected = reduce(add, [(F.col(m) > 0).cast("int") for m in miss])
    return stats.join(gaps, keys, "left").select(
        *keys, "n_rows", total.alias("total_missing"), affected.cast("long").alias("cols_with_missing"),
        "zero_lag_rows", "duplicate_timestamps",
        F.coalesce("time_gaps_30min", F.lit(0)).cast("long").alias("time_gaps_30min"), "date_min", "date_max")
