"""Row slices by date and realisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.dates import hours, on_day
from gridcast.functions.scores import is_realized


def realized(df: DataFrame) -> DataFrame:
    return df.where(is_realized(F.col("actual")))


def today(df: DataFrame, run_date: str) -> DataFrame:
    return df.where(on_day(F.col("for_date"), run_date))


def yesterday(df: DataFrame, run_date: str) -> DataFrame:
    return df.where(on_day(F.col("for_date"), run_date, -1))


def future(df: DataFrame) -> DataFrame:
    return df.where(F.abs("actual") < 1.0)


def future_standalone(df: DataFrame, run_date: str) -> DataFrame:
    """Rows without an actual, or dated after the run date."""
    after = F.date_add(F.lit(run_date).cast("date"), 1).cast("timestamp_ntz")
    return df.where(F.col("actual").isNull() | (F.col("for_date") >= after))


def latest_per_zone(df: DataFrame) -> DataFrame:
    """Rows on each zone's last date; an aggregate and a join, so no zone is sorted as a whole."""
    last = df.groupBy("zone").agg(F.max("for_date").alias("_last"))
    start = F.to_date("_last").cast("timestamp_ntz")
    return df.join(last, "zone").where(F.col("for_date") >= start).drop("_last")


def latest_global(df: DataFrame) -> DataFrame:
    """Rows on the last date overall; the date is a scalar subquery."""
    last = df.select(F.to_date(F.max("for_date")).cast("timestamp_ntz")).scalar()
    return df.where((F.col("for_date") >= last) & (F.col("for_date") < last + hours(24)))
