"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRICT_FORMAT = "dd/MM/yyyy HH:mm:ss"
LENIENT_FORMATS = ("d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def parse_for_date(text: Column) -> Column:
    """Day-first text to timestamp; tries the strict format, then lenient ones, else null."""
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in (STRICT_FORMAT, *LENIENT_FORMATS)]
    return F.coalesce(*tries).cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Wall-clock seconds since 1970, the same in every session time zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def hours(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} HOURS")


def minutes(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} MINUTES")


def timestamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def on_day(ts: Column, day: str, offset: int = 0) -> Column:
    """``ts`` falls on ``day + offset``, as a half-open range that Parquet statistics can prune."""
    start = F.date_add(F.lit(day).cast("date"), offset).cast("timestamp_ntz")
    return (ts >= start) & (ts < start + hours(24))


def add_basic_time_features(df: DataFrame, date: str = "for_date") -> DataFrame:
    d = F.col(date)
    return df.withColumns({
        "year_auto": F.year(d),
        "month_auto": F.month(d),
        "day_auto": F.dayofmonth(d),
        "hour_auto": F.hour(d),
        "dayofweek_auto": F.weekday(d),
    })


def add_calendar_features(df: DataFrame, date: str = "for_date") -> DataFrame:
    d = F.col(date)
    return df.withColumns({
        "is_weekend": F.coalesce(F.weekday(d).isin(5, 6), F.lit(False)).cast("int"),
        "day_of_week": F.weekday(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
    })
