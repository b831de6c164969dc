"""Grid, lag, rolling, calendar and sequence features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.config import STEP_MINUTES, WEEK_LAG
from gridcast.functions.dates import hours, minutes
from gridcast.operators.ordered import WEEK, drop_halo, local_window, with_halo


def time_grid(
    keys: DataFrame, start: Column, end: Column, key: str = "zone", date: str = "for_date",
    step_minutes: int = STEP_MINUTES,
) -> DataFrame:
    """Every step from ``start`` to ``end`` for each row of ``keys``.

    Built in two stages, days then slots, spread by (key, day) in between: otherwise the slots of a
    key, or of all keys when their list is short, would be made in one task.
    """
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    day = F.expr("INTERVAL 1 DAY")
    days = keys.select(key, start.alias("_lo"), end.alias("_hi")).where("_lo <= _hi").select(
        key, "_hi", F.explode(F.sequence(F.col("_lo"), F.col("_hi"), day)).alias("_from"),
    ).repartition(n, key, "_from")
    last = F.least(F.col("_hi"), F.col("_from") + day - minutes(step_minutes))
    return days.select(key, F.explode(F.sequence(F.col("_from"), last, minutes(step_minutes))).alias(date))


def densify_grid(
    df: DataFrame, values: Mapping[str, float | None], key: str = "zone", date: str = "for_date",
    step_minutes: int = STEP_MINUTES,
) -> DataFrame:
    """Every key on every step between its first and last date; repeated stamps stay.

    ``values`` maps each column to the fill for a missing step.
    """
    spans = df.groupBy(key).agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    grid = time_grid(spans, F.col("_first"), F.col("_last"), key, date, step_minutes)
    filled = [F.col(c) if v is None else F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in values.items()]
    return grid.join(df, [key, date], "left").select(key, date, *filled)


def add_clock_lags(
    df: DataFrame, lags: Mapping[str, int], value: str = "requirement",
    key: str = "zone", date: str = "for_date", unique: bool = False,
) -> DataFrame:
    """For each ``name -> hours``, the value that many hours earlier; null where there is none.

    Each row is sent once per lag to the slot it serves and all lags meet in one aggregate, so any
    number of lags costs one exchange and one join. If (key, date) is ``unique``, rows are sent to
    their own slot as well and the join goes too.
    """
    def sent(own: bool) -> DataFrame:
        shifts = sorted({*lags.values(), *([0] if own else [])})
        return df.select(*[c for c in df.columns if c != date], F.inline(F.array(*[
            F.struct(F.lit(h).alias("_h"), (F.col(date) + hours(h)).alias(date)) for h in shifts])))

    lagged = [F.max(F.when(F.col("_h") == h, F.col(value))).alias(name) for name, h in lags.items()]
    if unique:
        own = [F.max(F.when(F.col("_h") == 0, F.col(c))).alias(c) for c in df.columns if c not in (key, date)]
        here = F.count_if(F.col("_h") == 0).alias("_here")
        once = F.when(F.col("_here") <= 1, F.col("_here") == 1).otherwise(
            F.raise_error(F.lit(f"({key}, {date}) was said to be unique and is not")).cast("boolean"))
        return sent(True).groupBy(key, date).agg(here, *own, *lagged).where(once).select(*df.columns, *lags)
    return df.join(sent(False).groupBy(key, date).agg(*lagged), [key, date], "left").select(*df.columns, *lags)


def add_rolling(
    df: DataFrame, column: str = WEEK_LAG, keys: Sequence[str] = ("zone", "split"),
    order: Sequence[str] = ("for_date",), grid: bool = False, seconds: int = WEEK,
) -> DataFrame:
    """Trailing means over 3 and 6 rows, deviation over 6, difference and relative change."""
    rows = with_halo(df, keys, order, before=5, grid=grid, seconds=seconds)
    w = local_window(keys, order)
    x, prev = F.col(column), F.lag(column).over(w)
    out = rows.withColumns({
        f"{column}_roll_mean_3": F.avg(x).over(w.rowsBetween(-2, 0)),
        f"{column}_roll_mean_6": F.avg(x).over(w.rowsBetween(-5, 0)),
        f"{column}_roll_std_6": F.coalesce(F.stddev_samp(x).over(w.rowsBetween(-5, 0)), F.lit(0.0)),
        f"{column}_diff_1": F.coalesce(x - prev, F.lit(0.0)),
        f"{column}_pct_change_1": F.coalesce(F.try_divide(x - prev, prev), F.lit(0.0)),
    })
    return drop_halo(out)


def add_holidays(
    df: DataFrame, holidays: DataFrame, keys: Sequence[str] = ("zone", "split"),
    order: Sequence[str] = ("for_date",), grid: bool = False, by_day: bool = False,
    seconds: int = WEEK,
) -> DataFrame:
    """is_holiday, and whether the next or previous row (``by_day``: calendar day) is one."""
    flagged = add_is_holiday(df, holidays, order[0])
    if by_day:
        before = add_is_holiday(flagged, holidays, order[0], 1, "is_pre_holiday")
        return add_is_holiday(before, holidays, order[0], -1, "is_post_holiday")
    rows = with_halo(flagged, keys, order, before=1, after=1, grid=grid, seconds=seconds)
    w = local_window(keys, order)
    return drop_halo(rows.withColumns({
        "is_pre_holiday": F.coalesce(F.lead("is_holiday").over(w), F.lit(0)),
        "is_post_holiday": F.coalesce(F.lag("is_holiday").over(w), F.lit(0)),
    }))


def add_is_holiday(
    df: DataFrame, holidays: DataFrame, date: str = "for_date", shift: int = 0, out: str = "is_holiday",
) -> DataFrame:
    days = holidays.select(F.col("date").alias("_day")).distinct().withColumn("_hit", F.lit(1))
    day = F.date_add(F.to_date(date), shift)
    return (
        df.withColumn("_day", day).join(days, "_day", "left")
        .withColumn(out, F.coalesce("_hit", F.lit(0))).select(*df.columns, out)
    )


def add_sequences(
    df: DataFrame, features: Sequence[str], length: int, include_current: bool,
    keys: Sequence[str] = ("zone", "split"), order: Sequence[str] = ("for_date",),
    grid: bool = False, out: str = "seq", seconds: int = WEEK,
) -> DataFrame:
    """The ``length`` feature rows before (or up to) each row; null where the series is shorter.

    Each step is one array of features, so null features do not shorten the sequence.
    """
    first, last = (-(length - 1), 0) if include_current else (-length, -1)
    rows = with_halo(df, keys, order, before=-first, grid=grid, seconds=seconds)
    steps = F.collect_list(F.array(*[F.col(f).cast("double") for f in features])).over(
        local_window(keys, order).rowsBetween(first, last))
    return drop_halo(rows.withColumn(out, F.when(F.size(steps) == length, steps)))


def sequences_fit(df: DataFrame, features: Sequence[str], length: int, **kw) -> DataFrame:
    """Training pairs: sequence of the rows before, target of the row itself."""
    return add_sequences(df, features, length, False, **kw).where(F.col("seq").isNotNull())


def sequences_predict(df: DataFrame, features: Sequence[str], length: int, **kw) -> DataFrame:
    """One row per input row; the first ``length - 1`` have no sequence."""
    return add_sequences(df, features, length, True, **kw)


def sequences_carry(
    df: DataFrame, features: Sequence[str], length: int, key: str = "zone", **kw,
) -> DataFrame:
    """Test sequences that begin in the train rows, so the test split has no warm-up gap.

    The train split ends before the test split begins, so only its last ``length`` rows per key are
    needed; they are picked before any sequence is built.
    """
    order = kw.pop("order", ("for_date",))
    latest = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    tail = df.where(F.col("split") == "train").withColumn("_back", F.row_number().over(latest)).where(
        F.col("_back") <= length).drop("_back")
    return add_sequences(df.where(F.col("split") == "test").unionByName(tail), features, length, False, keys=(key,),
                         order=order, **kw).where(F.col("split") == "test")


def build_features(
    df: DataFrame, holidays: DataFrame, keys: Sequence[str] = ("zone", "split"), grid: bool = False,
) -> DataFrame:
    """Placeholder fill, rolling, change and calendar features in the fixed order."""
    from gridcast.functions.dates import add_calendar_features
    from gridcast.operators.clean import fill_zero_lag, fill_zero_target

    filled = fill_zero_lag(fill_zero_target(df, keys))
    rolled = add_rolling(filled, keys=keys, grid=grid)
    return add_calendar_features(add_holidays(rolled, holidays, keys, grid=grid))
