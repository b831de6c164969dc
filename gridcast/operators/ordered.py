"""Ordered operations inside a key that may hold most of the rows.

A window partitioned by the key alone puts a whole key into one task. Here a key is cut into time
buckets. Bounded frames borrow the few rows they need from the neighbouring buckets; unbounded
ones (fills, row numbers) carry one small row per bucket. Results equal the plain window's.

Buckets are weeks (or ``seconds``) by default, which suits series with a steady step. ``EQUAL`` in place
of a width cuts every key into ranges of about equally many rows, however dense some days are and
however many rows lack a date; that costs one more write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridcast.functions.dates import epoch_seconds
from gridcast.session import materialize

BUCKET = "_bucket"
HALO = "_halo"
WEEK = 7 * 86400
EQUAL = 0
_LAST_BUCKET = 2**40


def _asc(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _desc(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in order]


def time_bucket(date: str, seconds: int = WEEK) -> Column:
    """Bucket number of a timestamp; null dates sort last, so they share the last bucket."""
    return F.coalesce(F.floor(epoch_seconds(F.col(date)) / seconds), F.lit(_LAST_BUCKET))


def with_bucket(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], seconds: int = WEEK, ties: Sequence[Column] = (),
) -> DataFrame:
    """``df`` with its bucket, which never decreases along ``order``, then ``ties``, within a key.

    With ``EQUAL`` the rows of all keys are dealt into ranges whose limits Spark takes from a sample of
    them. Rows that are alike in all of these columns may lie in several buckets, so null dates or a
    stamp that repeats without end spread as well; where their order matters, ``ties`` must tell them apart.
    """
    if seconds != EQUAL:
        return df.withColumn(BUCKET, time_bucket(order[0], seconds))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = [*[F.col(k) for k in keys], *_asc(order), *[t.asc_nulls_last() for t in ties]]
    if ties:
        ranges.append(F.xxhash64(F.monotonically_increasing_id()).asc())
    # written, since the limits come from a sample and must not change between uses
    return materialize(df.repartitionByRange(n, *ranges).withColumn(BUCKET, F.spark_partition_id().cast("long")))


def local_window(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, BUCKET).orderBy(*_asc(order))


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col(HALO)).drop(HALO, BUCKET)


def grid_halo(
    df: DataFrame, date: str, before: int = 0, after: int = 0,
    step_minutes: int = 30, seconds: int = WEEK,
) -> DataFrame:
    """Halo for a series that is complete on its grid: n rows back are n steps back.

    Rows near a bucket edge are copied into the neighbouring bucket by a narrow explode, so the
    window needs one exchange.
    """
    step = step_minutes * 60
    if max(before, after) * step > seconds:
        raise ValueError("the halo must be no longer than a bucket")
    own = time_bucket(date, seconds)
    offset = epoch_seconds(F.col(date)) - own * seconds
    copies = [F.struct(own.alias(BUCKET), F.lit(False).alias(HALO))]
    if before:
        copies.append(F.when(offset >= seconds - before * step,
                             F.struct((own + 1).alias(BUCKET), F.lit(True).alias(HALO))))
    if after:
        copies.append(F.when(offset < after * step,
                             F.struct((own - 1).alias(BUCKET), F.lit(True).alias(HALO))))
    cells = F.filter(F.array(*copies), lambda x: x.isNotNull())
    return df.select("*", F.inline(cells))


def row_halo(
    df: DataFrame, keys: Sequence[str], order: Sequence[str],
    before: int = 0, after: int = 0, seconds: int = WEEK,
) -> DataFrame:
    """Halo counted in rows, exact for any series: gaps, repeats and null dates included (with ``EQUAL``,
    rows alike in ``order`` stay in one bucket).

    Only the last ``before`` (first ``after``) rows of a bucket can be needed elsewhere. Those are
    found with a limited row number, which Spark also applies before the shuffle, and sent to each
    bucket they reach by comparing running row counts.
    """
    keys = list(keys)
    tagged = with_bucket(df, keys, order, seconds)
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # one exchange serves the search for edge rows and the caller's window
    rows = tagged.repartition(n_parts, *keys, BUCKET)
    per_key = Window.partitionBy(*keys).orderBy(BUCKET)
    buckets = (
        tagged.groupBy(*keys, BUCKET).agg(F.count("*").alias("_n"))
        .withColumn("_end", F.sum("_n").over(per_key.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )
    parts = [rows.withColumn(HALO, F.lit(False))]

    def borrowed(n: int, forward: bool) -> DataFrame:
        frame = per_key.rowsBetween(1, n) if forward else per_key.rowsBetween(-n, -1)
        near = F.collect_list(F.struct(F.col(BUCKET).alias("to"), F.col("_start"), F.col("_end"))).over(frame)
        reach = buckets.withColumn("_near", near).select(
            *keys, BUCKET, F.col("_start").alias("_own_start"), F.col("_end").alias("_own_end"), "_near")
        ranked = rows.withColumn("_rank", F.row_number().over(
            Window.partitionBy(*keys, BUCKET).orderBy(*(_desc(order) if forward else _asc(order)))))
        edge = ranked.where(F.col("_rank") <= n).alias("e")
        on = [F.col(f"e.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, BUCKET)]
        joined = edge.join(reach.alias("r"), on)
        if forward:
            wanted = F.filter("_near", lambda x: F.col("_rank") + x["_start"] - F.col("_own_end") <= n)
        else:
            wanted = F.filter("_near", lambda x: F.col("_rank") + F.col("_own_start") - x["_end"] <= n)
        return (
            joined.select(*[F.col(f"e.{c}").alias(c) for c in df.columns], F.explode(wanted).alias("_w"))
            .select(*df.columns, F.col("_w.to").alias(BUCKET), F.lit(True).alias(HALO))
        )

    if before:
        parts.append(borrowed(before, True).repartition(n_parts, *keys, BUCKET))
    if after:
        parts.append(borrowed(after, False).repartition(n_parts, *keys, BUCKET))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_halo(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], before: int = 0, after: int = 0,
    grid: bool = False, seconds: int = WEEK, step_minutes: int = 30,
) -> DataFrame:
    if grid:
        return grid_halo(df, order[0], before, after, step_minutes, seconds)
    return row_halo(df, keys, order, before, after, seconds)


def fill_both_ways(
    df: DataFrame, column: str, value: Column, keys: Sequence[str], order: Sequence[str],
    seconds: int = WEEK,
) -> DataFrame:
    """Replace ``column`` by ``value`` filled forward, then backward, along ``order`` per key.

    Rows alike in ``order`` go by value, those without one last. So the result does not depend on how
    rows arrive: a row without a value takes the largest one of its own stamp, else the last before.
    """
    keys = list(keys)
    valued = df.withColumn("_v", value)
    rows = with_bucket(valued, keys, order, seconds, [F.col("_v")])
    dated = F.coalesce(F.col(order[0]), F.lit("9999-12-31").cast("timestamp_ntz"))
    known = F.when(F.col("_v").isNotNull(), F.struct(dated, *order[1:], "_v"))
    edges = rows.groupBy(*keys, BUCKET).agg(
        F.max_by("_v", known).alias("_last"), F.min_by("_v", known).alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.col(BUCKET).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = edges.select(
        *keys, BUCKET, "_first",
        F.last("_last", ignorenulls=True).over(earlier).alias("_carry"),
        F.last("_first", ignorenulls=True).over(later).alias("_ahead"),
    )
    # a row with nothing before it in its bucket lies before the bucket's first known value, so
    # looking ahead needs no second window
    local = F.last("_v", ignorenulls=True).over(
        local_window(keys, [*order, "_v"]).rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.join(carry, [*keys, BUCKET], "left")
        .withColumn(column, F.coalesce(local, F.col("_carry"), F.col("_first"), F.col("_ahead")))
        .select(*df.columns)
    )


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
    out: str = "row_no", total: str | None = None,
) -> DataFrame:
    """Row number within each key (from 1), and optionally the key's row count.

    ``bucket`` must not decrease along ``order``; rows are numbered inside a bucket and shifted by
    the number of rows in earlier buckets.
    """
    keys = list(keys)
    rows = df.withColumn(BUCKET, bucket)
    per_key = Window.partitionBy(*keys).orderBy(BUCKET)
    offsets = rows.groupBy(*keys, BUCKET).agg(F.count("*").alias("_n")).select(
        *keys, BUCKET,
        (F.sum("_n").over(per_key.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
    )
    renamed = offsets.withColumnsRenamed({k: f"_o{i}" for i, k in enumerate((*keys, BUCKET))})
    on = [F.col(k).eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate((*keys, BUCKET))]  # a null key is a key
    numbered = rows.join(renamed, on).withColumn(
        out, (F.col("_before") + F.row_number().over(local_window(keys, order))).cast("long"))
    extra = [F.col("_total").alias(total)] if total else []
    return numbered.select(*df.columns, out, *extra)
