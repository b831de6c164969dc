"""As-of join: each row with the last row of another table up to a moment of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.ordered import BUCKET, WEEK, with_bucket


def as_of_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, time: str, values: Sequence[str],
    ties: Sequence[str] = (), strict: bool = False, within: str | None = None, seconds: int = WEEK,
) -> DataFrame:
    """``left`` with ``values`` and ``time`` (as ``<time>_found``) of the last ``right`` row of the same keys
    whose ``time`` is not after ``at`` (``strict``: before it); null where there is none.

    Of several right rows at one time the greatest in ``ties``, then in ``values``, counts. ``within`` (an
    interval such as ``"2 days"``) sets an oldest age. A null key is a key; a null moment finds nothing.

    Both sides meet in time buckets, so no key is in one task: a bucket hands its last right row on,
    and a row that finds nothing in its own bucket takes the last one handed on. One exchange of the
    rows and one of a row per bucket; no row is copied.
    """
    keys, values, ties = list(keys), list(values), [t for t in ties if t not in values]
    found = f"{time}_found"
    hit = F.struct(F.col(time).alias("t"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(ties)], *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    mine = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(left.columns)])
    rows = left.select(*keys, F.col(at).alias("_at"), F.lit(0 if strict else 1).alias("_side"), mine.alias("_left")).unionByName(
        right.where(F.col(time).isNotNull()).select(*keys, F.col(time).alias("_at"), F.lit(1 if strict else 0).alias("_side"), hit.alias("_hit")),
        allowMissingColumns=True)
    rows = with_bucket(rows, keys, ["_at", "_side"], seconds)
    last = rows.groupBy(*keys, BUCKET).agg(F.max("_hit").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(BUCKET).alias("_b"),
                        F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    # times do not decrease within the window, so the greatest hit so far is the last one
    near = F.max("_hit").over(Window.partitionBy(*keys, BUCKET).orderBy("_at", "_side"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col(BUCKET) == F.col("_b")]
    best = F.coalesce(F.col("_near"), F.col("_carry"))
    known = F.col("_at").isNotNull()
    if within:
        known &= best["t"] >= F.col("_at") - F.expr(f"INTERVAL {within}")
    joined = rows.withColumn("_near", near).where("_left is not null").join(carry, on, "left").withColumn("_best", F.when(known, best))
    return joined.select(*[F.col(f"_left.c{i}").alias(c) for i, c in enumerate(left.columns)], F.col("_best.t").alias(found),
                         *[F.col(f"_best.v{i}").alias(c) for i, c in enumerate(values)])
