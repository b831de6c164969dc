"""Exact medians per key without collecting a key's values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SKETCH = 10000


def exact_median(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key with the interpolated median of each column (nulls ignored).

    A mergeable sketch brackets the middle of each column. Counting the cells below, inside and
    above the bracket tells in which of these three parts the middle ranks lie, so the answer does
    not rest on the sketch's accuracy; only the cells of those parts are grouped by value and
    ranked. Columns are told apart by position.
    """
    keys, columns = list(keys), list(columns)
    cells = df.select(*keys, *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    ids = range(len(columns))
    margin = 2.0 / _SKETCH
    brackets = cells.groupBy(*keys).agg(*[
        F.percentile_approx(f"c{i}", [0.5 - margin, 0.5 + margin], _SKETCH).alias(f"b{i}") for i in ids])

    def part(i: int):
        c = F.col(f"c{i}")
        return F.when(c < F.col(f"b{i}")[0], 0).when(c <= F.col(f"b{i}")[1], 1).when(c.isNotNull(), 2)

    placed = cells.join(brackets, keys)
    counts = placed.groupBy(*keys).agg(*[
        F.count_if(part(i) == p).alias(f"n{i}_{p}") for i in ids for p in (0, 1, 2)])
    ranks = []
    for i in ids:
        n = F.col(f"n{i}_0") + F.col(f"n{i}_1") + F.col(f"n{i}_2")
        ranks += [F.floor((n + 1) / 2).alias(f"lo{i}"), (F.floor(n / 2) + 1).alias(f"hi{i}")]
    ranked = counts.select("*", *ranks)

    def wanted(i: int):
        start = [F.lit(0), F.col(f"n{i}_0"), F.col(f"n{i}_0") + F.col(f"n{i}_1")]
        cell = None
        for p in (0, 1, 2):
            holds = [(F.col(f"{r}{i}") > start[p]) & (F.col(f"{r}{i}") <= start[p] + F.col(f"n{i}_{p}"))
                     for r in ("lo", "hi")]
            hit = (part(i) == p) & (holds[0] | holds[1])
            value = F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("v"), start[p].alias("start"),
                             F.lit(p).alias("p"), F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"))
            cell = F.when(hit, value) if cell is None else cell.when(hit, value)
        return cell

    bounds = brackets.join(ranked, keys)
    middle = (
        cells.join(bounds, keys)
        .select(*keys, F.inline(F.filter(F.array(*[wanted(i) for i in ids]), lambda x: x.isNotNull())))
        .groupBy(*keys, "i", "p", "start", "lo", "hi", "v").agg(F.count("*").alias("n"))
    )
    w = Window.partitionBy(*keys, "i", "p").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = middle.withColumn("upto", F.col("start") + F.sum("n").over(w))
    holds_lo = (F.col("lo") <= F.col("upto")) & (F.col("lo") > F.col("upto") - F.col("n"))
    holds_hi = (F.col("hi") <= F.col("upto")) & (F.col("hi") > F.col("upto") - F.col("n"))
    picked = [
        (F.max(F.when(holds_lo & (F.col("i") == i), F.col("v")))
         + F.max(F.when(holds_hi & (F.col("i") == i), F.col("v")))) / 2
        for i in ids
    ]
    medians = upto.where(holds_lo | holds_hi).groupBy(*keys).agg(
        *[p.alias(c) for p, c in zip(picked, columns)])
    return brackets.select(*keys).join(medians, keys, "left")
