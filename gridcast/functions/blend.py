"""Row-wise ensembles of prediction columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(cols: Sequence[Column]) -> Column:
    return reduce(add, cols)


def simple_average(cols: Sequence[str]) -> Column:
    """Mean of the non-null models; null when all are null."""
    total = _sum([F.coalesce(F.col(c), F.lit(0.0)) for c in cols])
    present = _sum([F.col(c).isNotNull().cast("double") for c in cols])
    return F.try_divide(total, present)


def strict_average(cols: Sequence[str]) -> Column:
    """Mean of all models; null as soon as one is null."""
    return _sum([F.col(c) for c in cols]) / float(len(cols))


def weighted_average(weights: Mapping[str, float | Column]) -> Column:
    """Weighted mean renormalised per row over the non-null models; zero weight sum gives null."""
    w = {c: v if isinstance(v, Column) else F.lit(float(v)) for c, v in weights.items()}
    total = _sum([v * F.coalesce(F.col(c), F.lit(0.0)) for c, v in w.items()])
    weight = _sum([F.when(F.col(c).isNotNull(), v).otherwise(0.0) for c, v in w.items()])
    return F.when(weight > 0, F.try_divide(total, weight))
