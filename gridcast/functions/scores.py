"""Realised mask, percentage errors and the aggregate expressions built from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.config import APE_FLOOR, PLACEHOLDER_LIMIT


def is_realized(actual: Column) -> Column:
    return F.abs(actual) >= PLACEHOLDER_LIMIT


def ape(actual: Column, pred: Column) -> Column:
    """Absolute percentage error; null when either side is null (``greatest`` skips nulls)."""
    return F.abs(actual - pred) / F.greatest(F.abs(actual), F.lit(APE_FLOOR)) * 100


def ape_masked(actual: Column, pred: Column) -> Column:
    return F.when(is_realized(actual), ape(actual, pred))


def add_ape(df: DataFrame, preds: list[str], actual: str = "actual") -> DataFrame:
    return df.withColumns({f"ape_{p}": ape_masked(F.col(actual), F.col(p)) for p in preds})


def add_row_errors(df: DataFrame, preds: Mapping[str, str], actual: str = "actual") -> DataFrame:
    """abs_error, ape and bias per row for each ``tag -> column``, without the realised mask."""
    a = F.col(actual)
    cols = {}
    for tag, p in preds.items():
        cols[f"abs_error_{tag}"] = F.abs(a - F.col(p))
        cols[f"ape_{tag}"] = ape(a, F.col(p))
        cols[f"bias_{tag}"] = F.col(p) - a
    return df.withColumns(cols)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def finite_or_null(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
