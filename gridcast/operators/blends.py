"""Ensembles whose weights are learnt from scored rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.config import APE_FLOOR, MIN_ROWS_WEIGHTS
from gridcast.functions.scores import ape
from gridcast.sources.history import scored_history


def inverse_mape_weights(scored: DataFrame, preds: Sequence[str], key: str = "zone") -> DataFrame:
    """Per key: weights proportional to 1 / MAPE, named ``w_<pred>``."""
    mapes = scored.groupBy(key).agg(*[F.avg(ape(F.col("actual"), F.col(p))).alias(p) for p in preds])
    inverse = {p: F.when(F.col(p).isNotNull(), 1.0 / F.greatest(F.col(p), F.lit(APE_FLOOR))) for p in preds}
    total = reduce(add, inverse.values())
    return mapes.select(key, *[(inverse[p] / total).alias(f"w_{p}") for p in preds])


def ens_inverse_mape(
    df: DataFrame, preds: Sequence[str], history: DataFrame | None = None,
    out: str = "pred_ensemble_w", key: str = "zone",
) -> DataFrame:
    """Blend with inverse-MAPE weights from scored history, or from ``df`` itself if none is given."""
    scored = df if history is None else scored_history(history)
    blended = reduce(add, [F.col(f"w_{p}") * F.col(p) for p in preds])
    return df.join(inverse_mape_weights(scored, preds, key), key, "left").withColumn(out, blended).select(
        *df.columns, out)


def weight_search(
    history: DataFrame, preds: Sequence[str], min_rows: int = MIN_ROWS_WEIGHTS, refine: bool = True,
    dedup: str | None = None,
) -> DataFrame:
    """The three weights (at least 0, sum 1) with the least mean error over all scored rows.

    A grid of 231 points in steps of 0.05, then steps of 0.01 around the best one. The error is APE
    with |actual| + 1 below; a missing last model renormalises the others. A task evaluates all
    points for many rows at once and leaves one sum per point. No row comes back below ``min_rows``
    scored rows; a point for which some row has no blend is left out.
    """
    a, b, c = preds
    rows = scored_history(history, dedup).select(*[F.col(x).cast("double") for x in ("actual", *preds)])
    best = _best(rows, preds, [(i, j) for i in range(0, 101, 5) for j in range(0, 101 - i, 5)])
    if refine:
        found = best.first()
        if found:
            near = [(found._i + x, found._j + y) for x in range(-5, 6) for y in range(-5, 6)]
            best = _best(rows, preds, [(i, j) for i, j in near if i >= 0 and j >= 0 and i + j <= 100])
    return best.where(F.col("n_rows_used") >= min_rows).select(
        (F.col("_i") / 100.0).alias(a), (F.col("_j") / 100.0).alias(b),
        ((100 - F.col("_i") - F.col("_j")) / 100.0).alias(c),
        F.round("_mape", 4).alias("mape_at_optimum"), "n_rows_used")


def _best(rows: DataFrame, preds: Sequence[str], points: Sequence[tuple[int, int]]) -> DataFrame:
    """The best of some points (first two weights in hundredths)."""
    w = np.array([(i / 100.0, j / 100.0, (100 - i - j) / 100.0) for i, j in points]).T

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, valid, n = np.zeros(w.shape[1]), np.zeros(w.shape[1], np.int64), 0
        for pdf in batches:
            actual, p = pdf["actual"].to_numpy(float)[:, None], pdf[list(preds)].to_numpy(float)
            with np.errstate(divide="ignore", invalid="ignore"):
                two = (p[:, :2] @ w[:2]) / (w[0] + w[1])
                three = p[:, :2] @ w[:2] + np.nan_to_num(p[:, 2:]) * w[2]
                error = np.abs(np.where(np.isnan(p[:, 2:]), two, three) - actual) / (np.abs(actual) + 1.0) * 100
            known = np.isfinite(error)
            total += np.where(known, error, 0.0).sum(axis=0)
            valid += known.sum(axis=0)
            n += len(pdf)
        if n:
            yield pd.DataFrame({"_i": [i for i, _ in points], "_j": [j for _, j in points], "s": total, "v": valid, "n": n})

    per_point = rows.mapInPandas(sums, "_i int, _j int, s double, v long, n long").groupBy("_i", "_j").agg(
        F.sum("s").alias("s"), F.sum("v").alias("v"), F.sum("n").alias("n_rows_used")).where("v = n_rows_used").withColumn(
        "_mape", F.col("s") / F.col("v"))
    return per_point.agg(F.min_by(
        F.struct("_i", "_j", "_mape", "n_rows_used"),
        F.struct(F.round("_mape", 6), "_i", "_j")).alias("_b")).where(F.col("_b").isNotNull()).select("_b.*")


def weights_row(best: DataFrame, preds: Sequence[str], updated_at: Column) -> DataFrame:
    """A search result in the form the weights table stores."""
    return best.select(
        F.map_from_arrays(F.array(*[F.lit(p) for p in preds]),
                          F.array(*[F.round(p, 4) for p in preds])).alias("weights"),
        "mape_at_optimum", "n_rows_used", updated_at.alias("updated_at"))


def blend_with(df: DataFrame, weights: DataFrame, names: Mapping[str, str] | Sequence[str], out: str) -> DataFrame:
    """Weighted average with weights from a one-row table, read as scalar subqueries."""
    from gridcast.functions.blend import weighted_average

    return df.withColumn(out, weighted_average({p: weights.select(p).scalar() for p in names}))
