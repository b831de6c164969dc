"""Expanding-window cross-validation over every zone at once.

Rows are numbered along time and cut into blocks. The moments of a block are summed once; the train
set of fold k is the running total of the blocks before it, so no row is copied per fold.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.config import CV_FOLDS
from gridcast.functions.scores import ape, is_realized
from gridcast.operators.forecast import Moments, linear_score, moments, ridge_solve
from gridcast.operators.ordered import BUCKET, WEEK, number_rows, with_bucket


def add_block(
    df: DataFrame, keys: Sequence[str] = ("zone",), order: Sequence[str] = ("for_date",),
    folds: int = CV_FOLDS, seconds: int = WEEK,
) -> DataFrame:
    """``block`` 0 is train only; block k is validated by fold k and trained on by later folds."""
    rows = with_bucket(df, keys, order, seconds)
    numbered = number_rows(rows, keys, order, F.col(BUCKET), "_no", "_total")
    size = F.floor(F.col("_total") / (folds + 1))
    at = F.col("_no") - 1 - (F.col("_total") - size * folds)
    block = F.when((at < 0) | (size == 0), 0).otherwise(F.floor(F.try_divide(at, size)) + 1)
    return numbered.withColumn("block", block.cast("int")).select(*df.columns, "block")


def cv_folds(df: DataFrame, keys: Sequence[str] = ("zone",), folds: int = CV_FOLDS, **kw) -> DataFrame:
    """Each row with every fold it belongs to and its role there."""
    blocks = add_block(df, keys, folds=folds, **kw)
    fold = F.explode(F.sequence(F.greatest(F.col("block"), F.lit(1)), F.lit(folds)))
    return blocks.withColumn("fold", fold).withColumn(
        "role", F.when(F.col("fold") == F.col("block"), "validation").otherwise("train")).drop("block")


def _fold_lines(blocks: DataFrame, x: str, y: str, folds: int) -> DataFrame:
    """(zone, fold, slope and centre of the line) learnt on blocks 0..fold-1.

    Blocks leave counts, means and centred products, which are merged around the mean of the fold's
    blocks, so an offset in either column costs no digits.
    """
    per_block = blocks.groupBy("zone", "block").agg(
        F.regr_count(y, x).alias("n"), F.regr_avgx(y, x).alias("mx"), F.regr_avgy(y, x).alias("my"),
        F.regr_sxx(y, x).alias("sxx"), F.regr_sxy(y, x).alias("sxy")).where("n > 0")
    spread = per_block.withColumn("fold", F.explode(F.sequence(F.col("block") + 1, F.lit(folds + 1)))).where(F.col("fold") <= folds)
    fold = Window.partitionBy("zone", "fold")
    n = F.sum("n").over(fold)
    # means as steps from the first block's, which are small however large the means are
    near = spread.withColumns({c: F.col(m) - F.min_by(m, "block").over(fold) for c, m in {"dx": "mx", "dy": "my"}.items()})
    near = near.withColumns({c: F.sum(F.col("n") * F.col(d)).over(fold) / n for c, d in {"ex": "dx", "ey": "dy"}.items()})
    gx, gy = F.col("dx") - F.col("ex"), F.col("dy") - F.col("ey")
    return near.groupBy("zone", "fold").agg(
        F.try_divide(F.sum(F.col("sxy") + F.col("n") * gx * gy), F.sum(F.col("sxx") + F.col("n") * gx * gx)).alias("_slope"),
        (F.min_by("mx", "block") + F.first("ex")).alias("_mx"), (F.min_by("my", "block") + F.first("ey")).alias("_my"))


def _fold_moments(blocks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Train moments of fold k: those of blocks 0..k-1 merged in turn (a handful of rows per zone)."""
    per_block = moments(blocks, ["zone", "block"], columns)

    def running(pdf: pd.DataFrame) -> pd.DataFrame:
        total, out = None, []
        for row in pdf.sort_values("block").itertuples(index=False):
            block = Moments.read(row.moments, len(columns))
            total = block if total is None else total.merge(block)
            out.append((row.zone, int(row.block) + 1, total.write()))
        return pd.DataFrame(out, columns=["zone", "fold", "moments"])

    zone = blocks.schema["zone"].dataType.simpleString()
    return per_block.groupBy("zone").applyInPandas(running, f"zone {zone}, fold int, moments binary")


def cv_mape(df: DataFrame, x: str, target: str = "requirement", folds: int = CV_FOLDS, **kw) -> DataFrame:
    """Mean validation MAPE per zone of a straight line on ``x``; infinity when no fold scores."""
    blocks = add_block(df, folds=folds, **kw)
    v, y = F.col(x), F.col(target)
    lines = _fold_lines(blocks, x, target, folds)
    scored = (
        blocks.where((F.col("block") > 0) & is_realized(y)).withColumnRenamed("block", "fold")
        .join(lines, ["zone", "fold"])
        .groupBy("zone", "fold").agg(F.avg(ape(y, F.col("_my") + F.col("_slope") * (v - F.col("_mx")))).alias("m"))
    )
    return df.select("zone").distinct().join(
        scored.groupBy("zone").agg(F.avg("m").alias("cv_mape"), F.count("m").alias("n_folds")), "zone", "left",
    ).select("zone", F.coalesce("cv_mape", F.lit(float("inf"))).alias("cv_mape"),
             F.coalesce("n_folds", F.lit(0)).cast("long").alias("n_folds"))


def param_search(
    df: DataFrame, features: Sequence[str], penalties: Sequence[float], target: str = "requirement",
    folds: int = CV_FOLDS, model: str = "ridge", **kw,
) -> DataFrame:
    """Per zone: the penalty with the lowest cross-validated MAPE, all trials scored in one job."""
    blocks = add_block(df, folds=folds, **kw)
    sums = _fold_moments(blocks, [*features, target])
    coefs = ridge_solve(sums, ["zone", "fold"], len(features), penalties)
    trials = coefs.groupBy("zone", "fold").agg(  # one entry per penalty, so the list is as long as the search
        F.array_sort(F.collect_list(F.struct("penalty", "coef"))).alias("trials"))
    y = F.col(target)
    scored = (
        blocks.where((F.col("block") > 0) & is_realized(y)).withColumnRenamed("block", "fold")
        .join(trials, ["zone", "fold"])
        .select("zone", "fold", target, *features, F.inline("trials"))
        .groupBy("zone", "penalty", "fold").agg(
            F.avg(ape(y, linear_score(F.col("coef"), features))).alias("m"))
        .groupBy("zone", "penalty").agg(F.avg("m").alias("m"))
    )
    return scored.groupBy("zone").agg(
        F.lit(model).alias("model"), F.min("m").alias("best_cv_mape"),
        F.min_by("penalty", F.struct("m", "penalty")).alias("best_penalty"),
        F.count("*").alias("n_trials"), F.lit(folds).alias("n_cv_splits"))
