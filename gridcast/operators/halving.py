"""Successive halving: many settings on few folds, few settings on many folds.

Trials are rows. A rung scores every trial that is still in the running in some zone on the folds it
adds, and each zone then keeps the better part of its own trials. One fit serves all zones, so a trial
costs one fit per fold however many zones there are, and none once no zone is interested in it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.config import CV_FOLDS
from gridcast.functions.scores import ape, is_realized
from gridcast.operators.cv import add_block
from gridcast.session import materialize


def rung_folds(folds: int, eta: int) -> list[int]:
    """How many folds each rung has seen: 1, eta, eta^2, ... and all of them at the end."""
    out, n = [], 1
    while n < folds:
        out.append(n)
        n *= eta
    return [*out, folds]


def halving_search(
    df: DataFrame, estimator: Estimator, features: Sequence[str], trials: Sequence[Mapping[str, object]],
    target: str = "requirement", folds: int = CV_FOLDS, eta: int = 2, keep: int = 1, **kw,
) -> tuple[DataFrame, DataFrame]:
    """(best, ledger). ``trials`` are settings of ``estimator``'s params by name; ``df`` has the train rows.

    ``ledger``: (rung, folds, trial, zone, cv_mape, n_folds, kept), one row for every trial a zone looked at
    in a rung. ``best``: (zone, trial, best_cv_mape, n_trials, n_fits). A fold is validated by a model of all
    earlier blocks; a trial's score is its mean over the folds seen that have realised rows, infinity if
    none has. Ties go to the earlier trial. At least ``keep`` trials reach the last rung.
    """
    blocks = materialize(add_block(df.drop("split") if "split" in df.columns else df, folds=folds, **kw))
    zones = materialize(blocks.select("zone").distinct())
    alive = zones.select("zone", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(trials) - 1).cast("long"))).alias("trial"))
    scores, ledger, done, fits = None, None, 0, 0
    rungs = rung_folds(folds, eta)
    for rung, upto in enumerate(rungs):
        alive = materialize(alive)
        running = sorted(r.trial for r in alive.select("trial").distinct().collect())
        # a trial that is back in no zone is not fitted; one that lived on has the earlier folds already
        parts = [part.withColumn("trial", F.lit(t).cast("long")) for fold in range(done + 1, upto + 1)
                 for t, part in zip(running, _scored(blocks, estimator, features, target, [trials[t] for t in running], fold))]
        fits += len(parts)
        for part in parts:
            scores = materialize(part) if scores is None else scores.unionByName(materialize(part))
        done = upto
        mean = scores.groupBy("zone", "trial").agg(F.avg("m").alias("m"), F.count("m").alias("n"))
        placed = alive.join(mean, ["zone", "trial"], "left").select(
            "zone", "trial", F.coalesce("m", F.lit(float("inf"))).alias("cv_mape"), F.coalesce("n", F.lit(0)).cast("long").alias("n_folds"))
        zone = Window.partitionBy("zone")
        place, count = F.row_number().over(zone.orderBy("cv_mape", "trial")), F.count("*").over(zone)
        limit = F.lit(1) if rung == len(rungs) - 1 else F.greatest(F.lit(keep), F.ceil(count / eta))
        seen = materialize(placed.select(F.lit(rung).alias("rung"), F.lit(upto).alias("folds"), "trial", "zone", "cv_mape", "n_folds",
                                         (place <= limit).alias("kept")))
        ledger = seen if ledger is None else ledger.unionByName(seen)
        alive = seen.where("kept").select("zone", "trial")
    best = seen.where("kept").select("zone", "trial", F.col("cv_mape").alias("best_cv_mape"), F.lit(len(trials)).alias("n_trials"), F.lit(fits).alias("n_fits"))
    return best, ledger


def _scored(blocks: DataFrame, estimator: Estimator, features: Sequence[str], target: str, settings: Sequence[Mapping[str, object]],
            fold: int) -> list[DataFrame]:
    """(zone, m) for each setting: the fold's MAPE. One call fits all settings, so that an estimator can prepare
    the fold's rows for all of them at once."""
    rows = blocks.where(F.col("block") <= fold).withColumn("split", F.when(F.col("block") < fold, "train").otherwise("test"))
    own = estimator.copy()
    own._set(features=list(features), target=target, out="_pred")
    maps = [{p: p.typeConverter(v) for p, v in ((own.getParam(name), v) for name, v in setting.items())} for setting in settings]
    y = F.col(target)
    out = []
    for model in own.fit(rows, maps):
        scored = model.transform(rows).where(F.col("split") == "test")
        out.append(scored.where(is_realized(y)).groupBy("zone").agg(F.avg(ape(y, F.col("_pred"))).alias("m")))
    return out


def full_search(df: DataFrame, estimator: Estimator, features: Sequence[str], trials: Sequence[Mapping[str, object]], **kw) -> DataFrame:
    """Every trial on every fold, in one rung: what halving is compared with."""
    best, _ = halving_search(df, estimator, features, trials, eta=kw.get("folds", CV_FOLDS), keep=len(trials), **kw)
    return best
