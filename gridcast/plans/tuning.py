"""Parameter searches per zone by expanding-window cross-validation."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast import config as C
from gridcast.operators.cv import param_search
from gridcast.operators.halving import halving_search
from gridcast.operators.models import TreeForecaster
from gridcast.plans.daily import prepare
from gridcast.sources.tables import write_table


def tune(
    series: DataFrame, holidays: DataFrame, penalties: Sequence[float], path: str | None = None,
    folds: int = C.CV_FOLDS,
) -> DataFrame:
    """Best penalty and its CV MAPE per zone; written to ``path`` if given."""
    table, names = prepare(series, holidays)
    best = param_search(table.where(F.col("split") == "train"), names, penalties, folds=folds)
    if path:
        write_table(best, path)
    return best


def tree_trials(n: int, seed: int = C.SEED) -> list[dict[str, object]]:
    """``n`` settings drawn at random around the full one: trees, depth, learning rate, row sample."""
    r = random.Random(seed)
    return [{"trees": r.randrange(100, 1001, 50), "depth": r.randrange(3, 11), "step": round(math.exp(r.uniform(math.log(0.01), math.log(0.2))), 4),
             "sample": round(r.uniform(0.6, 1.0), 2)} for _ in range(n)]


def tune_trees(
    series: DataFrame, holidays: DataFrame, trials: Sequence[Mapping[str, object]], path: str | None = None,
    folds: int = C.CV_FOLDS, eta: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """Best tree settings per zone and the ledger of all trials and rungs; both written if a path is given."""
    table, names = prepare(series, holidays)
    best, ledger = halving_search(table.where(F.col("split") == "train"), TreeForecaster(), names, trials, folds=folds, eta=eta)
    if path:
        write_table(best, f"{path}/best")
        write_table(ledger, f"{path}/ledger")
    return best, ledger
