"""Forecasters. Each learns every zone at once and returns a prediction column."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.config import SEED, SEQUENCE_LENGTH
from gridcast.operators.features import add_clock_lags, add_sequences


def seasonal_naive(
    df: DataFrame, hours: int = 168, target: str = "requirement", out: str = "pred", unique: bool = False,
) -> DataFrame:
    """The value of the same slot ``hours`` earlier."""
    return add_clock_lags(df, {out: hours}, target, unique=unique)


def zone_ols(
    df: DataFrame, x: str, target: str = "requirement", out: str = "pred", fit: Column | None = None,
) -> DataFrame:
    """One straight line per zone, learnt on the ``fit`` rows (default: the train split)."""
    train = df.where(F.col("split") == "train" if fit is None else fit)
    lines = train.groupBy("zone").agg(F.regr_slope(target, x).alias("_slope"), F.regr_intercept(target, x).alias("_intercept"))
    return df.join(lines, "zone", "left").withColumn(
        out, F.col("_slope") * F.col(x) + F.col("_intercept")).select(*df.columns, out)


class Moments:
    """Row count, means and centred products of some columns; two of them can be merged."""

    def __init__(self, n: float, mean: np.ndarray, products: np.ndarray):
        self.n, self.mean, self.products = n, mean, products

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        if not len(rows):
            return cls(0.0, np.zeros(rows.shape[1]), np.zeros((rows.shape[1],) * 2))
        mean = rows.mean(axis=0)
        return cls(float(len(rows)), mean, (rows - mean).T @ (rows - mean))

    @classmethod
    def read(cls, data: bytes, size: int) -> Moments:
        flat = np.frombuffer(data)
        return cls(float(flat[0]), flat[1:size + 1], flat[size + 1:].reshape(size, size))

    def write(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.products.ravel()]).tobytes()

    def merge(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not other.n or not self.n:
            return self if self.n else other
        step = other.mean - self.mean
        return Moments(n, self.mean + step * (other.n / n),
                       self.products + other.products + np.outer(step, step) * (self.n * other.n / n))


KEYS_HELD = 256  # keys whose moments a task holds before it hands them on


def moments(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, moments) of the rows complete in ``columns``: one block per key and task, then merged.

    A task leaves one row per key, however many rows the key has, so a key that holds most of the
    rows is summed by all tasks alike.
    """
    keys, columns = list(keys), list(columns)
    size = len(columns)
    chosen = df.select(*keys, *[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)])
    key_types = ", ".join(f"`{k}` {chosen.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{key_types}, moments binary"

    def table(held: dict) -> pd.DataFrame:
        return pd.DataFrame([(*k, m.write()) for k, m in held.items()], columns=[*keys, "moments"])

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, Moments] = {}
        for pdf in batches:
            values = pdf[[f"_c{i}" for i in range(size)]].to_numpy(float)
            full = np.isfinite(values).all(axis=1)
            for k, at in pdf.groupby(keys, dropna=False, sort=False).indices.items():
                k = tuple(None if v is None or v != v else v for v in (k if isinstance(k, tuple) else (k,)))
                new = Moments.of(values[at[full[at]]])
                held[k] = held[k].merge(new) if k in held else new
            if len(held) > KEYS_HELD:
                yield table(held)
                held = {}
        if held:
            yield table(held)

    return merged_moments(chosen.mapInPandas(blocks, schema), keys, size)


def merged_moments(parts: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """(keys, moments) with the blocks of each key merged."""
    keys = list(keys)

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        total = Moments.read(pdf["moments"].iloc[0], size)
        for data in pdf["moments"].iloc[1:]:
            total = total.merge(Moments.read(data, size))
        return pdf[keys].iloc[:1].assign(moments=[total.write()])

    return parts.groupBy(*keys).applyInPandas(merged, parts.schema)


def ridge_solve(sums: DataFrame, keys: Sequence[str], k: int, penalties: Sequence[float]) -> DataFrame:
    """(keys, penalty, coef) from moments of [features, target]; ``coef`` is the intercept, then one
    number per feature.

    A key is one short row here. Features are centred and scaled before the penalty applies; a
    constant feature gets coefficient 0.
    """
    keys = list(keys)
    key_types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sums.schema if f.name in keys)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                m = Moments.read(row[-1], k + 1)
                if not m.n:
                    continue
                cov, mean = m.products / m.n, m.mean
                var = np.diag(cov)[:k]
                usable = var > 1e-12 * np.maximum(1.0, mean[:k] ** 2)
                scale = np.where(usable, np.sqrt(np.where(usable, var, 1.0)), 1.0)
                a = cov[:k, :k] / np.outer(scale, scale) * np.outer(usable, usable) + np.diag((~usable).astype(float))
                b = cov[:k, k] / scale * usable
                for penalty in penalties:
                    beta = np.linalg.solve(a + max(penalty, 1e-9) * np.eye(k), b) / scale
                    rows.append((*row[:-1], float(penalty), np.concatenate([[mean[k] - beta @ mean[:k]], beta])))
            if rows:
                yield pd.DataFrame(rows, columns=[*keys, "penalty", "coef"])

    return sums.select(*keys, "moments").mapInPandas(solve, f"{key_types}, penalty double, coef array<double>")


def deviations(sums: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """(keys, scale): the standard deviations of the features, from moments of [features, target]."""
    keys = list(keys)
    key_types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sums.schema if f.name in keys)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [Moments.read(m, k + 1) for m in pdf["moments"]]
            yield pdf[keys].assign(scale=[np.sqrt(np.diag(m.products)[:k] / max(m.n, 1.0)) for m in found])

    return sums.select(*keys, "moments").mapInPandas(read, f"{key_types}, scale array<double>")


def linear_score(coef: Column, features: Sequence[str]) -> Column:
    total = coef[0]
    for i, f in enumerate(features):
        total = total + coef[i + 1] * F.col(f)
    return total


def zone_ridge(
    df: DataFrame, features: Sequence[str], target: str = "requirement", out: str = "pred",
    penalty: float = 1e-3, fit: Column | None = None,
) -> DataFrame:
    """Ridge regression per zone, from merged blocks of moments; any number of features is one column."""
    train = df.where(F.col("split") == "train" if fit is None else fit)
    sums = moments(train, ["zone"], [*features, target])
    coefs = ridge_solve(sums, ["zone"], len(features), [penalty]).select("zone", F.col("coef").alias("_coef"))
    return df.join(coefs, "zone", "left").withColumn(
        out, linear_score(F.col("_coef"), features)).select(*df.columns, out)


def sequence_forecast(
    df: DataFrame, features: Sequence[str], target: str = "requirement", length: int = SEQUENCE_LENGTH,
    out: str = "pred", carry: bool = True, grid: bool = False, penalty: float = 1e-3,
) -> DataFrame:
    """Forecast from a window of ``length`` rows, by ridge on the flattened window.

    Training windows end before their row. With ``carry`` so do test windows, which then begin in
    the train rows; without it test windows include their own row and the first ``length - 1`` test
    rows stay null.
    """
    if carry:
        seq = add_sequences(df, features, length, False, keys=("zone",), grid=grid)
    else:
        train, test = df.where(F.col("split") == "train"), df.where(F.col("split") == "test")
        seq = add_sequences(train, features, length, False, grid=grid).unionByName(
            add_sequences(test, features, length, True, grid=grid))
    flat = {f"_x{i}_{j}": F.col("seq")[i][j] for i in range(length) for j in range(len(features))}
    wide = seq.withColumns(flat)
    return zone_ridge(wide, list(flat), target, out, penalty).select(*df.columns, out)


class GbtFit:
    """Fitted boosted trees: scores rows and reports importances."""

    def __init__(self, model, assembler: VectorAssembler, features: list[str], loads: set[str], scale: DataFrame):
        self.model, self.assembler, self.features, self.loads, self.scale = model, assembler, features, loads, scale

    def predict(self, df: DataFrame, out: str = "pred") -> DataFrame:
        ready = self.assembler.transform(_scaled(df, self.scale, self.features, self.loads))
        return self.model.transform(ready).withColumn(
            out, F.col("_raw") * F.col("_level")).select(*df.columns, out)

    def importance(self, spark, model: str, zone: str = "ALL") -> DataFrame:
        scores = self.model.featureImportances.toArray().tolist()
        rows = [(zone, model, f, float(s)) for f, s in zip(self.features, scores)]
        return spark.createDataFrame(rows, "zone string, model string, feature string, importance double")


def _scaled(df: DataFrame, scale: DataFrame, features: Sequence[str], loads: set[str]) -> DataFrame:
    """Assembler inputs; those in load units are divided by the zone's level."""
    joined = df.join(scale, "zone", "left")
    number = {f: F.col(f).cast("double") for f in features}
    return joined.withColumns({
        # a missing load counts as the zone's mean load; impute first for anything finer
        f"_f_{f}": F.coalesce(c / F.col("_level"), F.lit(1.0)) if f in loads else F.coalesce(c, F.lit(0.0))
        for f, c in number.items()})


def is_load(feature: str) -> bool:
    """Lags of the load and their means, deviations and differences are in load units; ratios are not."""
    name = feature.upper()
    return name.startswith("REQ") and "PCT_CHANGE" not in name


def fit_gbt(
    train: DataFrame, features: Sequence[str], target: str = "requirement", maxIter: int = 10,
    maxDepth: int = 4, stepSize: float = 0.1, subsamplingRate: float = 0.9, seed: int = SEED,
    load_features: Sequence[str] | None = None,
) -> GbtFit:
    """Boosted trees over all zones in one distributed fit.

    Loads (``load_features``, by default told by name) are divided by their zone's mean, so one model serves zones of any size and the number of
    zones does not set the number of jobs. Pass one zone's rows for a model of its own.
    """
    return GbtRows(train, features, target, load_features).fit(maxIter, maxDepth, stepSize, subsamplingRate, seed)


class GbtRows:
    """The rows of a fit, which do not depend on its settings: scaled features and label as ``ready``."""

    def __init__(self, train: DataFrame, features: Sequence[str], target: str = "requirement", load_features: Sequence[str] | None = None):
        self.features = list(features)
        self.loads = {f for f in self.features if is_load(f)} if load_features is None else set(load_features)
        self.scale = train.groupBy("zone").agg(F.avg(target).alias("_mean")).select(
            "zone", F.when(F.abs("_mean") > 1e-9, F.col("_mean")).otherwise(1.0).alias("_level"))
        self.assembler = VectorAssembler(inputCols=[f"_f_{f}" for f in self.features], outputCol="_features")
        self.ready = self.assembler.transform(_scaled(train.where(F.col(target).isNotNull()), self.scale, self.features, self.loads)).select(
            "_features", (F.col(target) / F.col("_level")).alias("_label"))

    def fit(self, maxIter: int, maxDepth: int, stepSize: float, subsamplingRate: float, seed: int) -> GbtFit:
        model = GBTRegressor(
            featuresCol="_features", labelCol="_label", predictionCol="_raw", maxIter=maxIter, maxDepth=maxDepth,
            stepSize=stepSize, subsamplingRate=subsamplingRate, seed=seed).fit(self.ready)
        return GbtFit(model, self.assembler, self.features, self.loads, self.scale)


def trailing_mean(
    df: DataFrame, column: str, length: int, keys: Sequence[str], order: Sequence[str] = ("for_date",),
    grid: bool = False, out: str = "pred",
) -> DataFrame:
    """Mean of the current and the ``length - 1`` rows before; null until there are that many."""
    from gridcast.operators.ordered import drop_halo, local_window, with_halo

    rows = with_halo(df, keys, order, before=length - 1, grid=grid)
    w = local_window(keys, order).rowsBetween(-(length - 1), Window.currentRow)
    return drop_halo(rows.withColumn(out, F.when(F.count(F.lit(1)).over(w) == length, F.avg(column).over(w))))
