"""Ridge regression on windows of rows, without ever laying the windows out.

A window of ``length`` rows with k features is one line of ``length * k`` numbers to the regression, and
neighbouring windows share all but one row. So the Gram matrix of the windows is block Toeplitz up to
its edges: block (i, j) is the sum of products of rows j - i apart, from one row to another. The first
block of each diagonal is one matrix product over the rows; the next ones drop a product at the front
and gain one at the back. Predictions add up each row's part for every place it has in a window.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.config import SEQUENCE_LENGTH
from gridcast.operators.forecast import Moments, merged_moments, ridge_solve
from gridcast.operators.ordered import BUCKET, HALO, WEEK, drop_halo, local_window, with_halo


def window_gram(x: np.ndarray, first: int, last: int, length: int) -> np.ndarray:
    """Sum over t = first..last of the outer product of rows t..t + length - 1, laid side by side."""
    n, k = last - first + 1, x.shape[1]
    gram = np.empty((length * k, length * k))
    for d in range(length):
        block = x[first:first + n].T @ x[first + d:first + d + n]
        for i in range(length - d):
            if i:
                a, b = first + i - 1, last + i
                block = block - np.outer(x[a], x[a + d]) + np.outer(x[b], x[b + d])
            gram[i * k:(i + 1) * k, (i + d) * k:(i + d + 1) * k] = block
            gram[(i + d) * k:(i + d + 1) * k, i * k:(i + 1) * k] = block.T
    return gram


def window_moments(x: np.ndarray, y: np.ndarray, use: np.ndarray, length: int, gap: int) -> Moments:
    """Moments of (window, target) over the rows t in ``use`` whose window, the ``length`` rows that end
    ``gap`` rows before t, is complete and finite and whose target is finite."""
    k = x.shape[1]
    fine = np.isfinite(x).all(axis=1)
    start = np.arange(len(x)) - gap - length + 1            # first row of the window of row t
    whole = np.cumsum(np.concatenate(([0], fine)))
    good = use & np.isfinite(y) & (start >= 0)
    at = np.flatnonzero(good)
    at = at[whole[start[at] + length] - whole[start[at]] == length]
    size = length * k + 1
    if not len(at):
        return Moments(0.0, np.zeros(size), np.zeros((size, size)))
    # around a centre near the mean nothing is lost when sums are subtracted below
    centre, level = x[fine].mean(axis=0), float(y[at].mean())
    z, v = np.where(fine[:, None], x - centre, 0.0), y - level
    gram, total, cross = np.zeros((size - 1, size - 1)), np.zeros(size - 1), np.zeros(size - 1)
    for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
        s, e = start[run[0]], start[run[-1]]
        gram += window_gram(z, s, e, length)
        for i in range(length):
            part = z[s + i:e + i + 1]
            total[i * k:(i + 1) * k] += part.sum(axis=0)
            cross[i * k:(i + 1) * k] += part.T @ v[run]
    n, ys = len(at), v[at]
    sums = np.append(total, ys.sum())
    products = np.empty((size, size))
    products[:-1, :-1], products[:-1, -1], products[-1, :-1], products[-1, -1] = gram, cross, cross, ys @ ys
    return Moments(float(n), np.append(np.tile(centre, length), level) + sums / n, products - np.outer(sums, sums) / n)


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The rows of each key, where rows of a key follow each other over any number of batches."""
    open_: list[pd.DataFrame] = []
    last: tuple = ()
    for pdf in batches:
        group = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
        edges = np.flatnonzero(np.diff(group, prepend=-1))
        for s, e in zip(edges.tolist(), [*edges[1:].tolist(), len(pdf)]):
            part = pdf.iloc[s:e]
            own = tuple(None if pd.isna(v) else v for v in part[keys].iloc[0])
            if open_ and own != last:
                yield last, pd.concat(open_)
                open_ = []
            open_.append(part)
            last = own
    if open_:
        yield last, pd.concat(open_)


def sequence_moments(rows: DataFrame, key: str, order: Sequence[str], features: Sequence[str], target: str, length: int, gap: int) -> DataFrame:
    """(key, moments) of all windows. ``rows`` carry buckets, halo rows and ``_fit``; a task sorts its buckets,
    walks through them and leaves one block of moments per key."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_x{i}" for i in range(len(features))]
    chosen = rows.select(
        key, F.col(BUCKET).cast("long").alias(BUCKET), (F.col("_fit") & ~F.col(HALO)).alias("_use"), *order,
        F.col(target).cast("double").alias("_y"), *[F.col(f).cast("double").alias(c) for f, c in zip(features, names)])
    dealt = chosen.repartition(n, key, BUCKET).sortWithinPartitions(key, BUCKET, *[F.col(c).asc_nulls_last() for c in order]).drop(*order)
    schema = f"`{key}` {chosen.schema[key].dataType.simpleString()}, moments binary"

    def table(held: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(k, m.write()) for k, m in held], columns=[key, "moments"])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []  # the key at hand and its moments so far
        for (k, _), whole in _runs(batches, [key, BUCKET]):
            new = window_moments(whole[names].to_numpy(float), whole["_y"].to_numpy(float), whole["_use"].to_numpy(bool), length, gap)
            if held and held[0][0] != k:
                yield table(held)
                held = []
            held = [(k, held[0][1].merge(new) if held else new)]
        if held:
            yield table(held)

    return merged_moments(dealt.mapInPandas(walk, schema), [key], len(features) * length + 1)


def sequence_ridge(
    df: DataFrame, features: Sequence[str], target: str = "requirement", length: int = SEQUENCE_LENGTH, out: str = "pred",
    carry: bool = True, grid: bool = False, penalty: float = 1e-3, order: Sequence[str] = ("for_date",), seconds: int = WEEK,
) -> DataFrame:
    """Forecast from the ``length`` rows of all ``features`` before a row, by ridge over all windows of a zone.

    Training windows end before their row. With ``carry`` so do test windows, which then begin in the
    train rows; without it test windows include their own row, and the first ``length - 1`` test rows stay
    null, as do rows with a null in their window. Equal to :func:`forecast.sequence_forecast`, which lays the windows out.
    """
    coefs = sequence_fit(df, features, target, length, carry, grid, penalty, order, seconds)
    return sequence_predict(df, coefs, features, length, out, carry, grid, order, seconds)


def sequence_sums(df, features, target, length, carry, grid, order=("for_date",), seconds=WEEK) -> DataFrame:
    """(zone, moments) of the train rows and the windows before them."""
    train = F.col("split") == "train"
    keys = ["zone"] if carry else ["zone", "split"]
    rows = with_halo(df if carry else df.where(train), keys, order, before=length, grid=grid, seconds=seconds).withColumn("_fit", train)
    return sequence_moments(rows, "zone", order, features, target, length, 1)


def sequence_fit(df, features, target, length, carry, grid, penalty, order=("for_date",), seconds=WEEK) -> DataFrame:
    """(zone, coef): intercept, then the features of the oldest row of a window, and so on."""
    sums = sequence_sums(df, features, target, length, carry, grid, order, seconds)
    return ridge_solve(sums, ["zone"], len(features) * length, [penalty]).select("zone", "coef")


def sequence_predict(df, coefs, features, length, out="pred", carry=True, grid=False, order=("for_date",), seconds=WEEK) -> DataFrame:
    k = len(features)
    keys = ["zone"] if carry else ["zone", "split"]
    gap = F.when(F.lit(not carry) & (F.col("split") == "test"), 0).otherwise(1)  # rows between a window and its row
    rows = with_halo(df, keys, order, before=length, grid=grid, seconds=seconds)
    scored = rows.join(coefs.withColumnRenamed("coef", "_coef"), "zone", "left")
    # a row's part at place i of a window, and whether it can be in one
    whole = F.array(*[F.col(f).cast("double") for f in features])

    def part(i: int):
        total = F.lit(0.0)
        for j, f in enumerate(features):
            total = total + F.col("_coef")[1 + i * k + j] * F.col(f).cast("double")
        return total

    parts = scored.withColumn("_parts", F.when(~F.exists(whole, lambda v: v.isNull() | F.isnan(v)), F.array(*[part(i) for i in range(length)])))
    w = local_window(keys, order)
    sums = {g: sum(((F.lag("_parts", length - 1 - i + g).over(w) if length - 1 - i + g else F.col("_parts"))[i] for i in range(length)), F.col("_coef")[0])
            for g in ((1,) if carry else (0, 1))}
    pred = sums[1] if carry else F.when(gap == 0, sums[0]).otherwise(sums[1])
    return drop_halo(parts.withColumn(out, pred)).select(*df.columns, out)
