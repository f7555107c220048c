"""Linear models of all folds, penalties and training shares in the same passes.

A fit leaves out one fold (or none) and takes a share of the rows (or all). What such a fit needs from the
data are sums over rows, so every pass adds them up for all fits at once:

* ridge: one pass adds up one matrix of products per fold and share; a fit's matrix is the sum of those of
  its rows, whatever its penalty, and is solved on the driver (columns x columns);
* logistic: Newton's method; a pass of an iteration adds up gradient and second derivatives of every fit
  that has not settled. Some six to eight passes settle all of them.

Sums travel as arrays, sixteen partitions to a task and round, so no task and not the driver sees more than
sixteen of them per fit, however many partitions there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

__all__ = ["Fit", "fit_all", "linear_score"]

FAN_IN = 16
MAX_PASSES, SETTLED = 60, 1e-9
_SUMS = "part long, fit int, numbers array<double>"


@dataclass(frozen=True)
class Fit:
    """A fit on the rows whose fold is not ``fold`` (None: all folds) and whose share is at most ``share``.
    ``strength``: C of the logistic model, alpha of ridge."""

    strength: float
    fold: int | None = None
    share: int = 0


def _batch_sum(group: pa.Table) -> pa.Table:
    group = group.sort_by("part")
    total = np.sum([n.values.to_numpy(zero_copy_only=False) for n in group["numbers"]], axis=0)
    return pa.table({"part": pa.array([group["part"][0].as_py() // FAN_IN], pa.int64()),
                     "fit": pa.array([group["fit"][0].as_py()], pa.int32()), "numbers": pa.array([total], pa.list_(pa.float64()))})


def _summed(rows: DataFrame, gather) -> dict[int, np.ndarray]:
    """Sum over all rows of the arrays that ``gather(x, y, w, fold, share)`` returns per number, one number per
    fit or group of rows; the last sums alone reach the driver."""
    def partition(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(0)
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
            y, w, fold, share = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(1, 5))
            for k, numbers in gather(x, y, w, fold, share):
                totals[k] = totals[k] + numbers if k in totals else numbers
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(totals), pa.int64()), pa.array(list(totals), pa.int32()),
                                          pa.array(list(totals.values()), pa.list_(pa.float64()))], names=["part", "fit", "numbers"])

    parts = rows.rdd.getNumPartitions()
    sums = rows.mapInArrow(partition, _SUMS)
    while parts > 1:
        sums = sums.groupBy("fit", F.floor(F.col("part") / FAN_IN)).applyInArrow(_batch_sum, _SUMS)
        parts = -(-parts // FAN_IN)
    return {r.fit: np.array(r.numbers) for r in sums.collect()}


def _rows(df: DataFrame, features: str, label: str, weight: str | None, fold: str | None, share: Column | None) -> DataFrame:
    x = vector_to_array(features) if df.schema[features].dataType.typeName() != "array" else F.col(features)
    return cut_lineage(df.select(x.alias("x"), F.col(label).cast("double").alias("y"),
                                 (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
                                 (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"),
                                 (share if share is not None else F.lit(0)).cast("int").alias("share"))
                       .filter("y IS NOT NULL AND w IS NOT NULL AND fold IS NOT NULL"))


def _solved(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solution of a symmetric system; the shortest one where it is singular."""
    try:
        return np.linalg.solve(matrix, right)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(matrix, right, rcond=None)[0]


def _ridge(rows: DataFrame, fits: list[Fit]) -> list[np.ndarray]:
    """Minimum of sum w (y - xb)^2 + alpha |b|^2; the intercept, last in the result, is free."""
    cells: dict[tuple[int, int], int] = {}
    for c in rows.select("fold", "share").distinct().collect():  # folds x shares
        cells[c.fold, c.share] = len(cells)

    def gather(x, y, w, fold, share):
        full = np.concatenate([x, np.ones((len(x), 1)), y[:, None]], axis=1)
        for (f, s), k in cells.items():
            mine = (fold == f) & (share == s)
            if mine.any():
                yield k, ((full[mine] * w[mine, None]).T @ full[mine]).ravel()

    sums = _summed(rows, gather)
    out = []
    for fit in fits:
        used = [sums[k] for (f, s), k in cells.items() if f != fit.fold and s <= fit.share and k in sums]
        if not used:
            out.append(None)
            continue
        m = np.sum(used, axis=0)
        m = m.reshape(int(np.sqrt(len(m))), -1)
        penalty = np.diag([fit.strength] * (len(m) - 2) + [0.0])
        out.append(_solved(m[:-1, :-1] + penalty, m[:-1, -1]))
    return out


def _logistic(rows: DataFrame, fits: list[Fit]) -> list[np.ndarray]:
    """Minimum of sum w loss + |b|^2 / (2 C) by damped Newton steps; the intercept, last, is free."""
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return [None] * len(fits)
    d = first.d
    beta = np.zeros((len(fits), d + 1))
    step, loss = np.zeros_like(beta), np.full(len(fits), np.inf)
    open_fits = set(range(len(fits)))
    for _ in range(MAX_PASSES):
        here = {k: beta[k] + step[k] for k in open_fits}

        def gather(x, y, w, fold, share, here=here):
            full = np.concatenate([x, np.ones((len(x), 1))], axis=1)
            for k, b in here.items():
                mine = (share <= fits[k].share) & (fold != (fits[k].fold if fits[k].fold is not None else -2))
                if mine.any():
                    a, t, v = full[mine], y[mine], w[mine]
                    z = a @ b
                    p = 0.5 * (1 + np.tanh(z / 2))
                    value = (v * (np.logaddexp(0, z) - t * z)).sum()
                    yield k, np.concatenate([[value], a.T @ (v * (p - t)), ((a * (v * p * (1 - p))[:, None]).T @ a).ravel()])

        sums = _summed(rows, gather)
        for k in sorted(open_fits):
            if k not in sums:  # no row at all
                beta[k] = np.nan
                open_fits.discard(k)
                continue
            penalty = np.append(np.full(d, 1 / fits[k].strength), 0.0)
            value = sums[k][0] + 0.5 * (penalty * here[k] ** 2).sum()
            if value > loss[k] + 1e-9 * abs(loss[k]) and np.abs(step[k]).max() > SETTLED:
                step[k] = step[k] / 2  # too far
                continue
            beta[k], loss[k] = here[k], value
            grad = sums[k][1:d + 2] + penalty * beta[k]
            second = sums[k][d + 2:].reshape(d + 1, d + 1) + np.diag(penalty)
            second[-1, -1] += 1e-12 * max(1.0, second[-1, -1])  # one class only: the intercept has no end
            step[k] = -_solved(second, grad)
            if np.abs(step[k]).max() <= SETTLED * max(1.0, np.abs(beta[k]).max()):
                beta[k] += step[k]
                open_fits.discard(k)
        if not open_fits:
            break
    return [b if np.isfinite(b).all() else None for b in beta]


def fit_all(kind: str, df: DataFrame, fits: list[Fit], features: str = "features", label: str = "target", weight: str | None = None,
            fold: str | None = None, share: Column | None = None) -> list[np.ndarray | None]:
    """Coefficients with the intercept last, per fit (None for a fit without rows). ``kind``: "ridge" or
    "logistic"; ``share``: number of the smallest training share that a row belongs to."""
    rows = _rows(df, features, label, weight, fold, share)
    return (_ridge if kind == "ridge" else _logistic)(rows, fits)


def linear_score(kind: str, features: str, beta: Column) -> Column:
    """Prediction of a row, given the coefficients as an array with the intercept last: class 1's probability
    for the logistic model."""
    products = F.zip_with(vector_to_array(features), beta, lambda a, b: F.coalesce(a, F.lit(1.0)) * b)
    z = F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)
    return z if kind == "ridge" else 1 / (1 + F.exp(-z))
