"""Whitening of vectors along the eigenvectors of their covariance.

Method: incremental eigendecomposition. Every partition keeps count, mean and spectrum of its scatter
matrix and applies each vector as one centred rank-one update: the secular equation gives the new
eigenvalues (all roots at once, rational steps inside a bracket), entries without weight and equal
eigenvalues are deflated first, and the eigenvectors come from the recomputed weights of Gu and Eisenstat.
Two spectra are combined by one update for the distance of their means and one per eigenpair, sixteen
partitions a group and round. The result is a basis near the eigenvectors; one distributed Rayleigh-Ritz
step in the whole basis, over vectors centred with the exact mean, makes it right to double precision.

State is d x d numbers per partition, 16 of them in a merging task and one on the driver, whatever the rows.

Defined cases: rows whose vector is null or empty or holds a null, non-finite or over 2^30 large entry are
left out; vectors of different length are whitened apart, each length with a fit of its own; a component
without variance has a null ``whitened`` (and no part in ``identity_error``); ``deviation`` is null where it
leaves the range of a long; repeated rows and null ids are rows like others; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

#: Entries become floor(STEP * entry) + SHIFT.
STEP, SHIFT = 1024, 100_000
LARGEST = float(1 << 30)
FAN_IN = 16
EPS = np.finfo(float).eps
_STATE = "part long, d int, numbers array<double>"
_SPLIT = 1 << 40


def integers(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x): every whole vector with its entries as integers."""
    c = F.col(vector)
    whole = F.forall(c, lambda e: F.coalesce(F.abs(e.cast("double")) <= LARGEST, F.lit(False)) & ~F.isnan(e))
    return df.where(c.isNotNull() & (F.size(c) > 0) & whole).select(
        "vec_id", F.transform(c, lambda e: F.floor(F.lit(float(STEP)) * e.cast("double")) + F.lit(SHIFT)).alias("x"))


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - root)) = 0 for rising poles and positive weights.

    Returns (roots, gap) with gap[i, j] = root j - pole i to full relative accuracy: each root is kept as
    its distance from the nearer of the two poles around it.
    """
    k = len(poles)
    top = poles[-1] + weights.sum()
    right = np.append(poles[1:], top)
    width = right - poles
    middle = poles + width / 2
    at_middle = 1 + (weights[:, None] / (poles[:, None] - middle)).sum(axis=0)
    from_left = at_middle >= 0
    from_left[-1] = True
    origin = np.where(from_left, poles, right)
    low = np.where(from_left, 0.0, -width / 2)
    high = np.where(from_left, width / 2, 0.0)
    high[-1] = width[-1]
    if at_middle[-1] < 0:
        low[-1] = width[-1] / 2
    from_origin = poles[:, None] - origin
    tau = (low + high) / 2
    below = np.tri(k, dtype=bool).T  # poles up to the root's own
    near, far = poles - origin, right - origin
    todo = np.arange(k)
    for _ in range(60):
        gap = from_origin[:, todo] - tau[todo]
        term = weights[:, None] / gap
        f = 1 + term.sum(axis=0)
        slope = term / gap
        left_slope = np.where(below[:, todo], slope, 0.0).sum(axis=0)
        total = slope.sum(axis=0)
        done = np.abs(f) <= 4 * EPS * (1 + np.abs(term).sum(axis=0))
        low[todo] = np.where(f < 0, tau[todo], low[todo])
        high[todo] = np.where(f >= 0, tau[todo], high[todo])
        a, b = near[todo] - tau[todo], far[todo] - tau[todo]
        c = f - a * left_slope - b * (total - left_slope)
        p, q = (a + b) * f - a * b * total, a * b * f
        root = np.sqrt(np.maximum(p * p - 4 * q * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
        moved = tau[todo] + step
        inside = (moved > low[todo]) & (moved < high[todo])
        half = (low[todo] + high[todo]) / 2
        moved = np.where(inside, moved, half)
        done |= (half <= low[todo]) | (half >= high[todo]) | (np.abs(moved - tau[todo]) <= EPS * np.abs(moved))
        tau[todo] = np.where(done, tau[todo], moved)
        todo = todo[~done]
        if not len(todo):
            break
    return origin + tau, tau - from_origin


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum (rising values, vectors as columns) of the matrix plus rho v v^T, for rho >= 0."""
    z = np.sqrt(rho) * (v @ vectors)
    norm = np.sqrt(z @ z)
    if not norm > 0:
        return values, vectors
    tol = 8 * EPS * max(abs(values[-1]), norm * norm)
    active = np.flatnonzero(np.abs(z) * norm > tol)
    gaps, za = np.diff(values[active]), z[active]
    if np.any(gaps * np.abs(za[:-1] * za[1:]) <= tol * (za[:-1] ** 2 + za[1:] ** 2)):
        values, vectors, z = values.copy(), vectors.copy(), z.copy()
        kept = [active[0]]
        for j in active[1:]:  # equal eigenvalues: turn the pair so that the first has no weight
            i = kept[-1]
            r = np.hypot(z[i], z[j])
            c, s = z[j] / r, z[i] / r
            if (values[j] - values[i]) * abs(c * s) <= tol:
                vectors[:, [i, j]] = np.stack([c * vectors[:, i] - s * vectors[:, j], s * vectors[:, i] + c * vectors[:, j]], axis=1)
                values[i], values[j] = c * c * values[i] + s * s * values[j], s * s * values[i] + c * c * values[j]
                z[i], z[j] = 0.0, r
                kept[-1] = j
            else:
                kept.append(j)
        active = np.asarray(kept)
        active = active[np.argsort(values[active], kind="stable")]
    poles, w = values[active], z[active]
    if not len(active):
        return values, vectors
    roots, gap = secular_roots(poles, w * w)
    k = len(active)
    apart = poles[None, :] - poles[:, None]
    # ratios whose product is the squared weight for which the found roots are exact
    lower = np.tri(k, k, -1, dtype=bool)
    against = np.where(lower, apart, np.concatenate([apart[:, 1:], np.ones((k, 1))], axis=1))
    exact = np.sqrt(np.abs(np.prod(gap / against, axis=1))) * np.sign(w)
    turn = exact[:, None] / gap
    turn /= np.sqrt((turn * turn).sum(axis=0))
    if k == len(values):
        return roots, vectors[:, active] @ turn
    values, vectors = values.copy(), vectors.copy()
    values[active], vectors[:, active] = roots, vectors[:, active] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, exact sums, mean and spectrum of the scatter matrix of vectors of one length."""

    def __init__(self, d: int):
        self.n, self.sums = 0, [0] * d
        self.mean, self.values, self.vectors = np.zeros(d), np.zeros(d), np.eye(d)

    def add(self, x: np.ndarray) -> None:
        """One centred rank-one update per row of the integers ``x``."""
        self.sums = [a + b for a, b in zip(self.sums, x.sum(axis=0).tolist())]
        for row in x.astype(float):
            off = row - self.mean
            self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n / (self.n + 1))
            self.n += 1
            self.mean = self.mean + off / self.n

    def merge(self, other: Spectrum) -> None:
        n = self.n + other.n
        off = other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n * other.n / n)
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, value)
        self.mean = self.mean + off * (other.n / n)
        self.n, self.sums = n, [a + b for a, b in zip(self.sums, other.sums)]

    def packed(self) -> np.ndarray:
        """The state as doubles; a sum is two of them, both exact."""
        halves = [divmod(s, _SPLIT) for s in self.sums]
        return np.concatenate([[self.n], [h for h, _ in halves], [s for _, s in halves], self.mean, self.values,
                               self.vectors.ravel()]).astype(float)

    @staticmethod
    def unpacked(d: int, numbers: np.ndarray) -> Spectrum:
        out = Spectrum(d)
        out.n = int(numbers[0])
        out.sums = [int(h) * _SPLIT + int(s) for h, s in zip(numbers[1:d + 1], numbers[d + 1:2 * d + 1])]
        out.mean, out.values = numbers[2 * d + 1:3 * d + 1], numbers[3 * d + 1:4 * d + 1]
        out.vectors = numbers[4 * d + 1:].reshape(d, d)
        return out


class Moments:
    """Count, mean and centred products of rows, merged pairwise."""

    def __init__(self, n: int, mean: np.ndarray, products: np.ndarray):
        self.n, self.mean, self.products = n, mean, products

    @staticmethod
    def of(rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        return Moments(len(rows), mean, (rows - mean).T @ (rows - mean))

    def merge(self, other: Moments) -> None:
        n, off = self.n + other.n, other.mean - self.mean
        self.products = self.products + other.products + np.outer(off, off) * (self.n * other.n / n)
        self.mean, self.n = self.mean + off * (other.n / n), n

    def packed(self) -> np.ndarray:
        return np.concatenate([[self.n], self.mean, self.products.ravel()])

    @staticmethod
    def unpacked(d: int, numbers: np.ndarray) -> Moments:
        k = int(round(np.sqrt(len(numbers) - 0.75) - 0.5))  # 1 + k + k * k numbers
        return Moments(int(numbers[0]), numbers[1:k + 1], numbers[k + 1:].reshape(k, k))


def _by_length(batch: pa.RecordBatch):
    """(length, rows of the batch, their vectors as a matrix) per vector length of the last column."""
    lists = batch.column(batch.num_columns - 1)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield int(d), rows, flat[starts[rows][:, None] + np.arange(d)]


def _rows(states: dict, part: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part] * len(states), pa.int64()), pa.array(list(states), pa.int32()),
                                       pa.array([s.packed() for s in states.values()], pa.list_(pa.float64()))],
                                      names=["part", "d", "numbers"])


def _gathered(vectors: DataFrame, kind, gather, tag: str) -> dict:
    """One state per vector length: ``gather(states, d, matrix)`` runs in every partition, then sixteen states
    at a time are merged. Only the last one of each length reaches the driver."""
    def partition(batches):
        states: dict = {}
        for batch in batches:
            for d, _, x in _by_length(batch):
                gather(states, d, x)
        if states:
            yield _rows(states, TaskContext.get().partitionId())

    def merged(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        d, out = group["d"][0].as_py(), None
        for numbers in group["numbers"]:
            state = kind.unpacked(d, numbers.values.to_numpy(zero_copy_only=False))
            if out is None:
                out = state
            else:
                out.merge(state)
        return pa.Table.from_batches([_rows({d: out}, group["part"][0].as_py() // FAN_IN)])

    states = written(vectors.select("x").mapInArrow(partition, _STATE), tag)
    last = states.agg(F.max("part")).first()[0] or 0
    while last:
        states = states.groupBy("d", F.floor(F.col("part") / FAN_IN)).applyInArrow(merged, _STATE)
        last //= FAN_IN
    return {r.d: kind.unpacked(r.d, np.array(r.numbers)) for r in states.collect()}


def _spectrum(states: dict, d: int, x: np.ndarray) -> None:
    states.setdefault(d, Spectrum(d)).add(x)


class Fit:
    """Eigenvectors (columns, by falling eigenvalue) of the covariance of the vectors of one length."""

    def __init__(self, spectrum: Spectrum):
        self.n, self.sums = spectrum.n, spectrum.sums
        #: The mean as an integer part and the rest: x - whole is exact before rest is taken off.
        self.whole = np.array([s // self.n for s in self.sums])
        self.rest = np.array([(s % self.n) / self.n for s in self.sums])
        self.basis = np.linalg.qr(spectrum.vectors)[0]
        self.values = self.trace = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest

    def refine(self, products: np.ndarray) -> None:
        """Rayleigh-Ritz: eigenvectors inside the basis, from the centred products of the projected vectors."""
        values, turn = np.linalg.eigh((products + products.T) / (2 * self.n))
        self.values, self.basis, self.trace = values[::-1], self.basis @ turn[:, ::-1], float(np.trace(products)) / self.n

    def whitened(self, x: np.ndarray, components: int) -> np.ndarray:
        """Projections over the roots of the eigenvalues, for the components that have variance."""
        k = self.rank(components)
        return self.centred(x) @ self.basis[:, :k] / np.sqrt(self.values[:k])

    def rank(self, components: int) -> int:
        return int((self.values[:components] > len(self.values) * EPS * self.trace).sum())

    def deviation(self, x: np.ndarray) -> list:
        """Sum over dimensions of (n x - sum)^2, exact; None beyond a long."""
        d = len(self.sums)
        bound = (self.n * max(1, int(np.abs(x).max(initial=1))) + max(abs(s) for s in self.sums))
        if bound < 1 << 62:
            off = self.n * x - np.array(self.sums)
            if int(np.abs(off).max(initial=0)) ** 2 * d < 1 << 63:
                return (off * off).sum(axis=1).tolist()
        exact = [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def fit(vectors: DataFrame) -> dict[int, Fit]:
    """A Fit per vector length of (vec_id, x)."""
    fits = {d: Fit(s) for d, s in _gathered(vectors, Spectrum, _spectrum, "spectra").items()}
    shared = vectors.sparkSession.sparkContext.broadcast(fits)  # d x d numbers

    def projected(states: dict, d: int, x: np.ndarray) -> None:
        y = shared.value[d].centred(x) @ shared.value[d].basis
        if d in states:
            states[d].products += y.T @ y
            states[d].n += len(x)
        else:
            states[d] = Products(len(x), y.T @ y)

    for d, s in _gathered(vectors, Products, projected, "products").items():
        fits[d].refine(s.products)
    return fits


class Products:
    """Sums of products of rows that are centred already."""

    def __init__(self, n: int, products: np.ndarray):
        self.n, self.products = n, products

    def merge(self, other: Products) -> None:
        self.n, self.products = self.n + other.n, self.products + other.products

    def packed(self) -> np.ndarray:
        return np.concatenate([[self.n], self.products.ravel()])

    @staticmethod
    def unpacked(d: int, numbers: np.ndarray) -> Products:
        return Products(int(numbers[0]), numbers[1:].reshape(d, d))


def identity_errors(vectors: DataFrame, fits: dict[int, Fit], components: int) -> dict[int, float | None]:
    """Per vector length, the largest entry of |covariance of the whitened vectors - identity|."""
    shared = vectors.sparkSession.sparkContext.broadcast(fits)

    def gather(states: dict, d: int, x: np.ndarray) -> None:
        new = Moments.of(shared.value[d].whitened(x, components))
        if d in states:
            states[d].merge(new)
        else:
            states[d] = new

    out = {}
    for d, m in _gathered(vectors, Moments, gather, "moments").items():
        k = len(m.mean)
        out[d] = float(np.abs(m.products / m.n - np.eye(k)).max()) if k else None
    return out


_OUT = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"


def whiten(df: DataFrame, components: int = 8, vector: str = "embedding") -> DataFrame:
    """One row per vector and component: its whitened coordinate, the share of variance the component
    explains, and the measured distance of the result's covariance from the identity."""
    vectors = integers(df, vector)
    fits = fit(vectors)
    errors = identity_errors(vectors, fits, components)
    shared = vectors.sparkSession.sparkContext.broadcast((fits, errors))

    def rows(batches):
        fits, errors = shared.value
        for batch in batches:
            for d, where, x in _by_length(batch):
                f = fits[d]
                k, m = min(components, d), len(where)
                white = f.whitened(x, components)
                padded = [r + [None] * (k - white.shape[1]) for r in white.tolist()]
                share = (f.values[:k] / f.trace).tolist() if f.trace > 0 else [None] * k
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(where)).cast(pa.int64()), pa.array([f.n] * m, pa.int64()),
                     pa.array(f.deviation(x), pa.int64()), pa.array(padded, pa.list_(pa.float64())),
                     pa.array([share] * m, pa.list_(pa.float64())), pa.array([errors[d]] * m, pa.float64())],
                    names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    wide = vectors.mapInArrow(rows, _OUT)
    long = wide.select("vec_id", "n", "deviation", "identity_error",
                       F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return long.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "c.whitened", "c.explained",
                       "identity_error")
