"""Whitening of embeddings by an incremental eigendecomposition.

Each partition keeps the spectrum of what it has seen and changes it by one centred rank-one
update a vector: the new eigenvalues are the roots of a secular equation, after deflation.
Spectra are combined in a tree, each eigenpair of one being an update of the other.  A last
pass over all vectors projects their covariance on the basis found (Rayleigh-Ritz).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import cut

COMPONENTS = 4
#: Partial results that one task combines.
FAN = 16
EPS = float(np.finfo(float).eps)
#: Rounds of the root finder; each at least halves a bracket, and few are needed.
ROUNDS = 64
#: Rows that are turned into a matrix at once.
ROWS = 1024


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho * sum(z2 / (d - x)) = 0``, one above each of the ascending poles ``d``.

    Returns the roots and the matrix of ``d[j] - root[i]``, which is exact also where a root
    is close to a pole, because each root is sought relative to its nearest pole.
    """
    k = len(d)
    top = d[-1] + rho * z2.sum()
    right = np.append(d[1:], top)
    gap = right - d
    middle = d + gap / 2
    at_middle = 1 + rho * (z2 / (d - middle[:, None])).sum(axis=1)
    # the last root has no pole on its right
    near_left = (at_middle >= 0) | (np.arange(k) == k - 1)
    origin = np.where(near_left, d, right)
    poles = d - origin[:, None]
    low = np.where(near_left, np.where(at_middle >= 0, 0.0, gap / 2), -gap / 2)
    high = np.where(near_left, np.where(at_middle >= 0, gap / 2, gap), 0.0)
    tau = (low + high) / 2
    # poles left of each root, and the nearest one on each side
    below = np.tri(k, dtype=bool)
    sides = np.stack([d - origin, right - origin])
    open_ = np.arange(k)
    for _ in range(ROUNDS):
        t = tau[open_]
        away = poles[open_] - t[:, None]
        terms = rho * z2 / away
        f = 1 + terms.sum(axis=1)
        high[open_] = np.where(f > 0, t, high[open_])
        low[open_] = np.where(f > 0, low[open_], t)
        done = np.abs(f) <= 2 * k * EPS * (1 + np.abs(terms).sum(axis=1))
        done |= high[open_] - low[open_] <= 2 * EPS * np.abs(t)
        slopes = terms / away
        psi = (slopes * below[open_]).sum(axis=1)
        phi = slopes.sum(axis=1) - psi
        left, behind = sides[:, open_] - t
        # interpolate by a constant and one pole on each side
        c = f - left * psi - behind * phi
        a = (left + behind) * f - left * behind * (psi + phi)
        b = left * behind * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            new = t + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        inside = np.isfinite(new) & (new > low[open_]) & (new < high[open_])
        tau[open_] = np.where(done, t, np.where(inside, new, (low[open_] + high[open_]) / 2))
        open_ = open_[~done]
        if not len(open_):
            break
    return origin + tau, poles - tau[:, None]


def _deflate(d: np.ndarray, u: np.ndarray, z: np.ndarray, rho: float) -> np.ndarray:
    """Marks of the entries an update changes; turns pairs of almost equal values in place."""
    size = float(np.sqrt(z @ z))
    tolerance = 8 * EPS * max(float(np.abs(d).max(initial=0.0)), rho * size * size)
    live = rho * size * np.abs(z) > tolerance
    at = np.flatnonzero(live)
    if len(at) < 2:
        return live
    a, b = z[at[:-1]], z[at[1:]]
    if not ((d[at[1:]] - d[at[:-1]]) * np.abs(a * b) <= tolerance * (a * a + b * b)).any():
        return live
    last = at[0]
    for i in at[1:]:
        length = float(np.hypot(z[i], z[last]))
        c, s = z[i] / length, z[last] / length
        if (d[i] - d[last]) * abs(c * s) <= tolerance:
            # move the whole weight to i; the other is an eigenpair as it stands
            z[i], z[last] = length, 0.0
            d[last], d[i] = d[last] * c * c + d[i] * s * s, d[last] * s * s + d[i] * c * c
            u[:, last], u[:, i] = c * u[:, last] - s * u[:, i], s * u[:, last] + c * u[:, i]
            live[last] = False
        last = i
    return live


def rank_one(d: np.ndarray, u: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``u diag(d) u' + rho v v'`` for ascending ``d`` and ``rho`` over 0."""
    z = u.T @ v
    d, u = d.copy(), u.copy()
    live = _deflate(d, u, z, rho)
    at = np.flatnonzero(live)
    at = at[np.argsort(d[at], kind="stable")]
    if not len(at):
        return d, u
    poles, weights = d[at], z[at]
    roots, away = secular_roots(poles, weights * weights, rho)
    # weights for which the roots are exact make the vectors orthogonal
    k = len(at)
    columns = np.arange(k - 1)
    nearest = poles[columns + (columns >= np.arange(k)[:, None])] - poles[:, None] if k > 1 else np.ones((1, 0))
    squares = (-away.T[:, : k - 1] / nearest).prod(axis=1) * -away[k - 1] / rho
    exact = np.copysign(np.sqrt(np.maximum(squares, 0.0)), weights)
    turn = (exact / np.where(away == 0.0, EPS, away)).T
    turn /= np.sqrt((turn * turn).sum(axis=0))
    u[:, at] = u[:, at] @ turn
    d[at] = roots
    order = np.argsort(d, kind="stable")
    return d[order], u[:, order]


@dataclass
class Spectrum:
    """Rows seen, their exact sums, and the spectrum of their scatter about their mean."""

    n: int
    sums: list[int]
    d: np.ndarray
    u: np.ndarray

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, [0] * width, np.zeros(width), np.eye(width))

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def add(self, rows: np.ndarray) -> None:
        """One update for each row of whole numbers."""
        mean = self.mean() if self.n else np.zeros(rows.shape[1])
        for row in rows.astype(float):
            offset = row - mean
            if self.n:
                rho = self.n / (self.n + 1)
                self.d, self.u = rank_one(self.d, self.u, rho, offset)
            self.n += 1
            mean = mean + offset / self.n
        self.sums = [a + b for a, b in zip(self.sums, _column_sums(rows))]

    def merge(self, other: Spectrum) -> Spectrum:
        """The spectrum of both, by an update for each eigenpair and one for the means."""
        if not self.n or not other.n:
            return self if self.n else other
        d, u = self.d, self.u
        for value, vector in zip(other.d, other.u.T):
            if value > 0:
                d, u = rank_one(d, u, float(value), vector)
        n = self.n + other.n
        d, u = rank_one(d, u, self.n * other.n / n, other.mean() - self.mean())
        return Spectrum(n, [a + b for a, b in zip(self.sums, other.sums)], d, u)


def _column_sums(rows: np.ndarray) -> list[int]:
    if np.abs(rows.astype(float)).max(initial=0.0) * max(1, len(rows)) < 2**62:
        return rows.sum(axis=0).tolist()
    return rows.astype(object).sum(axis=0).tolist()


def matrices(batches: Iterator[pa.RecordBatch], column: int, width: int):
    """Batches of vectors of one width as whole-number matrices, with their batches."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            yield part, part.column(column).flatten().to_numpy().reshape(part.num_rows, width)


def _partial(rows: DataFrame, make: Callable, width: int) -> DataFrame:
    """``part, payload``: what ``make`` gives for the matrices of each partition."""

    def run(batches):
        found = make(x for _, x in matrices(batches, 0, width))
        if found is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([pickle.dumps(found)], pa.binary())], ["part", "payload"]
            )

    return rows.select("x").mapInArrow(run, "part int, payload binary")


def folded(partial: DataFrame, merge: Callable):
    """All partial results combined in a tree of tasks, in the order of their parts; or None."""

    def run(table: pa.Table) -> pa.Table:
        found = None
        for part, payload in sorted(zip(table["part"].to_pylist(), table["payload"].to_pylist())):
            value = pickle.loads(payload)
            found = value if found is None else merge(found, value)
        group = table["group"][0].as_py()
        return pa.table({"part": pa.array([group], pa.int32()), "payload": [pickle.dumps(found)]})

    rows = cut(partial)
    while True:
        last = rows.agg(F.max("part")).first()[0]
        if last is None:
            return None
        if last == 0:
            return pickle.loads(rows.first()["payload"])
        grouped = rows.withColumn("group", F.floor(F.col("part") / FAN).cast("int")).groupBy("group")
        rows = cut(grouped.applyInArrow(run, "part int, payload binary"))


@dataclass
class Whitening:
    """Components of the covariance of a fit list, strongest first."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def apply(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.mean()) @ self.vectors / np.sqrt(self.values)

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n * x - sum) ** 2``; None where a long does not hold it."""
        width = rows.shape[1]
        peak = self.n * float(np.abs(rows.astype(float)).max(initial=0.0))
        peak += max(map(abs, self.sums), default=0)
        if width * peak * peak < 2**62:
            away = self.n * rows - np.array(self.sums, np.int64)
            return (away * away).sum(axis=1).tolist()
        found = [sum((self.n * x - s) ** 2 for x, s in zip(row, self.sums)) for row in rows.tolist()]
        return [x if x < 2**63 else None for x in found]


def widened(rows: DataFrame, width: int) -> DataFrame:
    """Vectors ``x`` of one width; shorter ones end in zeros."""
    missing = F.lit(width) - F.size("x")
    zeros = F.array_repeat(F.lit(0).cast("long"), missing)
    return rows.withColumn("x", F.when(missing > 0, F.concat("x", zeros)).otherwise(F.col("x")))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on each distinct vector ``x`` of whole numbers once; None without any variance."""
    known = vectors.where("x is not null").select("x")
    width = known.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return None
    rows = cut(widened(known, width).distinct())

    def spectrum(parts):
        found = Spectrum.empty(width)
        for x in parts:
            found.add(x)
        return found if found.n else None

    whole = folded(_partial(rows, spectrum, width), Spectrum.merge)
    n, sums = whole.n, whole.sums
    mean = whole.mean()
    # the updates' rounding is taken out of the basis before the projection
    basis = np.linalg.qr(whole.u[:, ::-1])[0]

    def gram(turn):
        def make(parts):
            found = None
            for x in parts:
                y = turn(x)
                found = y.T @ y if found is None else found + y.T @ y
            return found

        return folded(_partial(rows, make, width), np.add) / n

    projected = gram(lambda x: (x - mean) @ basis)
    values, turn = np.linalg.eigh(projected)
    trace = float(values.sum())
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > width * 64 * EPS * max(values.max(), 0.0)]
    if not len(order):
        return None
    chosen = basis @ turn[:, order]
    # the sign is free: the largest entry is positive
    chosen *= np.sign(chosen[np.abs(chosen).argmax(axis=0), np.arange(len(order))])
    found = Whitening(n, sums, values[order], chosen, trace)
    found.identity_error = float(np.abs(gram(found.apply) - np.eye(len(order))).max())
    return found


WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whitened(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every vector.

    Vectors are columns ``vec_id, x``, with whole numbers in ``x``.

    * rows without a vector are left out; a shorter vector ends in zeros, and one longer than
      any of the fit raises a ValueError;
    * a null id is an id; repeated rows are repeated in the result and count once in a fit;
    * a component without variance has no rows, so one distinct vector, or an empty table,
      gives an empty result; components of equal variance are any basis of their space;
    * a deviation that exceeds a long is null; other columns are ignored.
    """
    known = vectors.where("x is not null").select("vec_id", "x")
    if model is None:
        return known.sparkSession.createDataFrame([], WHITENED)
    width, k = len(model.sums), len(model.values)
    explained = model.values / model.trace

    def run(batches):
        for batch, x in matrices(batches, 1, width):
            n = batch.num_rows
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(n), k)))
            deviations = pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), k)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.cast(pa.int64()),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, model.n)),
                    deviations,
                    pa.array(model.apply(x).reshape(-1)),
                    pa.array(np.tile(explained, n)),
                    pa.array(np.full(n * k, model.identity_error)),
                ],
                [c.split()[0] for c in WHITENED.split(", ")],
            )

    return widened(known, width).mapInArrow(run, WHITENED)
