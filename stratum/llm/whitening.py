"""Whitening of embeddings by the leading eigenpairs of their covariance, found by a blocked Jacobi-Davidson method whose
every product with the covariance is a distributed pass over the vectors."""
from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import stage
from stratum.llm.vectors import common_length, matrix, usable

SCALE, SHIFT = 64, 1_000_000
#: A residual at or below this share of the largest eigenvalue is one of rounding: a pair is locked.
TOLERANCE = 2.0 ** -46
#: Steps of the inner solver per outer step, each one pass; they end early once a correction is good enough.
INNER_STEPS = 8
OUTER_STEPS = 60
#: Eigenvalues below this share of the trace are rounding: such components cannot be scaled to unit variance.
NULL_SHARE = 1e-13


class Moments(NamedTuple):
    """The fit list's count and exact sums per dimension, and what they give."""
    n: int
    sums: list[int]
    floor: np.ndarray   # floor(S / n), as longs
    rest: np.ndarray    # S / n - floor(S / n), in [0, 1)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        return (x - self.floor) - self.rest


def _integers(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = (np.floor(SCALE * matrix(b.column(1), d)).astype(np.int64) + SHIFT).astype("<i8")
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["vec_id", "x"])


def _longs(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, d)


def integer_vectors(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) and the dimension: x holds floor(64 * c) + 1000000 of every component c as little-endian longs."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    # components from 2**53 / 64 on would no longer be whole numbers that doubles hold
    rows = rows.where(usable(F.col("v")) & (F.size("v") > 0) & F.forall("v", lambda c: F.abs(c) < 2.0 ** 47))
    d = common_length(rows, "v")
    rows = rows.where(F.size("v") == d)
    return rows.mapInArrow(lambda it: _integers(it, d), "vec_id long, x binary"), d


def _partial_sums(batches, d: int) -> Iterator[pa.RecordBatch]:
    n, total = 0, np.zeros(d, object)
    for b in batches:
        n += b.num_rows
        total = total + _longs(b.column(0), d).sum(axis=0).astype(object)   # a batch's sums fit a long
    yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                                      pa.array([int(t) >> 32 for t in total], pa.int64()), pa.array([int(t) & 0xFFFFFFFF for t in total], pa.int64())],
                                     names=["dim", "n", "high", "low"])


def moments(fit: DataFrame, d: int) -> Moments:
    """Exact count and sums of the fit list: partitions sum in two halves of 32 bits, Spark adds these up per dimension."""
    parts = fit.mapInArrow(lambda it: _partial_sums(it, d), "dim int, n long, high long, low long")
    rows = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    n = rows[0]["n"] if rows else 0
    sums = [0] * d
    for r in rows:
        sums[r["dim"]] = (r["high"] << 32) + r["low"]
    floor = [s // n if n else 0 for s in sums]
    return Moments(n, sums, np.array(floor, np.int64), np.array([(s - f * n) / n if n else 0.0 for s, f in zip(sums, floor)]))


def _reduce(fit: DataFrame, d: int, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all x vectors (in batches) of ``part``'s matrices of ``width`` columns. Partitions sum their own rows;
    Spark adds up the partitions per matrix row, so the driver gets one matrix."""
    names = [f"c{j}" for j in range(width)]

    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                y = part(_longs(b.column(0), d))
                total = y if total is None else total + y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), *(pa.array(total[:, j]) for j in range(width))], names=["dim", *names])
    sums = fit.mapInArrow(run, ", ".join(["dim int", *(f"{c} double" for c in names)])).groupBy("dim").agg(*(F.sum(c).alias(c) for c in names))
    rows = sorted(sums.collect())
    return np.array([r[1:] for r in rows], np.float64)


def product(fit: DataFrame, m: Moments) -> Callable[[np.ndarray], np.ndarray]:
    """q -> V q for blocks of columns q: one pass over the fit list, every vector centred before it is multiplied."""
    d = len(m.sums)

    def times(q: np.ndarray) -> np.ndarray:
        def part(x):
            c = m.centred(x)
            return c.T @ (c @ q)
        return _reduce(fit, d, q.shape[1], part) / m.n
    return times


def _orthonormal(new: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """Columns of ``new`` made orthonormal to ``against`` and each other; columns that lie in their span go."""
    kept: list[np.ndarray] = []
    for v in new.T:
        size = norm = np.linalg.norm(v)
        for _ in range(3):
            for a in (*against, *(k[:, None] for k in kept)):
                if a.shape[1]:
                    v = v - a @ (a.T @ v)
            before, norm = norm, np.linalg.norm(v)
            if norm > 0.5 * before:
                break
        if norm > 1e-12 * size:
            kept.append(v / norm)
    return np.array(kept).T if kept else np.empty((new.shape[0], 0))


def _corrections(times, space: np.ndarray, theta: np.ndarray, residuals: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Projected correction equations (I - UU')(V - theta)(I - UU') t = -r, U all locked and current vectors, solved by
    MINRES for all columns in step: one distributed product serves one step of every column."""
    def project(x):
        x = x - space @ (space.T @ x)
        return x - space @ (space.T @ x)
    k = residuals.shape[1]
    v = project(-residuals)
    beta = np.linalg.norm(v, axis=0)
    start = np.where(beta > 0, beta, 1.0)
    v, v_old = v / start, np.zeros_like(v)
    t, w, w_old = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    eta, beta_now = beta.copy(), np.zeros(k)
    cos, cos_old, sin, sin_old = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    live = beta > 0
    for _ in range(steps):
        if not live.any():
            break
        av = np.zeros_like(v)
        av[:, live] = times(v[:, live])   # a lone product for all columns still in work
        av = project(av - v * theta)
        alpha = (v * av).sum(axis=0)
        nxt = av - v * alpha - v_old * beta_now
        beta_next = np.linalg.norm(nxt, axis=0)
        # Givens rotations of the tridiagonal matrix's next column
        delta = cos * alpha - cos_old * sin * beta_now
        rho1 = np.hypot(delta, beta_next)
        rho2 = sin * alpha + cos_old * cos * beta_now
        rho3 = sin_old * beta_now
        usable_now = live & (rho1 > 0)
        safe = np.where(usable_now, rho1, 1.0)
        cos_old, sin_old = cos, sin
        cos, sin = np.where(usable_now, delta / safe, 1.0), np.where(usable_now, beta_next / safe, 0.0)
        w_new = (v - w_old * rho3 - w * rho2) / safe
        w_old, w = w, w_new
        t = t + np.where(usable_now, cos * eta, 0.0) * w_new
        eta = -sin * eta
        live = usable_now & (np.abs(eta) > enough * start) & (beta_next > 1e-14 * np.maximum(1.0, np.abs(theta)))
        v_old, v = v, np.where(beta_next > 0, nxt / np.where(beta_next > 0, beta_next, 1.0), 0.0)
        beta_now = beta_next
    return project(t)


def leading_eigenpairs(times: Callable[[np.ndarray], np.ndarray], d: int, k: int, tolerance: float = TOLERANCE, seed: int = 11,
                       ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residual norms) of the ``k`` largest eigenpairs of a symmetric matrix given by its products.

    A search space grows by the corrections of all pairs that are not locked yet, and Rayleigh-Ritz picks the pairs in
    it; a pair whose residual is at most ``tolerance`` of the largest value is locked and kept out of the space. Pairs
    are locked from the largest on, so none is passed over. The space is cut back to its best vectors when it is full.
    After ``OUTER_STEPS`` the pairs are returned as they are; the residual norms tell how good they are."""
    k = min(k, d)
    full = min(d, max(4 * k, 48))
    locked, values, left = np.empty((d, 0)), [], []
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, k + 8))), [])
    image = times(basis)
    biggest, stalled, least = 0.0, 0, np.inf
    for step in range(OUTER_STEPS):
        small = basis.T @ image
        theta, y = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-theta)
        theta, y = theta[order], y[:, order]
        want = min(k - locked.shape[1], basis.shape[1])
        ritz, image_ritz = basis @ y, image @ y
        residuals = image_ritz[:, :want] - ritz[:, :want] * theta[:want]
        norms = np.linalg.norm(residuals, axis=0)
        biggest = max(biggest, float(theta[0]))
        # at the rounding of the products themselves residuals stop falling: what has stalled near it counts as reached
        stalled = stalled + 1 if norms.max() > 0.5 * least else 0
        least = min(least, norms.max())
        bar = tolerance * biggest * (1 if stalled < 3 else 64)
        whole = basis.shape[1] + locked.shape[1] == d
        done = 0
        while done < want and (norms[done] <= bar or (whole and stalled >= 3)):
            done += 1
        if done:
            locked = np.hstack([locked, ritz[:, :done]])
            values += list(theta[:done])
            left += list(norms[:done])
            stalled, least = 0, np.inf
        if locked.shape[1] == k:
            break
        basis, image = ritz[:, done:], image_ritz[:, done:]
        theta, residuals, want = theta[done:], residuals[:, done:], want - done
        if full < d and basis.shape[1] + want > full:
            basis, image = basis[:, :want + 8], image[:, :want + 8]
        if want:
            fresh = _corrections(times, np.hstack([locked, basis[:, :want]]), theta[:want], residuals, INNER_STEPS, 2.0 ** -(step + 2))
        else:   # the space has been locked whole: go on with new directions
            fresh = np.random.default_rng(seed + step + 1).standard_normal((d, k - locked.shape[1]))
        fresh = _orthonormal(fresh, [locked, basis])
        if not fresh.shape[1]:
            # corrections below rounding: random directions, or a newly computed image once the space is everything
            fresh = _orthonormal(np.random.default_rng(seed + step + 1).standard_normal((d, max(1, want))), [locked, basis])[:, :d - locked.shape[1] - basis.shape[1]]
            if not fresh.shape[1]:
                basis = _orthonormal(basis, [locked])
                image = times(basis)
                image = image - locked @ (locked.T @ image)
                continue
        grown = times(fresh)
        basis, image = np.hstack([basis, fresh]), np.hstack([image, grown - locked @ (locked.T @ grown)])
    # one last Rayleigh-Ritz over the pairs themselves, with residuals of newly computed products
    found = locked if locked.shape[1] == k else _orthonormal(np.hstack([locked, basis]), [])[:, :k]
    image = times(found)
    theta, y = np.linalg.eigh(((found.T @ image) + (found.T @ image).T) / 2)
    order = np.argsort(-theta)
    theta, y = theta[order], y[:, order]
    vectors = found @ y
    return theta, vectors, np.linalg.norm(image @ y - vectors * theta, axis=0)


class Whitening(NamedTuple):
    """What fitting gives: all of bounded size (components by dimensions)."""
    moments: Moments
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    trace: float
    identity_error: float


def fit_whitening(fit: DataFrame, d: int, components: int = 16) -> Whitening:
    """Fit on a frame of one binary column of distinct x vectors (see ``integer_vectors``)."""
    m = moments(fit, d)
    none = Whitening(m, np.empty(0), np.empty((d, 0)), np.empty(0), 0.0, 0.0)
    if not m.n:
        return none
    trace = float(_reduce(fit, d, 1, lambda x: (m.centred(x) ** 2).sum(axis=0)[:, None]).sum() / m.n)
    if trace <= 0:
        return none
    values, vectors, residuals = leading_eigenpairs(product(fit, m), d, components)
    real = values > NULL_SHARE * trace
    values, vectors, residuals = values[real], vectors[:, real], residuals[real]
    scale = vectors / np.sqrt(values)
    mean = _reduce(fit, d, 1, lambda x: (m.centred(x) @ scale).sum(axis=0)[:, None])[:, 0] / m.n

    def outer(x):
        w = m.centred(x) @ scale - mean
        return w.T @ w
    covariance = _reduce(fit, d, len(values), outer) / m.n
    return Whitening(m, values, vectors, residuals, trace, float(np.abs(covariance - np.eye(len(values))).max()))


def _whiten(batches, w: Whitening, d: int) -> Iterator[pa.RecordBatch]:
    k, n = len(w.values), w.moments.n
    scale = w.vectors / np.sqrt(w.values)
    sums = np.array(w.moments.sums, object)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"]
    for whole in batches:
        for i in range(0, whole.num_rows, 4096):
            b = whole.slice(i, 4096)
            x = _longs(b.column(1), d)
            far = int(np.abs(x - w.moments.floor).max()) + 1 if len(x) else 0
            if d * (n * far) ** 2 < 2 ** 62:   # exact in longs: n*x - S = n*(x - floor) - (S - n*floor)
                apart = n * (x - w.moments.floor) - (sums - n * w.moments.floor.astype(object)).astype(np.int64)
                deviation = (apart * apart).sum(axis=1).tolist()
            else:
                apart = n * x.astype(object) - sums
                deviation = [v if v < 2 ** 63 else None for v in map(int, (apart * apart).sum(axis=1))]
            z = w.moments.centred(x) @ scale
            rows = len(x)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, n, np.int64)), pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(z.reshape(-1)), pa.array(np.tile(w.values / w.trace, rows)), pa.array(np.full(rows * k, w.identity_error)),
                pa.array(np.tile(w.residuals / w.values[0], rows))], names=names)


def whiten(vectors: DataFrame, components: int = 16, vector: str = "embedding") -> DataFrame:
    """Per remaining row and component (numbered from 1 by falling eigenvalue): vec_id, component, n, deviation, whitened,
    explained, identity_error and residual (the eigenpair's residual norm over the largest eigenvalue).

    Components c become x = floor(64 * c) + 1000000; covariances are over each distinct x vector once. Rows with a null
    vector, with null or non-finite components, with components from 2**47 on, or with a vector of another length than
    the most frequent one are dropped, and so are empty vectors; a null vec_id stays null and repeated rows are rows of
    their own. Components whose eigenvalue is zero up to rounding have no unit variance and are not returned, so equal
    vectors alone, or an empty table, give no rows. ``deviation`` is null where its exact value would leave a long.
    Other columns are ignored."""
    spark = vectors.sparkSession
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"
    rows, d = integer_vectors(vectors, vector)
    rows = stage(rows, "integer_vectors")
    if not d:
        return spark.createDataFrame([], out)
    # equal vectors meet after each task has dropped its own repeats
    w = fit_whitening(stage(rows.select("x").distinct(), "fit_list"), d, components)
    if not len(w.values):
        return spark.createDataFrame([], out)
    return rows.mapInArrow(lambda it: _whiten(it, w, d), out)
