"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Every product with the covariance is one pass over the rows: tasks return ``(X - m)' ((X - m) Q)`` of their rows entry by entry, summed
by Spark; neither the covariance itself nor any row reaches the driver, which holds a few columns of the length of a vector. A cycle
filters the block ``Q`` by a Chebyshev polynomial of the covariance (three-term recurrence, one pass per degree) that damps the spectrum
between ``low`` and ``cut``, makes it orthonormal by QR and rotates it by Rayleigh-Ritz. ``cut`` is the least Ritz value of the
block, ``low`` a bound below the spectrum from a Lanczos vector that rides along in the passes of the first cycle. Cycles end when the residuals
``|V u - e u|`` of the wanted components are certified at rounding level; a block that gains nothing in a cycle is widened, and at full
width one Rayleigh-Ritz step is exact.

Values are whole numbers ``floor(1024 c) + 100000``; means are exact, and ``n x - S`` is centred in whole numbers before anything is multiplied.

Defined results: vectors that are NULL, empty, hold NULL or non-finite components, or a component beyond ``2**30`` are left out; of vectors of several lengths
those of the commonest length stay (the longer of equally common ones); fewer dimensions than components give fewer components; a component without
variance (fewer different rows than dimensions) has NULL ``whitened`` and ``explained`` 0; ``deviation`` is NULL where it does not fit a long; NULL ids and
repeated rows are rows like any other; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import small_batches

SCALE, SHIFT, LARGEST = 1024, 100_000, 2.0**30
#: Columns of the block beside the wanted ones, degree of a filter, residual (as a share of the greatest eigenvalue) that is certified, and most cycles.
GUARDS, DEGREE, CERTIFIED, CYCLES = 24, 8, 2e-15, 40
#: Numbers of one Arrow batch.
BATCH_NUMBERS = 2_000_000
SEED = 7


def whole_numbers(vector: Column) -> Column:
    """``floor(1024 * x) + 100000`` of every component, or NULL where the vector is left out."""
    scaled = F.transform(vector, lambda x: (F.floor(F.when(F.abs(x.cast("double")) < LARGEST, x.cast("double") * SCALE)) + SHIFT).cast("long"))
    return F.when((F.size(vector) > 0) & ~F.exists(scaled, lambda x: x.isNull()), scaled)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


@dataclass
class Rows:
    """The fit list ``x array<long>`` with its count and exact sums."""

    frame: DataFrame
    n: int
    sums: np.ndarray

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centred(self) -> Callable[[pa.Array], np.ndarray]:
        n, sums = self.n, self.sums
        return lambda column: (n * matrix(column, len(sums)) - sums) / n

    def times(self, q: np.ndarray) -> np.ndarray:
        """``V q`` by one pass over all rows."""
        centred = self.centred()

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(q.shape)
            for batch in batches:
                if batch.num_rows:
                    x = centred(batch.column(0))
                    total += x.T @ (x @ q)
            yield cells(total)

        return summed(self.frame.select("x").mapInArrow(task, CELLS), q.size).reshape(q.shape) / self.n


#: Partial sums of a task, one row per entry; Spark adds them up.
CELLS = "cell int, part double"


def cells(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["cell", "part"])


def summed(parts: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size)
    for r in parts.groupBy("cell").agg(F.sum("part").alias("part")).collect():
        out[r["cell"]] = r["part"]
    return out


@dataclass
class Spectrum:
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    passes: int


def ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Falling Ritz values of an orthonormal block, the rotated block and its product."""
    small = q.T @ vq
    e, y = np.linalg.eigh((small + small.T) / 2)
    y = y[:, ::-1]
    return e[::-1], q @ y, vq @ y


def chebyshev(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, degree: int, low: float, cut: float, top: float) -> np.ndarray:
    """``p(V) q`` for the Chebyshev polynomial of ``[low, cut]``, scaled to stay near one at ``top``; ``vq`` is ``V q``."""
    half, centre = (cut - low) / 2, (cut + low) / 2
    first = half / (top - centre)
    sigma, before, now = first, q, (vq - centre * q) * (first / half)
    for _ in range(degree - 1):
        nxt = 1 / (2 / first - sigma)
        before, now = now, 2 * nxt / half * (times(now) - centre * now) - sigma * nxt * before
        sigma = nxt
    return now


def lowest(alphas: list[float], betas: list[float]) -> float:
    """A bound below the spectrum from Lanczos coefficients: the least Ritz value less its residual."""
    t = np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1)
    e, y = np.linalg.eigh(t)
    return max(0.0, float(e[0] - abs(betas[-1] * y[-1, 0]) - 0.05 * (e[-1] - e[0])))


def leading(rows: Rows, count: int, guards: int | None = None, degree: int | None = None) -> Spectrum:
    """The ``count`` leading eigenpairs of the covariance of ``rows``."""
    d, made = rows.dim, [0]
    count = min(count, d)
    wide = min(d, count + (GUARDS if guards is None else guards))
    degree = DEGREE if degree is None else degree
    rnd = np.random.default_rng(SEED)

    def times(q: np.ndarray) -> np.ndarray:
        made[0] += 1
        return rows.times(q)

    probe = [np.linalg.qr(rnd.normal(size=(d, 1)))[0]]
    alphas: list[float] = []
    betas: list[float] = []

    def times_with_probe(q: np.ndarray) -> np.ndarray:
        """``V q``, and one Lanczos step on the vector that rides along."""
        out = times(np.hstack([q, probe[-1]]))
        step = out[:, -1:]
        alphas.append(float((probe[-1].T @ step)[0, 0]))
        for _ in range(2):
            for p in probe:
                step = step - p * (p.T @ step)
        betas.append(float(np.linalg.norm(step)))
        probe.append(step / betas[-1] if betas[-1] > 1e-12 * abs(alphas[0]) and len(probe) < d else np.zeros_like(step))
        return out[:, :-1]

    q = np.linalg.qr(rnd.normal(size=(d, wide)))[0]
    e, q, vq = ritz(q, times_with_probe(q))
    low, last = 0.0, np.inf
    for cycle in range(CYCLES):
        error = float(np.linalg.norm(vq[:, :count] - q[:, :count] * e[:count], axis=0).max())
        top = max(float(e[0]), 0.0)
        if top == 0.0 or error <= CERTIFIED * top or wide == d or (error <= 1e-11 * top and error > last / 4):
            break
        if cycle > 1 and error > last / 2:
            fresh = rnd.normal(size=(d, min(wide, d - wide)))
            wide += fresh.shape[1]
            q = np.linalg.qr(np.hstack([q, fresh]))[0]
            e, q, vq = ritz(q, times(q))
            last = np.inf
            continue
        last = error
        product = times if cycle else times_with_probe
        cut = max(float(e[-1] if cycle else np.mean(e)), 1e-6 * top)
        q = chebyshev(product, q, vq, degree, min(low, 0.9 * cut), cut, top)
        if not cycle:
            low = lowest(alphas, betas)
        q = np.linalg.qr(q / np.linalg.norm(q, axis=0))[0]
        e, q, vq = ritz(q, times(q))
    error = float(np.linalg.norm(vq[:, :count] - q[:, :count] * e[:count], axis=0).max())
    return Spectrum(np.maximum(e[:count], 0.0), q[:, :count], error, made[0])


def fit_rows(vectors: DataFrame, vector_col: str) -> Rows | None:
    """The fit list with its exact count and sums, or None if it is empty."""
    listed = vectors.where(F.col(vector_col).isNotNull())
    lengths = listed.groupBy(F.size(vector_col).alias("dim")).count().orderBy(F.col("count").desc(), F.col("dim").desc()).first()
    if lengths is None:
        return None
    dim = lengths["dim"]
    small_batches(vectors.sparkSession, max(1, BATCH_NUMBERS // dim))
    same = listed.where(F.size(vector_col) == dim).withColumnRenamed(vector_col, "x")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim, np.int64)
        for batch in batches:
            total += matrix(batch.column(0), dim).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(total)], ["i", "s"])

    sums = same.select("x").mapInArrow(task, "i int, s long").groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()
    return Rows(same, lengths["count"], np.array([r["s"] for r in sums], np.int64))


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double, passes int"


def whitened(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row and component: id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``, and the certified ``residual`` and number of ``passes``."""
    spark = vectors.sparkSession
    sound = vectors.select(vectors[id_col].cast("long").alias("id"), whole_numbers(vectors[vector_col]).alias("x")).where("x is not null")
    rows = fit_rows(materialize(sound, "whole-numbers"), "x")
    if rows is None:
        return spark.createDataFrame([], SCHEMA)
    found = leading(rows, components)
    n, sums, centred = rows.n, rows.sums, rows.centred()
    # a component whose variance is rounding only has no scale
    flat = found.values <= 1e-12 * max(found.values.max(initial=0.0), 1e-300)
    scaled = found.vectors * np.where(flat, 0.0, 1 / np.sqrt(np.where(flat, 1.0, found.values)))
    trace, error = second_moments(rows, scaled[:, ~flat])
    explained = np.where(flat, 0.0, found.values / trace) if trace else np.zeros(len(flat))
    k, residual, passes = len(flat), found.residual, found.passes

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = n * matrix(batch.column(1), len(sums)) - sums
            deviation = (x * x).sum(axis=1)
            too_long = (x.astype(np.float64) ** 2).sum(axis=1) >= 2.0**63
            w = (centred(batch.column(1)) @ scaled).ravel()
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                    pa.array(np.repeat(deviation, k), mask=np.repeat(too_long, k)), pa.array(w, mask=np.tile(flat, m)), pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)), pa.array(np.full(m * k, residual)), pa.array(np.full(m * k, passes, np.int32)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual", "passes"],
            )

    return rows.frame.select("id", "x").mapInArrow(task, SCHEMA)


def second_moments(rows: Rows, scaled: np.ndarray) -> tuple[float, float]:
    """The trace of the covariance, and the largest absolute entry of the whitened covariance minus the identity, measured over all rows."""
    centred, wide = rows.centred(), scaled.shape[1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, trace = np.zeros((wide, wide)), 0.0
        for batch in batches:
            if batch.num_rows:
                x = centred(batch.column(0))
                y = x @ scaled
                total += y.T @ y
                trace += float((x * x).sum())
        yield cells(np.append(total, trace))

    out = summed(rows.frame.select("x").mapInArrow(task, CELLS), wide * wide + 1) / rows.n
    return float(out[-1]), float(np.abs(out[:-1].reshape(wide, wide) - np.eye(wide)).max(initial=0.0))
