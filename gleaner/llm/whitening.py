"""Whitening of embeddings on leading principal components, by Chebyshev-filtered subspace iteration.

The covariance is never formed and no vector leaves its task: a pass multiplies
the centred rows X of every block, X'(XQ), and only that sum of a few columns
reaches the driver. A polynomial of the covariance, by the three-term Chebyshev
recurrence over such passes, stays within one on the unwanted part of the spectrum
and grows fast above it. After each filter come QR and Rayleigh-Ritz; the rounds
end when the residuals of the wanted pairs certify them. Bounds of the spectrum
are taken from a few Lanczos passes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import materialised

COMPONENTS = 32
#: Columns iterated besides the wanted ones, steps of the polynomial, Lanczos passes, and rounds before giving up.
GUARD, DEGREE, LANCZOS, ROUNDS = 16, 10, 12, 200
#: Rows of a block.
BLOCK = 2048
#: Residuals of the wanted pairs against the largest eigenvalue: wanted, and accepted where they fall no further.
EXACT, ENOUGH = 2e-14, 1e-10
#: Eigenvalues below this share of the largest one count as zero.
ZERO = 1e-10
SCALE, SHIFT = 64.0, 1_000_000


def whole_numbers(vectors: list, dims: int) -> np.ndarray:
    """floor(64 c) + 1,000,000 of every entry; vectors are filled up with zeros to ``dims`` entries."""
    matrix = np.zeros((len(vectors), dims))
    for k, vector in enumerate(vectors):
        matrix[k, : len(vector)] = vector
    scaled = np.floor(SCALE * matrix)
    if scaled.size and np.abs(scaled).max() > 2.0**62:
        raise OverflowError("an entry does not fit a 64-bit integer")
    return scaled.astype(np.int64) + SHIFT


def clean_rows(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows whose vector and entries are neither null nor non-finite."""
    doubles = F.col("embedding").cast("array<double>")
    fine = F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return embeddings.where(F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False))).select("vec_id", doubles.alias("embedding"))


@dataclass
class Moments:
    """Number of vectors, sum of each dimension, both exact."""

    n: int
    sums: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - np.array(self.sums, np.int64)) / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2, exact; raises where that does not fit 64 bits."""
        off = self.n * x - np.array(self.sums, np.int64)
        if not off.size or float((off.astype(np.float64) ** 2).sum(axis=1).max()) < 9e18:
            return (off * off).sum(axis=1).tolist()
        exact = [sum(v * v for v in row) for row in off.tolist()]
        if max(exact) >= 1 << 63:
            raise OverflowError("a deviation does not fit a 64-bit integer")
        return exact


@dataclass
class Blocks:
    """Rows (vec_ids, x) that each hold a block of vectors, and the number of tasks that read them."""

    rows: DataFrame
    dims: int
    tasks: int

    def summed(self, shape: tuple[int, ...], of_block: Callable[[np.ndarray], np.ndarray], kind: type = np.float64) -> np.ndarray:
        """The sum of ``of_block`` over all blocks.

        Every task sends one matrix; of many tasks, about the square root of their
        number add these up, and the driver adds up what they send.
        """
        dims = self.dims

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for x in batch.column(0):
                    own = of_block(_matrix(x.as_py(), dims))
                    total = own if total is None else total + own
            if total is not None:
                yield _one_value(total)

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for value in batch.column(0):
                    own = np.frombuffer(value.as_py(), kind)
                    total = own.copy() if total is None else total + own
            if total is not None:
                yield _one_value(total)

        parts = self.rows.select("x").mapInArrow(partial, "total binary")
        if self.tasks > 64:
            parts = parts.repartition(math.isqrt(self.tasks)).mapInArrow(added, "total binary")
        total = np.zeros(shape, kind)
        for row in parts.collect():
            total += np.frombuffer(row["total"], kind).reshape(shape)
        return total


def _one_value(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(total).tobytes()], pa.binary())], names=["total"])


def _matrix(x: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(x, np.int64).reshape(-1, dims)


def blocks_of(clean: DataFrame, dims: int) -> Blocks:
    """Blocks of rows as matrices of 64-bit integers, written once for all passes."""
    id_type = clean.schema["vec_id"].dataType.simpleString()

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(at, BLOCK)
                x = whole_numbers(rows.column(1).to_pylist(), dims)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows.column(0).to_pylist()], pa.list_(rows.schema.field(0).type)), pa.array([x.tobytes()], pa.binary())],
                    names=["vec_ids", "x"],
                )

    rows = materialised(clean.mapInArrow(blocked, f"vec_ids array<{id_type}>, x binary"), "blocks")
    return Blocks(rows, dims, rows.rdd.getNumPartitions())


def moments_of(blocks: Blocks) -> Moments:
    def counted(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], x.sum(axis=0)])

    found = blocks.summed((blocks.dims + 1,), counted, np.int64)
    return Moments(int(found[0]), [int(s) for s in found[1:]])


def lanczos_bounds(multiply: Callable[[np.ndarray], np.ndarray], dims: int, passes: int = LANCZOS, seed: int = 0) -> tuple[float, float]:
    """(lower, upper) bounds of the spectrum: the outer Ritz values of a Krylov space, moved out by its last step."""
    rng = np.random.default_rng(seed)
    q = rng.normal(size=dims)
    basis = [q / np.linalg.norm(q)]
    alpha, beta = [], []
    for _ in range(min(passes, dims)):
        w = multiply(basis[-1][:, None])[:, 0]
        alpha.append(float(basis[-1] @ w))
        known = np.array(basis)
        for _ in range(2):
            w = w - known.T @ (known @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-13 * max(map(abs, alpha)):
            beta[-1] = 0.0
            break
        basis.append(w / beta[-1])
    values = np.linalg.eigvalsh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))
    return max(0.0, float(values[0]) - beta[-1]), float(values[-1]) + beta[-1]


def filtered(multiply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The scaled Chebyshev polynomial of the covariance that is small on [low, high] and one at ``top``, times ``q``."""
    centre, half = (high + low) / 2, (high - low) / 2
    sigma = first = half / (top - centre)
    before, own = q, (multiply(q) - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, own = own, 2 * following / half * (multiply(own) - centre * own) - sigma * following * before
        sigma = following
    return own


@dataclass
class Spectrum:
    """Leading eigenvalues in falling order, their unit eigenvectors as columns, the trace, and the largest residual."""

    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    passes: int


def leading_pairs(multiply: Callable[[np.ndarray], np.ndarray], dims: int, trace: float, wanted: int, seed: int = 0) -> Spectrum:
    """The leading eigenpairs of the covariance that ``multiply`` applies to some columns."""
    passes = 0

    def counted(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return multiply(q)

    wanted = min(wanted, dims)
    width = min(dims, wanted + GUARD)
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, width)))
    lower, _ = lanczos_bounds(counted, dims) if width < dims else (0.0, 0.0)
    best = math.inf
    for _ in range(ROUNDS):
        image = counted(q)
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        top = float(values[0])
        if top <= 0:
            return Spectrum(values[:0], q[:, :0], trace, 0.0, passes)
        kept = [k for k in range(wanted) if values[k] > ZERO * top]
        residual = float(np.linalg.norm((image - q * values)[:, kept], axis=0).max())
        if residual <= EXACT * top or (residual <= ENOUGH * top and residual > best / 2):
            return Spectrum(values[kept], q[:, kept], trace, residual, passes)
        best = min(best, residual)
        high = max(float(values[-1]), ZERO * top)
        # Ritz values stand above the eigenvalues of their rank from below, so the lower bound may have to give way.
        low = min(lower, 0.9 * high)
        q, _ = np.linalg.qr(filtered(counted, q, low, high, top, DEGREE) if width < dims else image)
    raise RuntimeError(f"not certified after {ROUNDS} rounds: residual {best}")


@dataclass
class Whitening:
    moments: Moments
    spectrum: Spectrum
    identity_error: float

    @property
    def matrix(self) -> np.ndarray:
        return self.spectrum.vectors / np.sqrt(self.spectrum.values)


def fitted(blocks: Blocks, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the vectors of ``blocks``; None where there are none."""
    moments, dims = moments_of(blocks), blocks.dims
    if not moments.n:
        return None

    def multiply(q: np.ndarray) -> np.ndarray:
        def of_block(x: np.ndarray) -> np.ndarray:
            centred = moments.centred(x)
            return centred.T @ (centred @ q)

        return blocks.summed(q.shape, of_block) / moments.n

    def squares(x: np.ndarray) -> np.ndarray:
        return (moments.centred(x) ** 2).sum(axis=0)

    trace = float(blocks.summed((dims,), squares).sum()) / moments.n
    spectrum = leading_pairs(multiply, dims, trace, components)
    found = Whitening(moments, spectrum, 0.0)
    matrix = found.matrix
    width = matrix.shape[1]

    def products(x: np.ndarray) -> np.ndarray:
        white = moments.centred(x) @ matrix
        return np.vstack([white.T @ white, white.sum(axis=0)])

    if width:
        sums = blocks.summed((width + 1, width), products) / moments.n
        covariance = sums[:-1] - np.outer(sums[-1], sums[-1])
        found.identity_error = float(np.abs(covariance - np.eye(width)).max())
    return found


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per clean vector and component.

    Vectors that are null or hold null or non-finite entries are left out. Shorter
    vectors are filled up with zeros to the length of the longest. Components
    without variance have no direction and are left out, all of them where all
    vectors are equal; an empty table has no rows. Rows with equal or null vec_id
    are vectors of their own. Reads vec_id and embedding only.
    """
    id_type = embeddings.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    clean = clean_rows(embeddings)
    dims = clean.agg(F.max(F.size("embedding"))).first()[0] or 0
    blocks = blocks_of(clean, dims) if dims else None
    found = fitted(blocks, components) if dims else None
    if found is None or not len(found.spectrum.values):
        return embeddings.sparkSession.createDataFrame([], schema)
    moments, matrix, error = found.moments, found.matrix, found.identity_error
    explained = found.spectrum.values / found.spectrum.trace
    width = matrix.shape[1]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field(0).type.value_type
            for ids, data in zip(batch.column(0), batch.column(1), strict=True):
                x = _matrix(data.as_py(), dims)
                values = moments.centred(x) @ matrix
                own = pa.array(ids.as_py(), kind).take(pa.array(np.repeat(np.arange(len(x)), width)))
                many = len(x) * width
                yield pa.RecordBatch.from_arrays(
                    [
                        own,
                        pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(many, moments.n, np.int64)),
                        pa.array(np.repeat(np.array(moments.deviations(x), np.int64), width)),
                        pa.array(np.ascontiguousarray(values).reshape(-1)),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(many, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return blocks.rows.mapInArrow(projected, schema)
