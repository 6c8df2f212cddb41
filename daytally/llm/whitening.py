"""Whitening of embeddings by shifted Cholesky QR.

The rows that the model is fitted to are the distinct vectors, centred: a matrix A with one row for each. A pass over the rows
gives the Gram matrix AᵀA; the Cholesky factor R1 of it, with a small multiple of the identity added, makes A R1⁻¹ far
better conditioned than A, whatever A is. The next pass solves each row against R1 and takes the Gram matrix of what comes
out, and so on until the rows are orthonormal. The product R of the factors has AᵀA = RᵀR, and the singular value
decomposition of R gives the components: the right singular vectors are the eigenvectors of the covariance, the squares of
the singular values over n its eigenvalues. Unlike an eigendecomposition of AᵀA this does not square the condition
of A.

A pass is one task per partition, which keeps one matrix of the width of a vector, and a sum of these matrices by cells;
the driver gets one such matrix per pass. Rows are stored once, distinct; the distinct rows are found by an aggregate,
so copies combine before the shuffle.

Rows and edge cases: vectors that are null or hold null or non-finite entries are dropped. All others must have one width,
the most common one; vectors of other widths are dropped too (of widths equally common the largest counts). Entries beyond
``LIMIT`` after scaling count as that limit. Copies of a vector, also with other ids, count once in the fit and come out
once per row; ids may be null or repeated. Directions in which the vectors do not differ have no components, so there
may be fewer than asked for, and none (no rows come out) if all vectors are equal. ``deviation`` is null where it does not fit
a long. An empty table gives an empty result. Other columns are not read. Components whose eigenvalues are equal are any
basis of their space.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.shared import stored
from daytally.llm.vectors import is_sound, matrix, scaled, slabs, summed

FACTOR = 256
LIMIT = 2**52
# A row is orthonormal enough if no cell of the Gram matrix is off by more; passes that may be needed for that.
ORTHONORMAL = 1e-10
PASSES = 12
# Singular values below this share of the largest are those of no direction.
RANK = 1e-10


@dataclass(frozen=True)
class Whitening:
    """What whitens a row x: ``(x - sums / n) @ components / scales``."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    scales: np.ndarray
    explained: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, np.array(self.sums, dtype=np.float64)) @ self.components / self.scales

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of ``n * x - sums``, exact; None beyond a long."""
        if not self.sums:
            return [0] * len(x)
        # Doubles tell which sums fit a long for certain and which don't; whole numbers of any size decide the few between.
        sums = np.array(self.sums, dtype=object)
        rough = ((self.n * x.astype(np.float64) - sums.astype(np.float64)) ** 2).sum(axis=1)
        out: list[int | None] = [None] * len(x)
        exact = rough < 9.3e18
        if max(abs(s) for s in self.sums) < 2**63:
            # Products may wrap around; their differences from the sums are small and right all the same.
            off = x.astype(np.int64) * np.int64(self.n) - sums.astype(np.int64)
            squares = (off * off).sum(axis=1)
            for k in np.flatnonzero(rough < 9.2e18):
                out[k] = int(squares[k])
            exact &= rough >= 9.2e18
        for k in np.flatnonzero(exact):
            value = sum(int(v) ** 2 for v in self.n * x[k].astype(object) - sums)
            out[k] = value if value < 2**63 else None
        return out


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return x - sums / n


def rows_of(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, x`` for each vector that takes part."""
    sound = vectors.filter(is_sound(F.col(vector_column))).select(
        F.col(id_column).cast("long").alias("vec_id"), scaled(F.col(vector_column), FACTOR, LIMIT).alias("x"))
    widths = sound.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return sound.filter(F.size("x") == (widths["width"] if widths else 0))


def _gram(fit: DataFrame, width: int, ready: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The Gram matrix of all rows of ``fit`` after ``ready``."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, cells = None, pa.schema([("row", pa.int32()), ("cells", pa.list_(pa.float64()))])
        for batch in slabs(batches):
            q = ready(matrix(batch.column(0), width).astype(np.float64))
            total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            yield pa.RecordBatch.from_pydict({"row": list(range(len(total))), "cells": total.tolist()}, cells)

    cells = summed(fit.select("x").mapInArrow(part, "row int, cells array<double>"), ["row"], "cells").collect()
    size = max(r["row"] for r in cells) + 1
    gram = np.zeros((size, size))
    for r in cells:
        gram[r["row"], r["at"]] = r["v"]
    return (gram + gram.T) / 2


def _solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular factor, by substitution from the first column on."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper triangular Cholesky factor, of the Gram matrix itself or with the shift that makes it definite."""
    width, unit = len(gram), np.finfo(np.float64).eps / 2
    shift = 11 * (n * width + width * (width + 1)) * unit * np.trace(gram) if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(width)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, unit * np.trace(gram), np.finfo(np.float64).tiny)


def fit(rows: DataFrame, components: int) -> tuple[Whitening, DataFrame] | None:
    """The whitening of :func:`rows_of`, and the distinct rows it was fitted to; None without any row."""
    distinct = stored(rows.select("x").distinct())
    first = distinct.first()
    if first is None:
        return None
    width, n = len(first["x"]), distinct.count()
    sums = [0] * width

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=object)
        for batch in slabs(batches):
            x = matrix(batch.column(0), width)
            total += (x if np.abs(x).max(initial=0) < 2**49 else x.astype(object)).sum(axis=0)
        digits = pa.schema([("one", pa.int32()), ("sums", pa.list_(pa.decimal128(38, 0)))])
        yield pa.RecordBatch.from_pydict({"one": [1], "sums": [[int(v) for v in total]]}, digits)

    if width:
        for r in summed(distinct.mapInArrow(part, "one int, sums array<decimal(38,0)>"), ["one"], "sums").collect():
            sums[r["at"]] = int(r["v"])
    mean = np.array([s / n for s in sums])
    factors: list[np.ndarray] = []
    whole, singular, turned = np.eye(width), np.zeros(0), np.zeros((0, width))
    for step in range(PASSES if width else 0):
        def orthogonal(x: np.ndarray, by: tuple = tuple(factors)) -> np.ndarray:
            q = x - mean
            for factor in by:
                q = _solved(q, factor)
            return q

        gram = _gram(distinct, width, orthogonal)
        values, axes = np.linalg.eigh(gram)
        orthonormal = (np.abs(values - 1) < ORTHONORMAL) | (np.abs(values) < ORTHONORMAL)
        if not np.any(gram) or (step and orthonormal.all()) or step == PASSES - 1:
            # What the last pass is off by belongs to the product; so do directions without rows, which a shift hides.
            values[np.abs(values) < ORTHONORMAL] = 0.0
            _, singular, turned = np.linalg.svd(np.sqrt(np.maximum(values, 0.0))[:, None] * axes.T @ whole)
            break
        # Well conditioned rows need no shift.
        factor = _factor(gram, n, shifted=values[0] < 0.01 * values[-1])
        factors.append(factor)
        whole = factor @ whole
    rank = int((singular > RANK * singular[0]).sum()) if len(singular) else 0
    kept = min(components, rank)
    eigenvalues = singular**2 / n
    return Whitening(
        n, tuple(sums), turned[:kept].T, singular[:kept] / np.sqrt(n), eigenvalues[:kept] / (eigenvalues.sum() or 1.0)), distinct


def identity_error(model: Whitening, distinct: DataFrame) -> float:
    """Largest cell by which the covariance of the whitened rows differs from the identity, by another pass."""
    width, k = len(model.sums), len(model.scales)
    if not k:
        return 0.0

    def with_one(x: np.ndarray) -> np.ndarray:
        return np.column_stack([model.whitened(x), np.ones(len(x))])

    gram = _gram(distinct, width, with_one) / model.n
    covariance = gram[:k, :k] - np.outer(gram[:k, k], gram[:k, k])
    return float(np.abs(covariance - np.eye(k)).max())


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = 4, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row for each vector that takes part and each component (:data:`OUTPUT`)."""
    rows = rows_of(vectors, id_column, vector_column)
    found = fit(rows, components)
    if found is None or not len(found[0].scales):
        return rows.sparkSession.createDataFrame([], OUTPUT)
    model, distinct = found
    error, width, k = identity_error(model, distinct), len(model.sums), len(model.scales)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            x, count = matrix(batch.column(1), width), batch.num_rows
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(count), k)))
            deviation = pa.array([v for v in model.deviations(x) for _ in range(k)], pa.int64())
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                pa.array(np.full(count * k, model.n, dtype=np.int64)), deviation,
                pa.array(model.whitened(x).reshape(-1)), pa.array(np.tile(model.explained, count)),
                pa.array(np.full(count * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(apply, OUTPUT)
