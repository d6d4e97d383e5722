"""Whitening of embeddings onto their leading principal components, by spectrum slicing.

The covariance is exact: whole numbers, centred on the whole number nearest the mean
before they are multiplied, are summed as whole numbers, so no order of partitions
changes a digit. Of its matrix (as many rows as a vector has components) only the leading
eigenpairs are found. The pivots of an LDLᵀ factorisation of the matrix less a shift have as many
negative signs as there are eigenvalues below the shift; bisection by these counts isolates one
eigenvalue, Rayleigh quotient iteration converges to it, and counts on
either side of the result certify its number.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.texts import column
from candlewick.llm.vectors import SCALE, largest, matrix, whole_vectors
from candlewick.workspace import written

COMPONENTS = 4
EXACT_DOUBLE, EXACT_LONG = 1 << 53, 1 << 62
BATCHES_OF_SUM = 256
EPS = float(np.finfo(float).eps)
_ALPHA = (1 + math.sqrt(17)) / 8
"""The bound of Bunch and Kaufman, below which a pair of rows makes a better pivot than one."""


def below(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``a`` are less than ``shift``: negative pivots of LDLᵀ of ``a - shift``."""
    a = a - shift * np.eye(len(a))
    n, k, negative = len(a), 0, 0
    while k < n:
        step, swap = _pivot(a, k)
        if step == 0:
            k += 1
            continue
        other = k + step - 1
        if swap != other:
            a[[other, swap], k:] = a[[swap, other], k:]
            a[k:, [other, swap]] = a[k:, [swap, other]]
        rest = a[k + step :, k : k + step]
        if step == 1:
            negative += a[k, k] < 0
            a[k + 1 :, k + 1 :] -= np.outer(rest[:, 0], rest[:, 0] / a[k, k])
        else:
            negative += 1  # a pair is taken only where its determinant is negative
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(a[k : k + 2, k : k + 2], rest.T)
        k += step
    return int(negative)


def _pivot(a: np.ndarray, k: int) -> tuple[int, int]:
    """Size of the next pivot (0: the column is zero) and the row that comes into its last place."""
    own, column_ = abs(a[k, k]), np.abs(a[k + 1 :, k])
    most = column_.max() if len(column_) else 0.0
    if max(own, most) == 0:
        return 0, k
    if own >= _ALPHA * most:
        return 1, k
    row = k + 1 + int(column_.argmax())
    across = np.abs(a[row, k:])
    across[row - k] = 0
    if own * across.max() >= _ALPHA * most * most:
        return 1, k
    return (1, row) if abs(a[row, row]) >= _ALPHA * across.max() else (2, row)


def leading_eigenpairs(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a covariance matrix, falling, and their unit eigenvectors as columns.

    Eigenvalues that are zero but for rounding are left out, so there may be fewer. Equal eigenvalues
    get orthogonal vectors. A vector's largest entry is positive.
    """
    size, scale = len(a), float(np.abs(a).sum(axis=1).max()) if len(a) else 0.0
    values, vectors = [], np.zeros((size, 0))
    if scale == 0:
        return np.zeros(0), vectors
    floor = 4 * size * EPS * scale
    for place in range(size - 1, max(-1, size - 1 - count), -1):
        if below(a, floor) > place:
            break
        value, vector = _eigenpair(a, place, scale, vectors)
        values.append(value)
        vectors = np.column_stack([vectors, vector * np.sign(vector[np.abs(vector).argmax()])])
    return np.array(values), vectors


def _eigenpair(a: np.ndarray, place: int, scale: float, found: np.ndarray) -> tuple[float, np.ndarray]:
    """Eigenvalue number ``place`` (from 0, rising) and a unit vector orthogonal to those ``found``."""
    size, low, high = len(a), -2 * EPS * scale, scale * (1 + 4 * EPS)
    under_low, under_high = 0, size
    narrow = 4 * size * EPS * scale
    rng = np.random.default_rng(place)
    while True:
        # Isolated, or a cluster that rounding can't part.
        while under_high - under_low > 1 and high - low > narrow:
            low, high, under_low, under_high = _halved(a, place, low, high, under_low, under_high)
        value, vector = _iterated(a, (low + high) / 2, _free(rng.normal(size=size), found), scale, found)
        margin = max(narrow, 4 * float(np.linalg.norm(a @ vector - value * vector)))
        inside = low - margin <= value <= high + margin
        if inside and below(a, value - margin) <= place < below(a, value + margin):
            return value, vector
        if high - low <= narrow:
            raise ArithmeticError(f"no eigenvector found for eigenvalue {place} near {value}")
        low, high, under_low, under_high = _halved(a, place, low, high, under_low, under_high)


def _halved(a: np.ndarray, place: int, low: float, high: float, under_low: int, under_high: int) -> tuple[float, float, int, int]:
    middle = (low + high) / 2
    under = below(a, middle)
    return (low, middle, under_low, under) if under > place else (middle, high, under, under_high)


def _free(vector: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The unit vector that is left without the directions ``found``."""
    for _ in range(2):
        vector = vector - found @ (found.T @ vector)
        vector = vector / np.linalg.norm(vector)
    return vector


def _iterated(a: np.ndarray, shift: float, vector: np.ndarray, scale: float, found: np.ndarray) -> tuple[float, np.ndarray]:
    """Inverse iteration at the middle of the bracket, then Rayleigh quotient iteration."""
    for step in range(40):
        vector = _free(_solved(a, shift, vector, scale), found)
        quotient = float(vector @ a @ vector)
        if np.linalg.norm(a @ vector - quotient * vector) <= 4 * EPS * scale:
            return quotient, vector
        if step > 1:
            shift = quotient
    return quotient, vector


def _solved(a: np.ndarray, shift: float, vector: np.ndarray, scale: float) -> np.ndarray:
    while True:
        try:
            solved = np.linalg.solve(a - shift * np.eye(len(a)), vector)
            if np.isfinite(solved).all():
                return solved
        except np.linalg.LinAlgError:
            pass
        shift += EPS * scale  # the shift was an eigenvalue to the last digit


@dataclass
class Whitening:
    """What rows are centred and projected by. ``sums`` are exact; so is ``n``, the number of different vectors."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n`` times the difference from the mean, exact: as longs, or as Python numbers where these might not do."""
        most = max([largest(x) * self.n, *map(abs, self.sums)])
        kind = np.int64 if most < EXACT_LONG // 2 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(float) @ self.vectors / np.sqrt(self.values)


def _exact(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    values = pa.array([Decimal(v) for _, v in rows], pa.decimal128(38))
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), values], ["place", "v"])


def _summed(fit: DataFrame, work) -> dict[int, int]:
    """Sums by place over all tasks of what ``work`` makes of each block of rows; the driver gets one number a place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, blocks = None, 0
        for batch in batches:
            if batch.num_rows:
                part = work(batch)
                total = part if total is None else total + part
                blocks += 1
            if blocks == BATCHES_OF_SUM:
                yield _exact(list(enumerate(total.tolist())))
                total, blocks = None, 0
        if total is not None:
            yield _exact(list(enumerate(total.tolist())))

    sums = fit.mapInArrow(run, "place int, v decimal(38,0)").groupBy("place").agg(F.sum("v").alias("v"))
    return {r["place"]: int(r["v"]) for r in sums.collect()}


def _column_sums(dims: int):
    def work(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch, dims)
        return (x if largest(x) * len(x) * BATCHES_OF_SUM < EXACT_LONG else x.astype(object)).sum(axis=0)

    return work


def _products(dims: int, centre: list[int]):
    upper = np.triu_indices(dims)

    def work(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch, dims)
        # Products of doubles are exact while the sums stay below 2**53.
        if (largest(x) + max(map(abs, centre), default=0)) ** 2 * len(x) < EXACT_DOUBLE:
            y = (x - np.array(centre)).astype(float)
            return (y.T @ y).astype(np.int64)[upper]
        y = x.astype(object) - np.array(centre, object)
        return (y.T @ y)[upper]

    return work


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, float]:
    """The whitening of each different vector of ``x`` once, and its identity error: the largest
    absolute entry of the covariance of what it makes of these, less the identity.

    The driver holds a matrix of the vectors' length squared and nothing that grows with the rows.
    """
    dims = vectors.agg(F.max(F.size("x"))).first()[0] or 0
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("x")))
    distinct = written(vectors.select(padded.alias("x")).distinct(), "different-vectors")
    n = distinct.count()
    if not n or not dims:
        return Whitening(n, [0] * dims, np.zeros(0), np.zeros((dims, 0)), np.zeros(0)), 0.0
    by_place = _summed(distinct, _column_sums(dims))
    sums = [by_place[i] for i in range(dims)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    products = _summed(distinct, _products(dims, centre))
    left = [s - n * c for s, c in zip(sums, centre, strict=True)]
    covariance = np.zeros((dims, dims))
    for place, (i, j) in enumerate(zip(*np.triu_indices(dims), strict=True)):
        covariance[i, j] = covariance[j, i] = (n * products[place] - left[i] * left[j]) / (n * n)
    values, found = leading_eigenpairs(covariance, components)
    trace = float(np.trace(covariance))
    model = Whitening(n, sums, values, found, values / trace if trace else values)
    return model, _identity_error(distinct, model)


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    count = len(model.values)
    if not count:
        return 0.0
    names, dims = [f"w{i}" for i in range(count)], len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whitened = model.project(model.centred(matrix(batch, dims)))
            yield pa.RecordBatch.from_arrays([pa.array(w) for w in whitened.T], names)

    whitened = distinct.mapInArrow(run, ", ".join(f"{w} double" for w in names))
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    covariances = whitened.agg(*[F.covar_pop(names[i], names[j]) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(covariances, pairs, strict=True))


SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whitened(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Every vector on each of the leading components, whitened: one row per vector and component.

    ``n`` is the number of different vectors, ``deviation`` the sum over the entries of
    (n x - S)² (null where no long holds it), ``explained`` the component's share of the variance. Vectors
    that are null or hold a null or non-finite entry are dropped; a shorter vector has zeros in its missing
    places. Repeated rows count once in the covariance and all come back. Components
    without variance can't be whitened and have no rows, so a table of equal vectors, like an empty one, gives none.
    """
    vectors = whole_vectors(df, id_col, vector_col, scale)
    model, error = fit(vectors, components)
    count, dims = len(model.values), len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not count or not batch.num_rows:
                continue
            centred = model.centred(matrix(batch, dims))
            squares = centred if largest(centred) ** 2 * dims < EXACT_LONG else centred.astype(object)
            deviation = [d if d < 1 << 63 else None for d in (squares * squares).sum(axis=1).tolist()]
            rows = np.repeat(np.arange(batch.num_rows), count)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "vec_id").take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(len(rows), model.n)),
                    pa.array(deviation, pa.int64()).take(pa.array(rows)),
                    pa.array(model.project(centred).ravel()),
                    pa.array(np.tile(model.explained, batch.num_rows)),
                    pa.array(np.full(len(rows), error)),
                ],
                [f.split()[0] for f in SCHEMA.split(", ")],
            )

    return vectors.mapInArrow(run, SCHEMA)
