"""Embedding whitening by spectrum slicing.

Components become integers, so that the number of distinct vectors, their sums
and their products are exact whatever the partitioning: tasks add up products of
vectors centred by the whole-number mean, and what the mean leaves over is
taken off exactly.  Only the sums of the tasks (the square of the dimension) are
brought together.

The leading eigenvalues of the covariance ``V`` are isolated by slicing: the
number of positive pivots of an LDL' factorisation of ``V - s I`` is the number
of eigenvalues above ``s`` (Sylvester), so bisection finds an interval for the
i-th one alone.  Rayleigh quotient iteration from there converges cubically to
its eigenvector; a step that leaves the interval narrows it and starts again.
Counts just below and above the value found certify its number.  Eigenvalues that
no interval of working precision parts get vectors orthogonal to each other.

Defined cases: vectors that are null, or hold null or non-finite components, are
dropped; so are those whose length is not that of the smallest id left (null
last), and those with a component of 2^38 or more in size.  Repeated rows are
whitened each and fitted once.  Eigenvalues that are zero to working
precision, as with few distinct vectors, give no component; so a single distinct
vector gives no rows.  A deviation beyond a long is null.  Ids may be null or
repeated; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, keep, read

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
LARGEST = float(1 << 44)
#: An eigenvalue under this share of the trace is taken for zero.
ZERO = 1e-12
EPS = float(np.finfo(float).eps)


# ---------------------------------------------------------------- eigenvalues

def count_above(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of the symmetric ``a`` above ``shift``: the positive
    pivots of LDL' with diagonal pivoting, in blocks of one or two (Bunch-Parlett)."""
    w = a - shift * np.eye(len(a))
    above, alpha = 0, (1 + 17 ** 0.5) / 8
    while len(w):
        size = np.abs(w)
        diagonal = size.diagonal().copy()
        i = int(diagonal.argmax())
        np.fill_diagonal(size, -1.0)
        r, c = divmod(int(size.argmax()), len(w))
        if diagonal[i] >= alpha * size[r, c]:
            if diagonal[i] == 0:
                break           # what is left is zero: at the shift, not above
            above += int(w[i, i] > 0)
            rest = np.delete(np.arange(len(w)), i)
            w = w[np.ix_(rest, rest)] - np.outer(w[rest, i], w[i, rest]) / w[i, i]
        else:
            above += 1          # such a block has one eigenvalue of each sign
            rest = np.delete(np.arange(len(w)), [r, c])
            pair = w[np.ix_(rest, [r, c])]
            w = w[np.ix_(rest, rest)] - pair @ np.linalg.solve(w[np.ix_([r, c], [r, c])], pair.T)
        w = (w + w.T) / 2
    return above


@dataclass
class Slice:
    value: float
    vector: np.ndarray
    steps: int


def _rayleigh(a: np.ndarray, low: float, high: float, found: list[np.ndarray], norm: float,
              most: int = 30) -> tuple[float, np.ndarray, int] | None:
    """An eigenpair in ``(low, high]`` orthogonal to those found, or None when
    the iteration leaves the interval."""
    n = len(a)
    x = np.sin(np.arange(1, n + 1) * 1.618 + len(found))      # any start that is no special direction
    basis = np.array(found).reshape(len(found), n)
    slack = 4 * n * EPS * norm
    shift, best = (low + high) / 2, None
    for step in range(most):
        for jitter in (0.0, 1.0, -3.0):
            try:
                x = np.linalg.solve(a - (shift + jitter * EPS * norm) * np.eye(n), x)
                break
            except np.linalg.LinAlgError:
                continue
        for _ in range(2):
            x = x - basis.T @ (basis @ x)
            x = x / np.linalg.norm(x)
        value = float(x @ a @ x)
        residual = float(np.linalg.norm(a @ x - value * x))
        if best is not None and residual <= slack and residual >= best / 2:
            return (value, x, step + 1) if low - slack <= value <= high + slack else None
        # the first steps stay at the middle, until the vector has turned to the slice
        if low < value <= high and (step >= 1 or residual < (high - low) / 4):
            shift = value
        elif step >= 4:
            return None
        best = residual if best is None else min(best, residual)
    return None


def leading(a: np.ndarray, k: int, least: float) -> list[Slice]:
    """The ``k`` largest eigenvalues above ``least`` with unit eigenvectors,
    falling; their numbers are certified by counts."""
    n = len(a)
    reach = np.abs(a).sum(axis=1) - np.abs(a.diagonal())
    norm = float(np.abs(a).sum(axis=1).max()) or 1.0
    bottom, top = float((a.diagonal() - reach).min()) - EPS * norm, float((a.diagonal() + reach).max()) + EPS * norm
    counts = {bottom: n, top: 0}

    def count(s: float) -> int:
        if s not in counts:
            counts[s] = count_above(a, s)
        return counts[s]

    total = count(least) if bottom < least < top else (n if least <= bottom else 0)
    out: list[Slice] = []
    narrow = 8 * n * EPS * norm
    for i in range(1, min(k, total) + 1):
        while True:
            low = max(s for s, c in counts.items() if c >= i)
            high = min(s for s, c in counts.items() if c < i)
            alone = counts[low] == i and counts[high] == i - 1
            if alone or high - low <= narrow:
                got = _rayleigh(a, low, high, [s.vector for s in out], norm)
                if got and _certified(count, got[0], i, narrow):
                    break
                if high - low <= narrow:
                    raise ArithmeticError(f"eigenvalue {i} in ({low}, {high}] was not found")
            count((low + high) / 2)
        out.append(Slice(*got))
    return out


def _certified(count: Callable[[float], int], value: float, i: int, room: float) -> bool:
    return count(value - room) >= i > count(value + room)


# ---------------------------------------------------------------- on Spark

def integers(vectors: DataFrame) -> DataFrame:
    """``vec_id, x array<long>`` of the rows that take part, of any length."""
    v = F.col("embedding").cast("array<double>")
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull())
            .where(~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * SCALE >= LARGEST)))
            .select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x")))


def _rows(column: pa.Array, length: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(column), length)


def products(y: np.ndarray) -> np.ndarray:
    """Exact ``y' y`` of integers, as Python integers: in doubles by lots of rows
    whose sums stay under 2^53."""
    out = np.zeros((y.shape[1], y.shape[1]), object)
    largest = int(np.abs(y).max()) if y.size else 0
    lot = (1 << 53) // max(1, largest * largest)
    if lot < 1:
        wide = y.astype(object)
        return wide.T @ wide
    for at in range(0, len(y), lot):
        part = y[at:at + lot].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def _sums(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, np.zeros(length, object)
        for batch in batches:
            x = _rows(batch.column("x"), length)
            n, s = n + len(x), s + x.sum(axis=0).astype(object)      # under 2^63 for a batch
        yield _words([(0, [n, *s.tolist()])])
    return run


def _products(length: int, mean: list[int]):
    centre = np.array(mean, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length, length), object)
        for batch in batches:
            total += products(_rows(batch.column("x"), length) - centre)
        yield _words([(i, row.tolist()) for i, row in enumerate(total)])
    return run


WORDS = "i int, words array<struct<hi:long,lo:long>>"
_WORD = pa.struct([("hi", pa.int64()), ("lo", pa.int64())])


def _words(rows: list[tuple[int, list[int]]]) -> pa.RecordBatch:
    """Integers as two words, which Spark adds up apart."""
    words = [[{"hi": int(v) >> 40, "lo": int(v) & ((1 << 40) - 1)} for v in row] for _, row in rows]
    return pa.record_batch({"i": pa.array([i for i, _ in rows], pa.int32()), "words": pa.array(words, pa.list_(_WORD))})


def _added(parts: DataFrame, rows: int, length: int) -> np.ndarray:
    """Sums over tasks: a row per place, ``rows * length`` of them."""
    sums = (parts.select("i", F.posexplode("words").alias("j", "w")).groupBy("i", "j")
            .agg(F.sum("w.hi").alias("hi"), F.sum("w.lo").alias("lo")))
    out = np.zeros((rows, length), object)
    for r in sums.collect():
        out[r["i"], r["j"]] = (r["hi"] << 40) + r["lo"]
    return out


@dataclass
class Whitening:
    """A fit: ``x`` is whitened as ``(x - sums / n) @ vectors / sqrt(values)``."""

    n: int
    sums: list[int]
    mean: list[int]         # whole part of the mean, for centring without loss
    values: np.ndarray
    vectors: np.ndarray     # a column per component
    trace: float

    @property
    def over(self) -> list[int]:
        return [s - self.n * m for s, m in zip(self.sums, self.mean)]

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened rows of vectors already centred by ``mean``."""
        rest = np.array([o / self.n for o in self.over])
        return (y - rest) @ (self.vectors / np.sqrt(self.values))


def covariance(n: int, over: list[int], grams: np.ndarray) -> np.ndarray:
    """From the products of centred vectors: each entry rounded once."""
    d = len(over)
    v = np.zeros((d, d))
    for i in range(d):
        for j in range(i + 1):
            v[i, j] = v[j, i] = (n * grams[i, j] - over[i] * over[j]) / (n * n)
    return v


def fit(points: DataFrame, length: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on ``points (x array<long>)``, each row once; None without rows or
    without any spread."""
    if not length:
        return None
    n, *sums = _added(points.mapInArrow(_sums(length), WORDS), 1, length + 1)[0]
    if not n:
        return None
    mean = [s // n for s in sums]
    model = Whitening(n, sums, mean, np.zeros(0), np.zeros((length, 0)), 0.0)
    grams = _added(points.mapInArrow(_products(length, mean), WORDS), length, length)
    v = covariance(n, model.over, grams)
    model.trace = float(v.trace())
    if model.trace <= 0:
        return None
    slices = leading(v, components, ZERO * model.trace)
    model.values = np.array([s.value for s in slices])
    model.vectors = np.array([s.vector for s in slices]).reshape(len(slices), length).T
    return model


def _second_moments(model: Whitening):
    centre, length = np.array(model.mean, np.int64), len(model.mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        total, first = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            z = model.project(_rows(batch.column("x"), length) - centre)
            total, first = total + z.T @ z, first + z.sum(axis=0)
        rows = [*total.tolist(), first.tolist()]
        yield pa.record_batch({"i": pa.array(range(len(rows)), pa.int32()),
                               "sums": pa.array(rows, pa.list_(pa.float64()))})
    return run


def identity_error(points: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened points' covariance less the identity."""
    sums = (points.mapInArrow(_second_moments(model), "i int, sums array<double>")
            .select("i", F.posexplode("sums").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    k = len(model.values)
    m = np.zeros((k + 1, k))
    for r in sums:
        m[r["i"], r["j"]] = r["v"] / model.n
    return float(np.abs(m[:k] - np.outer(m[k], m[k]) - np.eye(k)).max())


def deviations(y: np.ndarray, n: int, over: list[int]) -> list[int | None]:
    """``sum((n x - S)^2)`` of each row, from rows centred by the mean's whole part."""
    most = n * (int(np.abs(y).max()) + 1) if y.size else 0       # |n y - over| is no larger: 0 <= over < n
    if most * most * max(1, y.shape[1]) < 1 << 63:
        return ((n * y - np.array(over, np.int64)) ** 2).sum(axis=1).tolist()
    wide = ((n * y.astype(object) - np.array(over, object)) ** 2).sum(axis=1)
    return [d if d < 1 << 63 else None for d in wide.tolist()]


def _whitened(model: Whitening):
    centre, length = np.array(model.mean, np.int64), len(model.mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            y = _rows(batch.column("x"), length) - centre
            z, dev = model.project(y), deviations(y, model.n, model.over)
            again = pa.array(np.repeat(np.arange(len(y)), k))
            yield pa.record_batch({
                "vec_id": batch.column("vec_id").take(again),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                "deviation": pa.array(dev, pa.int64()).take(again),
                "whitened": pa.array(z.ravel()),
                "explained": pa.array(np.tile(model.explained, len(y)))})
    return run


WHITENED = "vec_id long, component int, deviation long, whitened double, explained double"


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None, float]:
    """A row of ``WHITENED`` for each vector and component, the fit and its
    identity error."""
    rows = integers(vectors)
    smallest = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(1).collect()
    length = len(smallest[0]["x"]) if smallest else 0
    rows = rows.where(F.size("x") == length)
    points = keep(rows.select("x").distinct(), "points")      # copies are dropped before they are shuffled
    model = fit(points, length, components)
    error = identity_error(points, model) if model is not None and len(model.values) else 0.0
    forget(points)
    if model is None:
        return vectors.sparkSession.createDataFrame([], WHITENED), None, error
    return rows.mapInArrow(_whitened(model), WHITENED), model, error


def op13_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model, error = whiten(read(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "component", F.lit(model.n if model else 0).cast("long").alias("n"), "deviation",
                       "whitened", "explained", F.lit(error).alias("identity_error"))
