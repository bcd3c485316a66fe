"""Embedding whitening from polarised covariances (operator 11).

A vector becomes whole numbers x = floor(SCALE * entry) of its entries as
doubles.  The fit list holds each distinct x vector once.

1. Fit list.  Distinct x vectors, aggregated map-side first, so a vector that
   holds a third of all rows moves once per task; written to the shared folder.
2. Sums.  Number of vectors n and exact sums S of every dimension.
3. Squares.  For every dimension, and the sum of every pair of dimensions, the
   squares of the centred values are aggregated as exact integers.  Values are
   centred at the whole number next to S / n; what is left of the mean, under
   one half a dimension, is taken off in exact integer arithmetic.
4. Polarisation.  var(i + j) - var(i) - var(j) = 2 cov(i, j): differences of
   exact integers give every covariance (divisor n), correctly rounded.
5. ``eigh`` of that matrix on the driver, then one pass whitens every row:
   (x - S / n) projected on a unit eigenvector, over the root of its eigenvalue.

The driver and each task hold d (d + 1) / 2 numbers for d dimensions, whatever
the number of rows.

Rows whose vector is null, or holds null, NaN or infinite entries, are dropped.
Vectors of another length than the most frequent one (of equally frequent ones
the longest) are dropped too.  Entries beyond the long range after scaling take
the nearest long.  ``deviation`` is null where it exceeds a long.  A component
whose eigenvalue is zero to rounding has null ``whitened``; ``explained`` is null
where all vectors are equal.  Null ids stay; repeated rows each get their rows.
Empty tables, and those without a valid vector, give no rows.  Columns other
than id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.text import prepare, written

SCALE = 256
COMPONENTS = 4
ROWS = 4096  # vectors held as one array
LONG = (1 << 63) - 1


@dataclass
class Fit:
    """Exact moments of the fit list and the components of its covariance."""

    n: int
    sums: list[int]
    largest: int  # of |x|
    covariance: np.ndarray
    values: np.ndarray  # falling
    vectors: np.ndarray  # one column per component


def whole(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, x) of the valid rows of ``vectors``."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(finite).select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x"))


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """The x vectors of a batch as arrays of at most ``ROWS`` rows."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        yield part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1), part


def exact_type(largest: int, rows: int) -> type:
    """int64 where sums of ``rows`` squares of values up to ``largest`` fit, else Python's integers."""
    return np.int64 if rows * largest * largest < LONG else object


def summed(listed: DataFrame, sums, n_sums: int) -> list[int]:
    """Exact totals of ``sums(x)`` (n_sums whole numbers per array of vectors) over the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * n_sums
        for batch in batches:
            for x, _ in matrices(batch):
                total = [a + int(b) for a, b in zip(total, sums(x))]
        # 18 digits at a time: exact at any size, in longs
        part = [(k, e, t // 10 ** (18 * e) % 10 ** 18 if t >= 0 else -(-t // 10 ** (18 * e) % 10 ** 18))
                for k, t in enumerate(total) for e in range(1 + len(str(abs(t))) // 18)]
        yield pa.RecordBatch.from_arrays([pa.array([p[c] for p in part], pa.int64()) for c in range(3)], names=["k", "e", "part"])

    limbs = listed.mapInArrow(run, "k long, e long, part long").groupBy("k", "e").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s"))
    out = [0] * n_sums
    for r in limbs.collect():  # n_sums times the limbs of one number
        out[r["k"]] += int(r["s"]) * 10 ** (18 * r["e"])
    return out


def square_sums(centre: np.ndarray, largest: int):
    """Function of an array of vectors: sums of squares of every centred dimension, then of every sum of two of them."""

    def run(x: np.ndarray) -> list[int]:
        r = x.astype(exact_type(2 * largest, len(x))) - centre
        out = [(r * r).sum(axis=0)]
        for i in range(r.shape[1] - 1):
            pair = r[:, i:i + 1] + r[:, i + 1:]
            out.append((pair * pair).sum(axis=0))
        return np.concatenate(out).tolist()

    return run


def covariance(n: int, sums: list[int], centre: list[int], squares: list[int]) -> np.ndarray:
    """The covariance matrix from exact sums of squares of centred dimensions and of their pairwise sums."""
    d = len(sums)
    rest = [s - n * c for s, c in zip(sums, centre)]  # sums of the values centred at whole numbers
    scaled = lambda square, left: n * square - left * left  # n * n * variance
    var = [scaled(squares[i], rest[i]) for i in range(d)]
    out, at = np.zeros((d, d)), d
    for i in range(d):
        out[i, i] = var[i] / (n * n)
        for j in range(i + 1, d):
            both = scaled(squares[at], rest[i] + rest[j])
            out[i, j] = out[j, i] = (both - var[i] - var[j]) / (2 * n * n)
            at += 1
    return out


def fit(listed: DataFrame, d: int) -> Fit:
    """Moments and components of the fit list (column x, vectors of length d)."""
    n, low, high = listed.agg(F.count(F.lit(1)), F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    largest = max(abs(low), abs(high))
    sums = summed(listed, lambda x: x.astype(np.int64 if ROWS * largest < LONG else object).sum(axis=0).tolist(), d)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    square = square_sums(np.array(centre, np.int64 if largest < LONG // 4 else object), largest)
    matrix = covariance(n, sums, centre, summed(listed, square, d * (d + 1) // 2))
    values, vectors = np.linalg.eigh(matrix)
    vectors = vectors[:, ::-1]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(d)])  # one of the two signs, always the same
    return Fit(n, sums, largest, matrix, values[::-1], vectors)


def projector(found: Fit, components: int):
    """Function of an array of vectors: whitened values of the first components, NaN where the eigenvalue is zero to rounding."""
    k = min(components, len(found.sums))
    low = found.values[0] * len(found.sums) * np.finfo(float).eps
    over = np.array([1 / np.sqrt(v) if v > low and v > 0 else np.nan for v in found.values[:k]])
    mean = np.array([s / found.n for s in found.sums])
    axes = found.vectors[:, :k]
    return lambda x: ((x.astype(np.float64) - mean) @ axes) * over


def deviations(found: Fit):
    """Function of an array of vectors: exact sums over dimensions of (n * x - S) ** 2; None beyond a long."""
    n, sums = found.n, found.sums
    most = n * found.largest + max(map(abs, sums))

    def run(x: np.ndarray) -> list[int | None]:
        kind = exact_type(most, len(sums))
        z = x.astype(kind) * n - np.array(sums, kind)
        return [v if v <= LONG else None for v in (z * z).sum(axis=1).tolist()]

    return run


def identity_error(listed: DataFrame, found: Fit, components: int) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, over components that have values."""
    project = projector(found, components)
    k = min(components, len(found.sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, cross = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for x, _ in matrices(batch):
                w = project(x)
                total += w.sum(axis=0)
                cross += w.T @ w
        both = np.concatenate([total, cross.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both))), pa.array(both)], names=["k", "s"])

    rows = listed.mapInArrow(run, "k long, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    both = np.zeros(k + k * k)
    for r in rows:
        both[r["k"]] = r["s"]
    mean = both[:k] / found.n  # zero to rounding: the values are centred before they are multiplied
    error = np.abs(both[k:].reshape(k, k) / found.n - np.outer(mean, mean) - np.eye(k))
    error = error[~np.isnan(error)]
    return float(error.max()) if len(error) else None


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every valid row and component up to ``components``."""
    spark = prepare(vectors.sparkSession)
    valid = whole(vectors, vec_id, embedding)
    schema = (f"vec_id {valid.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, "
              "whitened double, explained double, identity_error double")
    lengths = valid.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    d = lengths["d"] if lengths else 0
    if not d:
        return spark.createDataFrame([], schema)
    valid = valid.where(F.size("x") == d)
    listed = written(valid.select("x").distinct(), "fit_list")
    found = fit(listed, d)
    error = identity_error(listed, found, components)
    project, deviation, trace = projector(found, components), deviations(found), float(np.trace(found.covariance))
    k = min(components, d)
    explained = [max(0.0, float(v)) / trace if trace > 0 else None for v in found.values[:k]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, part in matrices(batch):
                rows = part.num_rows
                owner = np.repeat(np.arange(rows), k)
                w = project(x).ravel()
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(owner)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                     pa.array(np.full(rows * k, found.n)), pa.array(deviation(x), pa.int64()).take(pa.array(owner)),
                     pa.array(w, mask=np.isnan(w)), pa.array(explained * rows, pa.float64()),
                     pa.array([error] * (rows * k), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return valid.mapInArrow(run, schema)
