"""Embedding whitening by the exact characteristic polynomial of the integer scatter matrix."""

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope.llm import integer_spectrum
from replyscope.llm.common import keep

COMPONENTS = 16
#: Entries of a vector are counted in steps of 1 / SCALE.
SCALE = 64
LIMB = 18
DIGIT = 32
LONGEST = np.iinfo(np.int64).max


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Rows (vec_id, x): the entries in whole steps, for vectors of which every entry is a finite number."""
    e = F.col(f"`{vector_col}`").cast("array<double>")
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    # products beyond the range of long end at its limits
    steps = F.transform(e, lambda v: F.floor(F.greatest(F.least(v, F.lit(2.0**62 / scale)), F.lit(-(2.0**62) / scale)) * scale))
    return vectors.where(e.isNotNull() & ~F.exists(e, odd)).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), steps.alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64, copy=False).reshape(-1, d)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as sums of limbs * 2**(LIMB * k), in doubles whose products add up exactly."""
    out, most = [], int(np.abs(x).max(initial=0))
    while most >> LIMB:
        out.append((x & ((1 << LIMB) - 1)).astype(np.float64))
        x, most = x >> LIMB, most >> LIMB
    return [*out, x.astype(np.float64)]


def _products(x: np.ndarray) -> np.ndarray:
    """x'x with exact whole numbers."""
    limbs, total = _limbs(x), 0
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total = total + (a.T @ b).astype(np.int64).astype(object) * (1 << (LIMB * (i + j)))
    return total


def scatter(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """Count, sums and sums of products of the vectors ``x``, exact: each task adds up its own rows, and Spark adds the
    digits of the tasks' sums. What comes to the driver is d * (d + 3) / 2 + 1 numbers."""
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)
        for batch in batches:
            every = _matrix(batch.column(0), d)
            for k in range(0, len(every), 8192):
                x = every[k : k + 8192]
                n += len(x)
                sums = sums + sum(limb.sum(axis=0).astype(np.int64).astype(object) * (1 << (LIMB * i)) for i, limb in enumerate(_limbs(x)))
                products = products + _products(x)
        rows = []
        for at, value in enumerate([n, *sums, *products[upper]] if n else []):
            digit = 0
            while not -(1 << DIGIT) < value < 1 << DIGIT:
                rows.append((at, digit, value & ((1 << DIGIT) - 1)))
                value, digit = value >> DIGIT, digit + 1
            rows.append((at, digit, value))
        columns = list(zip(*rows)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["at", "digit", "value"])

    parts = fit.select("x").mapInArrow(run, "at long, digit long, value long").groupBy("at", "digit").agg(F.sum("value").alias("value"))
    found = [0] * (1 + d + len(upper[0]))
    for at, digit, value in parts.collect():
        found[at] += value << (DIGIT * digit)
    products = [[0] * d for _ in range(d)]
    for i, j, value in zip(*(u.tolist() for u in upper), found[1 + d :]):
        products[i][j] = products[j][i] = value
    return found[0], found[1 : 1 + d], products


def characteristic_polynomial(like: DataFrame, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(t I - matrix) for a positive semidefinite matrix of whole numbers, constant first: images modulo
    primes, one Hessenberg reduction each and dealt over tasks, joined by the Chinese remainder theorem."""
    spark, d = like.sparkSession, len(matrix)
    bits = integer_spectrum.coefficient_bits(sum(matrix[i][i] for i in range(d)), d)
    primes = integer_spectrum.primes_below(1 << integer_spectrum.PRIME_BITS, bits // (integer_spectrum.PRIME_BITS - 1) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_pylist()
            images = []
            for k in at:
                residues = np.array([[x % primes[k] for x in row] for row in matrix], dtype=np.int64)
                images.append(integer_spectrum.polynomial_mod(residues, primes[k]))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(images, pa.list_(pa.int64()))], names=["at", "image"])

    parts = min(len(primes), max(1, spark.sparkContext.defaultParallelism))
    images = dict(spark.range(0, len(primes), 1, parts).mapInArrow(run, "at long, image array<long>").collect())
    return integer_spectrum.chinese([images[k] for k in range(len(primes))], primes)


class Whitening:
    """Components of the fit list: n, sums, unit vectors (columns), square roots of the scatter's roots, shares of the trace."""

    def __init__(self, n: int, sums: list[int], vectors: np.ndarray, lengths: np.ndarray, shares: list[float]):
        self.n, self.sums, self.vectors, self.lengths, self.shares = n, sums, vectors, lengths, shares

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n x - S)'s coordinates over the roots' square roots, and its exact square sum (whole numbers; object if large)."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if most <= LONGEST:
            away = x * np.int64(self.n) - np.array(self.sums, dtype=np.int64)
        else:
            away = x.astype(object) * self.n - np.array(self.sums, dtype=object)
        exact = away if most * most * x.shape[1] <= LONGEST else away.astype(object)
        return away.astype(np.float64) @ self.vectors / self.lengths, (exact * exact).sum(axis=1)


def fit_whitening(fit: DataFrame, d: int, components: int) -> Whitening | None:
    """The largest components of the distinct vectors ``x`` of ``fit``; None without any spread. Roots of 0 make no component."""
    n, sums, products = scatter(fit, d)
    # n * n times the covariance, centred exactly
    matrix = [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(matrix[i][i] for i in range(d))
    if not trace:
        return None
    polynomial = characteristic_polynomial(fit, matrix)
    vectors, lengths, shares = [], [], []
    for value, multiplicity, gap in integer_spectrum.largest_roots(polynomial, components):
        wanted = min(multiplicity, components - len(vectors))
        for v in integer_spectrum.null_vectors(matrix, value, wanted, gap):
            vectors.append([float(c) for c in v])
            lengths.append(integer_spectrum.square_root(value))
            shares.append(float(Fraction(value) / trace))
    return Whitening(n, sums, np.array(vectors).T, np.array(lengths), shares)


def identity_error(fit: DataFrame, d: int, made: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity; tasks add up their own rows."""
    k = len(made.shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z, _ = made.apply(_matrix(batch.column(0), d))
            sums, products = sums + z.sum(axis=0), products + z.T @ z
        values = np.concatenate([sums, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["at", "value"])

    parts = fit.select("x").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    total = np.array([v for _, v in sorted(parts.collect())]) / made.n
    mean = total[:k]
    return float(np.abs(total[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE
) -> DataFrame:
    """Whitened coordinates of each vector along the largest principal components.

    Each entry is counted in whole steps, x = floor(scale * entry); a constant added to x cancels in every result, so none
    is. The fit list is each distinct x vector once. Its scatter matrix, n times the products minus the product of the sums, is exact;
    so are its characteristic polynomial and the intervals that hold its roots, with their multiplicities. Per row and component, by falling root:
    vec_id, component (from 1), n (fit list), deviation (sum of (n * x - sums)**2, exact; null beyond the range of long), whitened,
    explained (share of the trace), identity_error (of the whole result).

    Left out are null vectors, vectors with null or non-finite entries, and vectors whose length is not the most frequent
    one (of equally frequent ones, the longest). Components without spread (roots of 0) do not exist: a table with one distinct
    vector, or none, gives no rows. Entries beyond 2**62 / scale count as that. Null ids and repeated rows stay;
    other columns are left out. Equal roots share a space; which basis of it is returned is fixed by the matrix.

    Of the data only counts, sums and products come to the driver, d * (d + 3) / 2 numbers for d dimensions.
    """
    spark = vectors.sparkSession
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    rows = keep(whole_vectors(vectors, id_col, vector_col, scale), "whole-vectors")
    size: Column = F.size("x")
    common = rows.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None or not common["d"]:
        return spark.createDataFrame([], schema)
    d = common["d"]
    rows = rows.where(size == d)
    fit = keep(rows.select("x").distinct(), "fit-list")
    made = fit_whitening(fit, d, components)
    if made is None:
        return spark.createDataFrame([], schema)
    error, k = identity_error(fit, d, made), len(made.shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, squares = made.apply(_matrix(batch.column(1), d))
            m = len(z)
            deviation = pa.array([v if v <= LONGEST else None for v in squares.tolist()], pa.int64())
            of_row = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(of_row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, made.n, dtype=np.int64)), deviation.take(of_row), pa.array(z.ravel()),
                    pa.array(np.tile(np.array(made.shares), m)), pa.array(np.full(m * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select("vec_id", "x").mapInArrow(run, schema)
