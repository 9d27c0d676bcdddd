"""Exact polynomials, roots and null vectors against brute force; whitened rows against numpy."""

import random
from fractions import Fraction
from math import floor, inf, nan

import numpy as np
import pytest

from replyscope.llm import integer_spectrum as spectrum
from replyscope.llm import polynomial_whitening as pw

DATA = "/root/testdata/sf0.001"


def faddeev(matrix):
    """Characteristic polynomial by traces of powers, in fractions."""
    d = len(matrix)
    m, out = [[Fraction(0)] * d for _ in range(d)], [Fraction(0)] * d + [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][l] * m[l][j] for l in range(d)) + (out[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        out[d - k] = -sum(sum(matrix[i][l] * m[l][i] for l in range(d)) for i in range(d)) / k
    return [int(x) for x in out]


def scatter_of(rows):
    n, d = len(rows), len(rows[0])
    s = [sum(r[i] for r in rows) for i in range(d)]
    return [[n * sum(r[i] * r[j] for r in rows) - s[i] * s[j] for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("d, n, size", [(1, 3, 5), (4, 9, 3), (6, 4, 9), (7, 20, 2**40)])
def test_polynomial(spark, d, n, size):
    rng = random.Random(d)
    matrix = scatter_of([[rng.randint(-size, size) for _ in range(d)] for _ in range(n)])
    assert pw.characteristic_polynomial(spark.range(1), matrix) == faddeev(matrix)


def test_roots_with_multiplicities():
    rng = random.Random(3)
    for _ in range(40):
        values = sorted((rng.choice([0, 0, 1, 2, 3, 7, 7, 1000, 1001, 10**12]) for _ in range(rng.randint(1, 9))), reverse=True)
        f = [1]
        for v in values:
            f = [(f[k - 1] if k else 0) - v * (f[k] if k < len(f) else 0) for k in range(len(f) + 1)]
        got = spectrum.largest_roots(f, 5)
        held = [round(v) for v, m, _ in got for _ in range(m)]
        want = [v for v in values if v]
        assert held == want[: len(held)] and len(held) >= min(5, len(want))
        for value, _, gap in got:
            others = [v for v in {*values, 0} if v != round(value)]
            assert abs(value - round(value)) * (1 << 100) < gap and all(gap <= abs(value - v) for v in others)
            assert abs(spectrum.square_root(value) ** 2 / float(value) - 1) < 1e-15


def test_close_roots_are_told_apart():
    """Roots 10**9 and 10**9 + 1 of a matrix turned by whole numbers, and an irrational pair."""
    f = [1]
    for v in (10**9, 10**9 + 1, 3):
        f = [(f[k - 1] if k else 0) - v * (f[k] if k < len(f) else 0) for k in range(len(f) + 1)]
    assert [round(v) for v, _, _ in spectrum.largest_roots(f, 3)] == [10**9 + 1, 10**9, 3]
    (a, _, _), (b, _, _) = spectrum.largest_roots([1, -3, 1], 2)
    assert abs(a + b - 3) < Fraction(1, 1 << 90) and abs(a * b - 1) < Fraction(1, 1 << 90)


def brute(rows, components):
    """Rows (vec_id, vector) of equal length to {vec_id: ...}, all from numpy in double precision on exact sums."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and c == c and abs(c) != inf for c in v)]
    whole = [(i, tuple(floor(64 * c) + 1_000_000 for c in v)) for i, v in good]
    fit = sorted({x for _, x in whole})
    matrix, n, d = scatter_of(fit), len(fit), len(fit[0])
    values, vectors = np.linalg.eigh(np.array([[float(x) for x in r] for r in matrix]))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    sums = [sum(x[k] for x in fit) for k in range(d)]
    away = [[n * c - s for c, s in zip(x, sums)] for _, x in whole]
    z = np.array([[float(c) for c in r] for r in away]) @ vectors / np.sqrt(values)
    return n, [i for i, _ in whole], [sum(c * c for c in r) for r in away], z, values / sum(matrix[i][i] for i in range(d))


def check(got, rows, components):
    n, ids, deviation, z, shares = brute(rows, components)
    table = {}
    for r in got:
        table.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    assert len(got) == len(ids) * components and {r.n for r in got} == {n}
    signs = None
    for i, dev, want in zip(ids, deviation, z):
        mine = table[i, dev]
        have = np.array([mine[k + 1].whitened for k in range(components)])
        signs = np.sign(have * want) if signs is None else signs
        assert np.allclose(have, signs * want, rtol=1e-9, atol=1e-9)
        assert np.allclose([mine[k + 1].explained for k in range(components)], shares, rtol=1e-10)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-10


def test_whole_table(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    check(pw.whiten(df).collect(), [(r.vec_id, r.embedding) for r in df.collect()], 16)


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 3), rng.gauss(5, 1), rng.gauss(0, 0.1)]) for i in range(200)]
    rows += [(200 + i, rows[0][1]) for i in range(100)] + [(None, [1.0, 2.0, 3.0]), (1, rows[1][1])]
    odd = [(900, None), (901, [1.0, None, 2.0]), (902, [nan, 1.0, 1.0]), (903, [inf, 0.0, 0.0]), (904, [-inf, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 7) for i, v in rows + odd + [(905, []), (906, [1.0])]], "vec_id long, embedding array<double>, x string, n int")
    check(pw.whiten(df).collect(), rows + odd, 3)


def test_large_entries_are_exact(spark):
    rows = [(i, [float(2**45 + i * 3), -1e9 * i, float(i * i)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = pw.whiten(df, components=2).collect()
    n, ids, deviation, _, _ = brute(rows, 2)
    assert {(r.vec_id, r.deviation) for r in got} == {(i, d if d < 2**63 else None) for i, d in zip(ids, deviation)}
    assert got[0].identity_error < 1e-6
    assert pw.whiten(spark.createDataFrame([(1, [1e300, 1.0]), (2, [0.0, 2.0])], "vec_id long, embedding array<double>")).count() == 2


def test_ties_rank_and_empty(spark):
    rows = [(k, [float(s * (k == j)) for j in range(4)]) for k in range(3) for s in (1, -1)]  # three equal roots, one of 0
    got = pw.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 18 and {round(r.explained, 12) for r in got} == {round(1 / 3, 12)} and got[0].identity_error < 1e-12
    schema = "vec_id long, embedding array<float>"
    assert pw.whiten(spark.createDataFrame([], schema)).collect() == []
    assert pw.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []
    same = pw.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], schema))
    assert same.collect() == [] and same.columns[:2] == ["vec_id", "component"]
