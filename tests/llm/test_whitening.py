"""Whitening against exact polynomials, known roots and numpy's eigenvectors."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import whitening
from millrace.llm.arrow import SCHEMAS
from millrace.llm.queries import QUERIES
from millrace.session import scratch_path

QUERY = QUERIES["op11_exact_whitening"]


def leverrier(matrix):
    """Characteristic polynomial by exact traces of powers, lowest coefficient first."""
    size = len(matrix)
    m = [[Fraction(0)] * size for _ in range(size)]
    c = [Fraction(0)] * size + [Fraction(1)]
    for k in range(1, size + 1):
        m = [
            [sum(matrix[i][x] * m[x][j] for x in range(size)) + (c[size - k + 1] if i == j else 0) for j in range(size)]
            for i in range(size)
        ]
        trace = sum(matrix[i][x] * m[x][i] for i in range(size) for x in range(size))
        c[size - k] = -trace / k
    return [int(v) for v in c]


def product(roots):
    c = [1]
    for r in roots:
        c = [(c[k - 1] if k else 0) - r * (c[k] if k < len(c) else 0) for k in range(len(c) + 1)]
    return c


def scatter(rows):
    rows = [list(map(int, r)) for r in rows]
    n, size = len(rows), len(rows[0])
    s = [sum(r[i] for r in rows) for i in range(size)]
    return [[n * sum(r[i] * r[j] for r in rows) - s[i] * s[j] for j in range(size)] for i in range(size)]


RNG = np.random.default_rng(5)


@pytest.mark.parametrize("rows", [
    RNG.integers(-30, 30, (40, 7)), RNG.integers(-3, 3, (4, 6)), np.eye(5, dtype=int) * 3,
    np.diag([1, 2, 3, 4]), np.zeros((2, 3), int), [[5]], RNG.integers(-(2**49), 2**49, (9, 3)),
], ids=["full", "low rank", "equal", "diagonal", "null", "one", "large"])
def test_polynomial_is_exact(spark, rows):
    matrix = scatter(rows)
    assert whitening.characteristic_polynomial(spark, matrix) == leverrier(matrix)


@pytest.mark.parametrize("roots", [
    [1, 2, 3], [7, 7, 7, 2], [0, 0, 5], [10**20, 10**20 + 1, 3, 3], [1], [0, 0], [6, 6, 5, 5, 5, 4], [2**40, 2**39, 1],
])
def test_roots_are_isolated_with_their_number(roots):
    wanted = sorted((r for r in roots if r), reverse=True)
    for most in (1, 2, 16):
        found = [Fraction(m, 1 << s) for m, s, many in whitening.greatest_roots(product(roots), most) for _ in range(many)]
        assert len(found) == min(most, len(wanted))
        assert all(abs(f - w) <= w / Fraction(2) ** 250 for f, w in zip(found, wanted, strict=False))


def test_irrational_roots():
    # t**2 - 6 t + 1: 3 + sqrt(8) and 3 - sqrt(8).
    for (m, s, many), sign in zip(whitening.greatest_roots([1, -6, 1], 2), (1, -1), strict=True):
        t = Fraction(m, 1 << s)
        assert many == 1 and abs((t - 3) ** 2 - 8) < Fraction(1, 1 << 240) and (t > 3) == (sign > 0)


def stored(spark, rows):
    root = scratch_path(spark, "test-embeddings")
    schema = SCHEMAS["embeddings"] + ", n bigint, Component string, _x int"
    spark.createDataFrame([(*r, 1, 5, "c", 3) for r in rows], schema).repartition(3).write.parquet(
        f"{root}/embeddings.parquet"
    )
    return root


def judge(rows, result, wanted):
    """Compare with exact sums, numpy's eigenvalues, and axes up to sign or within an eigenspace."""
    clean = [(k, v) for k, v in rows if v is not None and all(e is not None and np.isfinite(e) for e in v)]
    x = np.array([[int(np.floor(64 * np.float64(np.float32(e)))) + 1000000 for e in v] for _, v in clean], object)
    distinct = np.array(sorted({tuple(r) for r in x}), object)
    n, sums = len(distinct), distinct.sum(axis=0)
    covariance = np.cov((distinct - sums // n).astype(float).T, bias=True).reshape(len(sums), -1)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values > 1e-9 * max(values[0], 1e-300)).sum())
    count = min(wanted, rank)
    found = result.collect()
    assert len(found) == len(clean) * count
    assert sorted({r.component for r in found}) == list(range(1, count + 1))
    deviations = sorted((k, int(((n * r - sums) ** 2).sum())) for (k, _), r in zip(clean, x, strict=True))
    assert sorted((r.vec_id, r.deviation) for r in found if r.component == 1) == deviations
    for r in found:
        assert r.n == n and r.identity_error <= 1e-9
        assert abs(r.explained - values[r.component - 1] / values.sum()) <= 1e-6 * r.explained
    return clean, x, distinct, n, sums, values, vectors, found


def embeddings(n, size):
    rows = [(k, [float(v) for v in RNG.normal(0, 0.1 * (1 + k % 3), size)]) for k in range(n)]
    rows += [(k + 10_000, v) for k, v in rows[: n // 2]] + [(0, rows[0][1])] * 2
    nan, infinite = float("nan"), float("inf")
    bad = [None, [None, *[0.0] * (size - 1)], [nan] + [0.0] * (size - 1), [infinite] + [0.0] * (size - 1)]
    return rows + [(20_000 + k, v) for k, v in enumerate(bad)] + [(30_000, [-infinite] * size)]


@pytest.mark.parametrize("n, size", [(300, 20), (60, 3), (10, 12)])
def test_query_equals_numpy(spark, n, size):
    rows = embeddings(n, size)
    _, x, _, n, sums, values, vectors, found = judge(rows, QUERY.run(spark, stored(spark, rows)), 16)
    first = (x - np.array(sums / n)).astype(float) @ vectors / np.sqrt(np.maximum(values, 1e-300))
    by_row = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.component), r.whitened)
    ids = [k for k, v in rows if v is not None and all(e is not None and np.isfinite(e) for e in v)]
    for c in range(max(r.component for r in found)):
        own = np.array([by_row[k, c + 1] for k in ids])
        sign = np.sign(own @ first[:, c])
        assert np.abs(own * sign - first[:, c]).max() < 1e-6


def test_equal_eigenvalues_have_orthogonal_components(spark):
    # Plus and minus each axis: all four eigenvalues are equal.
    rows = [(2 * i + (s > 0), [s * (j == i) for j in range(4)]) for i in range(4) for s in (1.0, -1.0)]
    _, x, distinct, n, sums, _, _, found = judge(rows, QUERY.run(spark, stored(spark, rows)), 16)
    whitened = {}
    for r in found:
        whitened.setdefault(r.vec_id, {})[r.component] = r.whitened
    z = np.array([[whitened[k][c] for c in range(1, 5)] for k in range(8)])
    assert np.abs(z.T @ z / n - np.eye(4)).max() < 1e-12 and np.abs(z.sum(axis=0)).max() < 1e-12


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, []), (2, [])]])
def test_without_variance_there_are_no_components(spark, rows):
    result = QUERY.run(spark, stored(spark, rows))
    assert result.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ] and result.collect() == []


def test_lengths_and_sizes_are_checked(spark):
    with pytest.raises(ValueError, match="1 to 2 entries"):
        QUERY.run(spark, stored(spark, [(1, [1.0]), (2, [1.0, 2.0])]))
    with pytest.raises(Exception, match="beyond"):
        QUERY.run(spark, stored(spark, [(1, [1e30, 1.0])]))


def test_other_columns_are_kept_and_clashing_ones_replaced(spark):
    rows = embeddings(20, 3)
    table = spark.read.parquet(f"{stored(spark, rows)}/embeddings.parquet")
    made = whitening.whiten(table, whitening.fit(table, wanted=2))
    assert made.columns[:2] == ["vec_id", "label"] and len(set(map(str.lower, made.columns))) == len(made.columns)
    assert {r.label for r in made.collect()} == {1}


def test_whole_table_of_the_fixtures(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    judge(rows, QUERY.run(spark, small), 16)
    assert QUERY.run(spark, small).agg(F.max("identity_error")).first()[0] < 1e-12
