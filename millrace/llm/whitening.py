"""Whitening of embeddings by an exact characteristic polynomial.

Entries become whole numbers, so the scatter matrix of the distinct vectors is exact. Its
characteristic polynomial is found modulo many primes, each by a Hessenberg reduction in
a task of its own, and put together by Chinese remaindering. A symmetric matrix has real
roots only, for which the sign changes of the shifted polynomial count the roots above a point
exactly, so bisection isolates them, equal ones included, and refines them to ``BITS`` bits.
Inverse iteration at that precision, again a task a root, gives the null space of the matrix
less the root: the components, as exact as a double can be.

The matrix, the polynomial and the components are bounded by the number of dimensions
(``MAX_DIMENSIONS``), whatever the number of rows. Vectors are compared, counted and added up
by Spark, and never collected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.arrow import extended, slices, without
from millrace.session import stage

MAX_DIMENSIONS = 512
#: Bits to which roots are refined, and digits of the arithmetic that uses them.
BITS, DIGITS = 256, 120
#: Primes are below this, so that products of two remainders fit 63 bits.
BELOW = 1 << 31
#: Sizes of scaled entries, about the shift, that are taken.
LARGEST = 1 << 50
ROUNDS = 4


@dataclass
class Whitening:
    """What a fit gives. ``axes`` has a row per component, divided by the root of its eigenvalue.

    ``sums`` are those of the ``n`` distinct vectors of whole numbers less the shift.
    """

    n: int
    sums: list[int]
    eigenvalues: list[float]
    explained: list[float]
    axes: np.ndarray
    identity_error: float


def clean(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has finite entries only."""
    infinite = F.lit(float("inf"))
    return df.filter(
        F.col(f"`{vector}`").isNotNull()
        & F.forall(f"`{vector}`", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < infinite))
    )


def whole(vector: str, scale: int) -> Column:
    """Entries as doubles times ``scale``, rounded down. One beyond 2**50 fails the job."""

    def number(entry: Column) -> Column:
        scaled = entry.cast("double") * scale
        failure = F.raise_error(F.lit(f"an entry times {scale} is beyond 2**50")).cast("bigint")
        return F.when(F.abs(scaled) < float(LARGEST), F.floor(scaled)).otherwise(failure)

    return F.transform(f"`{vector}`", number)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column of bigint."""
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _products(rows: np.ndarray) -> np.ndarray:
    """Exact sums of products of columns, as Python integers."""
    size = len(rows[0])
    total = np.zeros((size, size), object)
    for at in range(0, len(rows), 1024):
        part = rows[at : at + 1024]
        if np.abs(part).max(initial=0) < 1 << 21:  # doubles hold every sum exactly
            flat = part.astype(np.float64)
            total += (flat.T @ flat).astype(np.int64).astype(object)
        else:
            high, low = part >> 26, part & ((1 << 26) - 1)
            mixed = (high.T @ low).astype(object)
            squares = (high.T @ high).astype(object) * (1 << 52) + (low.T @ low).astype(object)
            total += squares + (mixed + mixed.T) * (1 << 26)
    return total


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's vectors: their number at (-1, -1), sums at (i, -1), sums of products at (i, j), j <= i."""
    n, sums, products = 0, 0, 0
    for batch in batches:
        if batch.num_rows:
            rows = _matrix(batch.column("x"))
            n += len(rows)
            sums = sums + rows.sum(axis=0).astype(object)
            products = products + _products(rows)
    if n:
        i, j = np.tril_indices(len(sums))
        places = np.arange(len(sums))
        values = [n, *sums.tolist(), *products[i, j].tolist()]
        yield pa.record_batch(
            {
                "i": pa.array(np.concatenate([[-1], places, i]).astype(np.int32)),
                "j": pa.array(np.concatenate([[-1], np.full(len(sums), -1), j]).astype(np.int32)),
                "value": pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0)),
            }
        )


def moments(x: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """Number, sums and scatter matrix n * sum(x x') - S S' of the vectors in column ``x``, exact."""
    parts = x.select("x").mapInArrow(_moments, "i int, j int, value decimal(38,0)")
    added = parts.groupBy("i", "j").agg(F.sum("value").alias("value"))
    found = {(r["i"], r["j"]): int(r["value"]) for r in added.collect()}  # bounded by the dimensions
    n = found.pop((-1, -1), 0)
    size = sum(1 for _, j in found if j == -1)
    sums = [found[i, -1] for i in range(size)]

    def scatter(i: int, j: int) -> int:
        return n * found[max(i, j), min(i, j)] - sums[i] * sums[j]

    return n, sums, [[scatter(i, j) for j in range(size)] for i in range(size)]


def primes(count: int) -> list[int]:
    """The greatest primes below ``BELOW``."""

    def is_prime(p: int) -> bool:
        d = (p - 1) >> (shift := ((p - 1) & (1 - p)).bit_length() - 1)
        for base in (2, 3, 5, 7):  # enough below 3,215,031,751
            x = pow(base, d, p)
            if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(shift - 1)):
                return False
        return True

    found, p = [], BELOW - 1
    while len(found) < count:
        if is_prime(p):
            found.append(p)
        p -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients, lowest first, of the characteristic polynomial modulo a prime."""
    a, size = matrix.copy(), len(matrix)
    for k in range(size - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        a[[pivot, k + 1]] = a[[k + 1, pivot]]
        a[:, [pivot, k + 1]] = a[:, [k + 1, pivot]]
        factors = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :, k:] = (a[k + 2 :, k:] - factors[:, None] * a[k + 1, k:] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * factors % p).sum(axis=1)) % p
    # Polynomials of the leading minors, one from those before it.
    minors = np.zeros((size + 1, size + 1), np.int64)
    minors[0, 0] = 1
    for k in range(size):
        weights, product = [int(a[k, k])], 1
        for i in range(k - 1, -1, -1):
            product = product * int(a[i + 1, i]) % p
            weights.append(int(a[i, k]) * product % p)
        own = np.array(weights[::-1], np.int64)
        following = -(minors[: k + 1] * own[:, None] % p).sum(axis=0) % p
        following[1:] += minors[k, :-1]
        minors[k + 1] = following % p
    return minors[size].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients, lowest first, of det(t - matrix) of a positive semidefinite matrix of integers.

    The k-th elementary symmetric function of the eigenvalues is at most C(d, k) (trace / d) ** k,
    which says how many primes it takes.
    """
    size, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max(math.comb(size, k) * trace**k // size**k for k in range(size + 1)) + 1
    taken = primes((2 * bound).bit_length() // 30 + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = np.array(matrix, object)
        for batch in batches:
            for p in batch.column("p").to_pylist():
                found = polynomial_modulo((entries % p).astype(np.int64), p)
                yield pa.record_batch({"p": pa.array([p]), "c": pa.array([found], pa.list_(pa.int64()))})

    rows = spark.createDataFrame([(p,) for p in taken], "p bigint")
    residues = rows.mapInArrow(run, "p bigint, c array<bigint>").collect()
    whole_product = math.prod(taken)
    total = [0] * (size + 1)
    for row in residues:
        rest = whole_product // row["p"]
        unit = rest * pow(rest, -1, row["p"])
        total = [t + unit * c for t, c in zip(total, row["c"], strict=True)]
    total = [t % whole_product for t in total]
    return [t - whole_product if 2 * t > whole_product else t for t in total]


def _above(polynomial: list[int], m: int, s: int) -> int:
    """Roots above m / 2**s, repeated ones as often; exact as all roots are real."""
    degree = len(polynomial) - 1
    c = [value << (s * (degree - k)) for k, value in enumerate(polynomial)]
    for k in range(degree):
        for i in range(degree - 1, k - 1, -1):
            c[i] += m * c[i + 1]
    signs = [value > 0 for value in c if value]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(polynomial: list[int], m: int, s: int) -> int:
    """Sign at m / 2**s."""
    value = 0
    for k, c in enumerate(reversed(polynomial)):
        value = value * m + (c << (s * k))
    return (value > 0) - (value < 0)


def greatest_roots(polynomial: list[int], wanted: int) -> list[tuple[int, int, int]]:
    """(m, s, how many) of the roots m / 2**s in falling order, ``wanted`` in all or as many as are not 0.

    The polynomial is monic with real roots of 0 and more. Roots that ``BITS`` bits cannot tell
    apart are one with their number.
    """
    zeros = next(k for k, c in enumerate(polynomial) if c)
    polynomial = polynomial[zeros:]
    degree = len(polynomial) - 1
    if not degree:
        return []
    found: list[tuple[int, int, int]] = []
    top = 1 << (-polynomial[-2]).bit_length()  # the sum of the roots is below
    waiting = [(0, top, 0, degree, 0)]
    while waiting:
        low, high, s, above_low, above_high = waiting.pop()
        if above_high >= wanted or above_low == above_high:
            continue
        close = (high - low) << BITS <= low
        if close:
            found.append((low + high, s + 1, min(above_low, wanted) - above_high))
        elif above_low - above_high == 1:
            m, s = _refined(polynomial, low, high, s, above_high)
            found.append((m, s, 1))
        else:
            if (low + high) % 2:
                low, high, s = 2 * low, 2 * high, s + 1
            middle = (low + high) // 2
            above = _above(polynomial, middle, s)
            waiting += [(low, middle, s, above_low, above), (middle, high, s, above, above_high)]
    return found


def _refined(polynomial: list[int], low: int, high: int, s: int, above: int) -> tuple[int, int]:
    """The one root in (low, high] / 2**s, to ``BITS`` bits; the sign changes there only."""
    over = -1 if above % 2 else 1
    while (high - low) << BITS > low:
        if (low + high) % 2:
            low, high, s = 2 * low, 2 * high, s + 1
        middle = (low + high) // 2
        sign = _sign(polynomial, middle, s)
        if not sign:
            return middle, s
        if sign == over:
            high = middle
        else:
            low = middle
    return low + high, s + 1


def null_space(matrix: list[list[int]], root: Decimal, count: int) -> np.ndarray:
    """``count`` orthogonal unit vectors, as decimals, that the matrix less the root takes to 0."""
    size = len(matrix)
    a = np.array([[Decimal(v) for v in row] for row in matrix], object)
    a[np.arange(size), np.arange(size)] -= root
    tiny = max(abs(root), Decimal(1)).scaleb(-DIGITS)
    order = np.arange(size)
    for k in range(size):
        pivot = k + int(np.argmax(np.abs(a[k:, k])))
        a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        a[k + 1 :, k] /= a[k, k]
        a[k + 1 :, k + 1 :] -= a[k + 1 :, k, None] * a[k, k + 1 :]
    start = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 30, (count, size))
    vectors = np.array([[Decimal(int(v)) for v in row] for row in start], object)
    for _ in range(ROUNDS):
        for row in range(count):
            x = vectors[row][order]
            for k in range(size):
                x[k + 1 :] -= a[k + 1 :, k] * x[k]
            for k in range(size - 1, -1, -1):
                x[k] /= a[k, k]
                x[:k] -= a[:k, k] * x[k]
            x /= abs(x).max()
            for _ in range(2):  # once more for what rounding left
                for other in vectors[:row]:
                    x -= other * (other @ x)
                x /= (x @ x).sqrt()
            vectors[row] = x
    return vectors


def components(
    spark: SparkSession, matrix: list[list[int]], n: int, wanted: int
) -> tuple[list[Decimal], np.ndarray]:
    """Eigenvalues of the scatter matrix in falling order, and unit eigenvectors over their
    standard deviation (root of eigenvalue / n**2), as doubles."""
    roots = greatest_roots(characteristic_polynomial(spark, matrix), wanted)
    if not roots:
        return [], np.empty((0, len(matrix)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with localcontext() as context:
                    context.prec = DIGITS
                    root = Decimal(row["root"])
                    vectors = null_space(matrix, root, row["many"])
                    for k, vector in enumerate(vectors):
                        # Either sign will do: the entry of greatest size is positive.
                        sign = 1 if vector[int(np.argmax(np.abs(vector)))] > 0 else -1
                        axis = [float(sign * n * v / root.sqrt()) for v in vector]
                        yield pa.record_batch({"place": pa.array([row["place"] + k]), "axis": pa.array([axis])})

    rows, values = [], []
    with localcontext() as context:
        context.prec = DIGITS
        for m, s, many in roots:
            root = Decimal(m) / (1 << s)
            rows.append((len(values), many, str(root)))
            values += [root] * many
    tasks = spark.createDataFrame(rows, "place bigint, many int, root string")
    solved = tasks.mapInArrow(run, "place bigint, axis array<double>").collect()
    return values, np.array([r["axis"] for r in sorted(solved, key=lambda r: r["place"])])


def identity_error(axes: np.ndarray, matrix: list[list[int]], n: int) -> float:
    """Largest entry of axes * covariance * axes' less the identity, of the doubles in use."""
    with localcontext() as context:
        context.prec = DIGITS
        exact = np.array([[Decimal(v) for v in row] for row in axes.tolist()], object)
        scatter = np.array([[Decimal(v) for v in row] for row in matrix], object)
        covariance = exact @ scatter @ exact.T / (n * n)
        covariance[np.diag_indices(len(exact))] -= 1
        return float(np.abs(covariance).max())


def fit(df: DataFrame, vector: str = "embedding", scale: int = 64, wanted: int = 16) -> Whitening:
    """Whitening of the distinct vectors of whole numbers that the clean rows of ``df`` give.

    Rows without a vector, or with null or non-finite entries, do not count. Vectors have one
    length, at most ``MAX_DIMENSIONS``; others raise ValueError. Components are those of an eigenvalue above 0,
    ``wanted`` at most: none for an empty table or for one distinct vector. Equal eigenvalues
    have orthogonal components that span their space.
    """
    spark = df.sparkSession
    distinct = clean(df, vector).select(whole(vector, scale).alias("x")).groupBy("x").agg(F.lit(1).alias("one"))
    distinct = stage(distinct.select("x"), "distinct-vectors")
    sizes = distinct.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if sizes["least"] != sizes["most"] or (sizes["most"] or 0) > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {sizes['least']} to {sizes['most']} entries; at most {MAX_DIMENSIONS}, all alike")
    if not sizes["most"]:
        return Whitening(distinct.count(), [], [], [], np.empty((0, 0)), 0.0)
    n, sums, matrix = moments(distinct)
    values, axes = components(spark, matrix, n, wanted)
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    return Whitening(
        n,
        sums,
        [float(v) / n**2 for v in values],
        [float(v / trace) for v in values],
        axes,
        identity_error(axes, matrix, n) if values else 0.0,
    )


COLUMNS = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, model: Whitening, vector: str = "embedding", scale: int = 64) -> DataFrame:
    """A row per clean row of ``df`` and component: the other columns of ``df`` and ``COLUMNS``.

    ``deviation`` is the sum of (n * x - S) ** 2; one that does not fit a bigint fails the job.
    Repeated rows stay repeated; columns of ``df`` named as new ones are replaced.
    """
    kept = without(clean(df, vector).withColumn("_x", whole(vector, scale)), *StructType.fromDDL(COLUMNS).names)
    rest = without(kept, vector, "_x")
    schema = extended(rest, COLUMNS)
    names, many = rest.columns, len(model.axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if not batch.num_rows or not many:
                continue
            x = _matrix(batch.column("_x"))
            centred, deviation = _centred(x, model)
            whitened = (centred.astype(np.float64) / model.n) @ model.axes.T
            size = len(x)
            at = pa.array(np.repeat(np.arange(size), many))
            columns = [pc.take(batch.column(name), at) for name in names]
            columns += [
                pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), size)),
                pa.array(np.full(size * many, model.n, np.int64)),
                pc.take(pa.array(deviation, pa.int64()), at),
                pa.array(whitened.ravel()),
                pa.array(np.tile(model.explained, size)),
                pa.array(np.full(size * many, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.select(*[F.col(f"`{c}`") for c in names], "_x").mapInArrow(run, schema)


def _centred(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, list[int]]:
    """n * x - S and the sum of its squares for each row, exact."""
    size = int(np.abs(x).max(initial=0)) * model.n + max(abs(s) for s in model.sums)
    kind = np.int64 if size * size * x.shape[1] < 1 << 63 else object
    centred = x.astype(kind) * model.n - np.array(model.sums, kind)
    return centred, (centred * centred).sum(axis=1).tolist()
