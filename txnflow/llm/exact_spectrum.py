"""Eigenvalues and eigenvectors of a symmetric integer matrix from its exact characteristic polynomial.

The matrix is d x d whatever the corpus, so only numbers of its dimension are
handled here: the polynomial modulo many primes and the eigenvectors are Spark
tasks, one prime or root each; the driver combines them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

Matrix = list[list[int]]

#: Fractional bits of a root, and of the numbers in the null-space iteration.
ROOT_BITS = 128
WORK_BITS = 256


def primes_below(limit: int, count: int) -> list[int]:
    """The largest ``count`` primes below ``limit`` (at most 2^31)."""
    out, n = [], limit - 1
    while len(out) < count and n > 2:
        if n % 2 and _is_prime(n):
            out.append(n)
        n -= 1
    return out


def _is_prime(n: int) -> bool:
    """Exact below 3,215,031,751 with these four bases (Miller and Rabin)."""
    if any(n % p == 0 for p in (3, 5, 7, 11, 13)):
        return n in (3, 5, 7, 11, 13)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def polynomial_mod(matrix: Matrix, p: int) -> np.ndarray:
    """Coefficients of det(xI - A) modulo ``p``, highest first, by reduction to Hessenberg form."""
    d = len(matrix)
    h = np.array([[v % p for v in row] for row in matrix], dtype=np.int64).reshape(d, d)
    for k in range(d - 2):
        at = np.flatnonzero(h[k + 1 :, k])
        if not len(at):
            continue
        pivot = k + 1 + int(at[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(axis=1)) % p
    # polynomials of the leading blocks, lowest coefficient first
    polys = np.zeros((d + 1, d + 1), dtype=np.int64)
    polys[0, 0] = 1
    for k in range(d):
        new = np.zeros(d + 1, dtype=np.int64)
        new[1:] = polys[k, :-1]
        new -= h[k, k] * polys[k] % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(h[i + 1, i]) % p
            if not below:
                break
            new -= h[i, k] * below % p * polys[i] % p
        polys[k + 1] = new % p
    return polys[d, ::-1].copy()


def characteristic_polynomial(spark: SparkSession, matrix: Matrix) -> list[int]:
    """Exact coefficients of det(xI - A) of a positive semidefinite matrix, highest first.

    Enough primes to pass twice the bound binomial(d, k) * (trace / d)^k of
    the k-th coefficient; each prime is a task.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # the exact bound as an integer, rounded up
    bound = max(math.comb(d, k) * (trace**k // d**k + 1) for k in range(d + 1))
    primes = primes_below(1 << 31, bound.bit_length() // 30 + 2)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch.column("p").to_pylist()
            rows = [polynomial_mod(matrix, p).tolist() for p in ps]
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array(rows, pa.list_(pa.int64()))], ["p", "c"])

    frame = spark.createDataFrame([(p,) for p in primes], "p long")
    parts = frame.repartition(min(len(primes), 64)).mapInArrow(task, "p long, c array<long>").collect()
    whole = math.prod(primes)
    out = [0] * (d + 1)
    for p, residues in parts:
        rest = whole // p
        weight = rest * pow(rest, -1, p)
        out = [c + r * weight for c, r in zip(out, residues)]
    out = [c % whole for c in out]
    out = [c - whole if 2 * c > whole else c for c in out]
    if d and out[1] != -trace:
        raise ArithmeticError("the polynomial does not fit the trace")
    return out


def _above(coefficients: list[int], a: int) -> int:
    """How many roots are greater than ``a``, with multiplicity.

    Sign changes of the polynomial shifted by ``a``: exact, not a bound, where
    all roots are real.
    """
    c = list(coefficients)
    n = len(c)
    if a:
        for end in range(n - 1, 0, -1):
            for i in range(1, end + 1):
                c[i] += a * c[i - 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _value(coefficients: list[int], a: int) -> int:
    v = 0
    for c in coefficients:
        v = v * a + c
    return v


def largest_roots(polynomial: list[int], count: int, bits: int = ROOT_BITS) -> list[tuple[int, int]]:
    """(root times 2^bits, multiplicity) of the largest positive roots, falling, of at least ``count`` roots if there are.

    Intervals are halved until each holds one root or is one unit wide; a
    single root is then refined by the sign of the polynomial.
    """
    degree = len(polynomial) - 1
    scaled = [c << (bits * k) for k, c in enumerate(polynomial)]
    while len(scaled) > 1 and scaled[-1] == 0:
        scaled.pop()  # roots at zero
    if len(scaled) < 2 or not degree:
        return []
    top = (-polynomial[1] << bits) + 1  # the trace
    out: list[tuple[int, int]] = []
    stack = [(0, top, len(scaled) - 1, 0)]
    while stack and sum(m for _, m in out) < count:
        low, high, above_low, above_high = stack.pop()
        inside = above_low - above_high
        if not inside:
            continue
        if high - low <= 1:
            out.append((high, inside))
        elif inside == 1:
            out.append((_refine(scaled, low, high), 1))
        else:
            middle = (low + high) // 2
            above = _above(scaled, middle)
            stack.append((low, middle, above_low, above))
            stack.append((middle, high, above, above_high))
    return out


def _refine(scaled: list[int], low: int, high: int) -> int:
    """The one root in (low, high], rounded up to a whole number."""
    right = _value(scaled, high)
    if right == 0:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        v = _value(scaled, middle)
        if v == 0:
            return middle
        # a value of the other sign, with the root above, moves the lower end
        if (v > 0) == (right > 0):
            high = middle
        else:
            low = middle
    return high


def _factored(matrix: Matrix, root: int) -> tuple[Matrix, list[int]]:
    """LU of (A - root) in fixed point, rows permuted; multipliers stand below the diagonal."""
    d = len(matrix)
    a = [[v << ROOT_BITS for v in row] for row in matrix]
    for i in range(d):
        a[i][i] -= root
    order = list(range(d))
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(a[i][k]))
        a[k], a[best] = a[best], a[k]
        order[k], order[best] = order[best], order[k]
        pivot, row = a[k][k] or 1, a[k][k + 1 :]
        a[k][k] = pivot
        for i in range(k + 1, d):
            f = (a[i][k] << WORK_BITS) // pivot
            a[i][k] = f
            if f:
                a[i][k + 1 :] = [x - (f * y >> WORK_BITS) for x, y in zip(a[i][k + 1 :], row)]
    return a, order


def _solve(a: Matrix, order: list[int], b: list[int]) -> list[int]:
    d = len(a)
    y = [b[i] for i in order]
    for i in range(d):
        y[i] -= sum(f * v for f, v in zip(a[i][:i], y)) >> WORK_BITS
    x = [0] * d
    for i in range(d - 1, -1, -1):
        x[i] = ((y[i] << ROOT_BITS) - sum(u * v for u, v in zip(a[i][i + 1 :], x[i + 1 :]))) // a[i][i]
    return x


def _unit(v: list[int]) -> list[int]:
    """The vector scaled to length 1, in fixed point."""
    norm = math.isqrt(sum(x * x for x in v)) or 1
    return [(x << WORK_BITS) // norm for x in v]


def null_vectors(matrix: Matrix, root: int, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors of the null space of (A - root), by inverse iteration in fixed point.

    The entry of largest size is positive.
    """
    d = len(matrix)
    a, order = _factored(matrix, root)
    found: list[list[int]] = []
    state = 1
    for _ in range(count):
        v = []
        for _ in range(d):
            state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
            v.append((state << (WORK_BITS - 64)) - (1 << (WORK_BITS - 1)))
        for _ in range(3):
            v = _unit(_solve(a, order, v))
            for u in found:
                dot = sum(x * y for x, y in zip(u, v)) >> WORK_BITS
                v = [y - (dot * x >> WORK_BITS) for x, y in zip(u, v)]
            v = _unit(v)
        found.append(v)
    out = []
    for v in found:
        sign = 1 if max(v, key=abs) > 0 else -1
        out.append([sign * x / (1 << WORK_BITS) for x in v])
    return out


def components(spark: SparkSession, matrix: Matrix, roots: list[tuple[int, int]], count: int) -> list[tuple[int, list[float]]]:
    """(root times 2^ROOT_BITS, unit eigenvector) of the ``count`` largest roots; each distinct root is a task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, root, many in zip(*(batch.column(c).to_pylist() for c in ("first", "root", "many"))):
                vectors = null_vectors(matrix, int(root), many)
                ranks = pa.array(range(first, first + many), pa.int32())
                yield pa.RecordBatch.from_arrays([ranks, pa.array(vectors, pa.list_(pa.float64()))], ["rank", "v"])

    given, rank = [], 0
    for root, many in roots:
        many = min(many, count - rank)
        if many > 0:
            given.append((rank, str(root), many))
            rank += many
    if not given:
        return []
    frame = spark.createDataFrame(given, "first int, root string, many int").repartition(len(given))
    vectors = dict(map(tuple, frame.mapInArrow(task, "rank int, v array<double>").collect()))
    of_rank = {first + i: int(root) for first, root, many in given for i in range(many)}
    return [(of_rank[r], list(vectors[r])) for r in range(rank)]
