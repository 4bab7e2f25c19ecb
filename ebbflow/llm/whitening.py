"""Operator 12: embedding whitening by an exact characteristic polynomial.

Everything before the last division is integer arithmetic. Tasks add up the
rows' integer vectors, then their products about an integer centre, in two
levels; the driver gets one number for each pair of dimensions. From these follows the scatter
``C = n * sum(y y') - s s'`` (y: centred rows, s: their sum), an exact integer
matrix, n^2 times the covariance. Its characteristic polynomial is computed
modulo enough primes, each reduced to Hessenberg form in a Spark task, and put
together by Chinese remaindering; Maclaurin's inequality bounds its
coefficients. All roots are real and none is negative, so the number of roots
above a point is exactly the number of sign changes of the polynomial shifted
there: roots are isolated by bisection with that count and refined to
:data:`ROOT_BITS` bits, repeated roots as one with its multiplicity. The
eigenvectors come from inverse iteration on ``C - root`` in fixed-point
integers (a block of as many vectors as the root is repeated), one task for
each root. Whitened values are products of the exact ``n x - S`` with these
vectors over the root's square root, as ``n x - S`` is n times the centred row
and the root n^2 times the eigenvalue.

Vectors that are null or hold a null, NaN or infinite entry are dropped; so are
those of another size than the most frequent one (ties: the larger), and empty
ones. Entries are cut to 2^61 on either side before anything is computed.
Components whose eigenvalue is exactly zero cannot be whitened and are not
returned, so fewer than eight may come; equal or single rows give none at all,
as does an empty table. Repeated rows, and rows with a null id, are rows like
any other: each is in the fit list and is returned. A deviation beyond a long is
null, its exact digits are in ``deviation_digits``. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits to which a root is known beyond its leading one; of the fixed point.
ROOT_BITS, FIXED_BITS = 160, 320
#: Largest prime plus one: products of two residues fit a long.
PRIME_TOP = 1 << 31
#: Sums travel in digits of so many bits, so that each adds up within a long.
DIGIT_BITS, DIGITS = 40, 6
EDGE = float(1 << 61)


# -- the fit list -----------------------------------------------------------

def prepare(df: DataFrame, vec_id: str, vector: str, scale: int, offset: int) -> DataFrame:
    """``id, x`` of the rows that are not dropped for their entries."""
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    cut = lambda c: F.greatest(F.lit(-EDGE), F.least(F.lit(EDGE), F.lit(float(scale)) * c))
    return (df.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("x"))
            .filter(F.col("x").isNotNull() & (F.size("x") > 0)).filter(finite)
            .select("id", F.transform("x", lambda c: F.floor(cut(c)) + F.lit(offset)).alias("x")))


def _digits(values: np.ndarray) -> np.ndarray:
    """Python's integers as rows of digits, the last with the sign."""
    out, rest = np.empty((len(values), DIGITS), np.int64), values
    for i in range(DIGITS - 1):
        out[:, i] = rest & ((1 << DIGIT_BITS) - 1)
        rest = rest >> DIGIT_BITS
    out[:, -1] = rest
    return out


def _summed(df: DataFrame, task, size: int) -> list[int]:
    """Exact sums of the ``size`` integers that ``task`` makes of each batch's
    matrix. A partition sends one packed row; these are added up in groups, and
    the groups' in one task, so the driver gets ``size`` numbers."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                got = task(_matrix(batch.column("x")))
                held = got if held is None else held + got
        if held is not None:
            yield row(TaskContext.get().partitionId(), _digits(held))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, DIGITS), np.int64)
        for batch in batches:
            for packed in batch.column("digits"):
                total += np.frombuffer(packed.as_buffer(), np.int64).reshape(size, DIGITS)
        yield row(0, total)

    def row(part: int, digits: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([digits.tobytes()], pa.binary())], ["part", "digits"])

    schema = "part int, digits binary"
    groups = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = df.mapInArrow(run, schema).repartition(groups, "part").mapInArrow(add, schema).repartition(1).mapInArrow(add, schema)
    got = sums.first()
    digits = np.frombuffer(got["digits"], np.int64).reshape(size, DIGITS) if got else np.zeros((size, DIGITS), np.int64)
    return [sum(int(v) << (DIGIT_BITS * i) for i, v in enumerate(d)) for d in digits]


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def exact_gram(y: np.ndarray) -> np.ndarray:
    """``y' y`` of an integer matrix, as Python's integers."""
    most = max(abs(int(y.max())), abs(int(y.min()))) if y.size else 0
    if most * most * len(y) < 2 ** 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    if most * most * len(y) < 2 ** 63:
        return (y.T @ y).astype(object)
    o = y.astype(object)
    return o.T @ o


@dataclass(frozen=True)
class Fit:
    n: int
    sums: list[int]            # of each dimension
    scatter: list[list[int]]   # n^2 times the covariance


def fit(rows: DataFrame, dim: int) -> Fit:
    """Exact sums and scatter of the fit list."""
    def first(x: np.ndarray) -> np.ndarray:
        high, low = (x >> 31).sum(0), (x & ((1 << 31) - 1)).sum(0)  # a batch's sums of halves fit a long
        return np.append((high.astype(object) << 31) + low.astype(object), len(x))

    *sums, n = _summed(rows, first, dim + 1)
    if not n:
        return Fit(0, [], [])
    centre = [(2 * s + n) // (2 * n) for s in sums]  # nearest integers to the means

    upper = np.triu_indices(dim)

    def second(x: np.ndarray) -> np.ndarray:
        return exact_gram(x - np.array(centre, np.int64))[upper]

    grams = dict(zip(zip(*(u.tolist() for u in upper)), _summed(rows, second, len(upper[0]))))
    rest = [s - n * c for s, c in zip(sums, centre)]
    full = [[n * grams[min(i, j), max(i, j)] - rest[i] * rest[j] for j in range(dim)] for i in range(dim)]
    return Fit(n, sums, full)


# -- characteristic polynomial ----------------------------------------------

def is_prime(n: int) -> bool:
    """Miller and Rabin's test, certain below 3.2 * 10^9 with these bases."""
    if n < 2 or n % 2 == 0:
        return n == 2
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):
        if a % n == 0:
            continue
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """The largest primes below :data:`PRIME_TOP` whose product passes ``2 * bound``."""
    out, product, p = [], 1, PRIME_TOP - 1
    while product <= 2 * bound:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def coefficient_bound(scatter: list[list[int]]) -> int:
    """No coefficient is larger: the k-th elementary symmetric function of d
    numbers that are not negative is at most C(d, k) * (their mean)^k."""
    d, trace = len(scatter), sum(scatter[i][i] for i in range(len(scatter)))
    return max(-(-math.comb(d, k) * trace ** k // d ** k) for k in range(d + 1))


def hessenberg(h: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``h`` modulo ``p`` with zeros below the subdiagonal."""
    h = h.copy()
    for m in range(1, len(h) - 1):
        at = np.flatnonzero(h[m:, m - 1])
        if not len(at):
            continue
        i = m + int(at[0])
        if i != m:
            h[[m, i]] = h[[i, m]]
            h[:, [m, i]] = h[:, [i, m]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u % p).sum(1)) % p
    return h


def modular_polynomial(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of ``det(x - matrix)`` modulo ``p``, constant first."""
    h, d = hessenberg(matrix % p, p), len(matrix)
    polys = np.zeros((d + 1, d + 1), np.int64)  # of the leading minors
    polys[0, 0] = 1
    chain = np.empty(0, np.int64)  # products of subdiagonal entries down to each column
    for k in range(1, d + 1):
        new = np.roll(polys[k - 1], 1)  # times x: the last entry is still zero
        new = (new - h[k - 1, k - 1] * polys[k - 1]) % p
        if k > 1:
            chain = np.append(chain * h[k - 1, k - 2] % p, h[k - 1, k - 2])
            weight = h[:k - 1, k - 1] * chain % p
            new = (new - (weight[:, None] * polys[:k - 1] % p).sum(0)) % p
        polys[k] = new
    return polys[d]


def characteristic_polynomial(spark: SparkSession, scatter: list[list[int]]) -> list[int]:
    """Integer coefficients of ``det(x - scatter)``, constant first. The primes
    are dealt to tasks; each returns its residues."""
    d, primes = len(scatter), primes_for(coefficient_bound(scatter))
    packed = [[str(v) for v in row] for row in scatter]
    tasks = spark.createDataFrame([(p,) for p in primes], "p long").repartition(
        min(len(primes), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), "p")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = [[int(v) for v in row] for row in packed]
        for batch in batches:
            found = []
            for p in batch.column("p").to_pylist():
                found.append(modular_polynomial(np.array([[v % p for v in row] for row in matrix], np.int64), p).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("p"), pa.array(found, pa.list_(pa.int64()))], ["p", "residues"])

    rows = tasks.mapInArrow(run, "p long, residues array<long>").collect()  # d + 1 residues for each prime
    modulus = math.prod(primes)
    coefficients = [0] * (d + 1)
    for row in rows:
        rest = modulus // row["p"]
        unit = rest * pow(rest, -1, row["p"])
        for k, r in enumerate(row["residues"]):
            coefficients[k] += r * unit
    return [c - modulus if 2 * c > modulus else c for c in (c % modulus for c in coefficients)]


# -- roots ------------------------------------------------------------------

def roots_above(poly: list[int], point: Fraction) -> int:
    """Roots greater than ``point``, with multiplicity, of a polynomial that has
    real roots only: the sign changes of the polynomial shifted there."""
    num, den = point.numerator, point.denominator
    c, power = [], 1
    for a in reversed(poly):  # den^d * poly(x / den) has integer coefficients
        c.append(a * power)
        power *= den
    c.reverse()
    for i in range(len(c) - 1):  # Taylor shift by Horner's rule
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += num * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value_sign(poly: list[int], point: Fraction) -> int:
    num, den = point.numerator, point.denominator
    total, power = 0, 1
    for a in reversed(poly):
        total = total * num + a * power
        power *= den
    return (total > 0) - (total < 0)


def _narrow(poly: list[int], lo: Fraction, hi: Fraction, bits: int) -> tuple[Fraction, Fraction]:
    """Bisect a half-open interval (lo, hi] that holds one simple root."""
    above = value_sign(poly, hi)
    if above == 0:
        return hi, hi
    while (hi - lo) * (1 << bits) > hi:
        mid = (lo + hi) / 2
        s = value_sign(poly, mid)
        if s == 0:
            return mid, mid
        lo, hi = (lo, mid) if s == above else (mid, hi)
    return lo, hi


def largest_roots(poly: list[int], k: int) -> list[tuple[Fraction, int]]:
    """The positive roots among the ``k`` largest, the greatest first, each with
    its multiplicity, to :data:`ROOT_BITS` bits."""
    positive = len(poly) - 1 - next(i for i, c in enumerate(poly) if c)
    if not positive:
        return []
    top = Fraction(-poly[-2])  # the sum of all roots
    found: list[tuple[Fraction, int]] = []
    stack = [(Fraction(0), top, positive, 0)]  # (lo, hi], roots above lo, roots above hi
    while stack and sum(m for _, m in found) < k:
        lo, hi, over_lo, over_hi = stack.pop()
        inside = over_lo - over_hi
        if not inside:
            continue
        if inside == 1 and lo:
            lo, hi = _narrow(poly, lo, hi, ROOT_BITS)
            found.append(((lo + hi) / 2, 1))
        elif lo and (hi - lo) * (1 << ROOT_BITS) <= hi:
            found.append(((lo + hi) / 2, inside))
        else:
            mid = (lo + hi) / 2
            over = roots_above(poly, mid)
            stack += [(lo, mid, over_lo, over), (mid, hi, over, over_hi)]
    return found


# -- eigenvectors -----------------------------------------------------------

def _solve(matrix: np.ndarray, right: np.ndarray, one: int) -> np.ndarray:
    """Gauss's elimination with row pivots in fixed point; a pivot of zero
    counts as the smallest unit, as inverse iteration wants it."""
    a, x = matrix.copy(), right.copy()
    n = len(a)
    for i in range(n):
        at = i + max(range(n - i), key=lambda r: abs(a[i + r, i]))
        if at != i:
            a[[i, at]], x[[i, at]] = a[[at, i]], x[[at, i]]
        if a[i, i] == 0:
            a[i, i] = 1
        if i + 1 < n:
            factor = a[i + 1:, i] * one // a[i, i]
            a[i + 1:, i:] -= factor[:, None] * a[i, i:] // one
            x[i + 1:] -= factor[:, None] * x[i] // one
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= (a[i, i + 1:] @ x[i + 1:]) // one
        x[i] = x[i] * one // a[i, i]
    return x


def _orthonormal(x: np.ndarray, one: int) -> np.ndarray:
    for j in range(x.shape[1]):
        column = x[:, j] * one // max(1, max(abs(v) for v in x[:, j]))
        for _ in range(2):
            for i in range(j):
                column = column - x[:, i] * ((x[:, i] @ column) // one) // one
        length = math.isqrt(int(column @ column))
        x[:, j] = column * one // max(1, length)
    return x


def null_space(scatter: list[list[int]], root: Fraction, times: int, rounds: int = 3) -> np.ndarray:
    """``times`` orthonormal vectors that span the null space of ``scatter -
    root``, as doubles, one in each row."""
    one = 1 << FIXED_BITS
    size = max(1, max(abs(v) for row in scatter for v in row))
    a = np.array([[v * one // size for v in row] for row in scatter], object)
    shift = int(root * one / size)
    d = len(scatter)
    for i in range(d):
        a[i, i] -= shift
    # start vectors by rule, of no special direction
    x = np.array([[one * (((i + 1) * 7919 + (j + 1) * 104729 * (i + 3)) % 1009 - 504) // 504 for j in range(times)]
                  for i in range(d)], object)
    x = _orthonormal(x, one)
    for _ in range(rounds):
        x = _orthonormal(_solve(a, x, one), one)
    return np.array([[float(Fraction(int(x[i, j]), one)) for i in range(d)] for j in range(times)])


@dataclass(frozen=True)
class Components:
    n: int
    sums: list[int]
    vectors: np.ndarray     # one in each row
    roots: list[float]      # n^2 times the eigenvalues, as doubles
    explained: list[float]


def components(spark: SparkSession, fitted: Fit, k: int) -> Components:
    """The ``k`` first components, each root's vectors found in a task of its own."""
    trace = sum(fitted.scatter[i][i] for i in range(len(fitted.scatter)))
    if not trace:
        return Components(fitted.n, fitted.sums, np.empty((0, len(fitted.sums))), [], [])
    poly = characteristic_polynomial(spark, fitted.scatter)
    roots = largest_roots(poly, k)
    packed = [[str(v) for v in row] for row in fitted.scatter]
    ask = [(i, f"{r.numerator}/{r.denominator}", min(m, k)) for i, (r, m) in enumerate(roots)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = [[int(v) for v in row] for row in packed]
        for batch in batches:
            found = [null_space(matrix, Fraction(r), m).tolist() for r, m in zip(batch.column("root").to_pylist(), batch.column("times").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(found, pa.list_(pa.list_(pa.float64())))], ["i", "vectors"])

    got = (spark.createDataFrame(ask, "i int, root string, times int").repartition(len(ask), "i")
           .mapInArrow(run, "i int, vectors array<array<double>>").collect())  # k vectors, or one root's multiplicity
    vectors = [v for row in sorted(got, key=lambda r: r["i"]) for v in row["vectors"]][:k]
    values = [r for r, m in roots for _ in range(m)][:k]
    return Components(fitted.n, fitted.sums, np.array(vectors), [float(v) for v in values], [float(v / trace) for v in values])


# -- the operator -----------------------------------------------------------

def _deviations(x: np.ndarray, c: Components) -> tuple[np.ndarray, list[int]]:
    """Whitened rows, and the exact sums of squares of ``n x - S``."""
    most = max(1, int(np.abs(x).max(initial=0)))
    wide = c.n * most + max(map(abs, c.sums)) >= 2 ** 62
    y = x.astype(object) * c.n - np.array(c.sums, object) if wide else x * c.n - np.array(c.sums, np.int64)
    peak = int(abs(y).max()) if y.size else 0
    if peak * peak * x.shape[1] >= 2 ** 63:
        o = y.astype(object)
        squares = (o * o).sum(1)
    else:
        squares = (y * y).sum(1)
    white = y.astype(np.float64) @ c.vectors.T / np.sqrt(np.array(c.roots))
    return white, [int(v) for v in squares]


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 8, scale: int = 1024,
           offset: int = 100_000) -> DataFrame:
    """``vec_id, component, n, deviation, deviation_digits, whitened, explained,
    identity_error``: the ``k`` first whitened components of every row."""
    spark = df.sparkSession
    rows = prepare(df, vec_id, vector, scale, offset)
    id_type = rows.schema["id"].dataType.simpleString()
    schema = (f"vec_id {id_type}, component int, n long, deviation long, deviation_digits string, whitened double, "
              "explained double, identity_error double")
    sizes = rows.groupBy(F.size("x").alias("dim")).count()
    dim = sizes.orderBy(F.col("count").desc(), F.col("dim").desc()).first()
    if dim is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("x") == dim["dim"])
    found = components(spark, fit(rows, dim["dim"]), k)
    many = len(found.roots)
    if not many:
        return spark.createDataFrame([], schema)
    # mean and covariance of what is returned, in units that integers add up exactly
    unit = 1 << 40

    def moments(x: np.ndarray) -> np.ndarray:
        white, _ = _deviations(x, found)
        return np.array([round(v * unit) for v in (*white.sum(0), *(white.T @ white).ravel())], object)

    got = _summed(rows, moments, many + many * many)
    mean = [got[i] / unit / found.n for i in range(many)]
    error = max(abs(got[many + i * many + j] / unit / found.n - mean[i] * mean[j] - (i == j)) for i in range(many) for j in range(many))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            white, squares = _deviations(_matrix(batch.column("x")), found)
            size = batch.num_rows
            each = pa.array(np.repeat(np.arange(size), many))
            fits = pa.array([v if v < 1 << 63 else None for v in squares], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(each), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), size)),
                 pa.array(np.full(size * many, found.n)), fits.take(each), pa.array(list(map(str, squares))).take(each),
                 pa.array(white.ravel()), pa.array(np.tile(found.explained, size)), pa.array(np.full(size * many, error))],
                ["vec_id", "component", "n", "deviation", "deviation_digits", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
