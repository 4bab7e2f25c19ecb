import math
import random
from fractions import Fraction

import numpy as np
import pytest

from ebbflow.llm import whitening as W
from ebbflow.llm.common import configure
from ebbflow.llm.queries import op12

SCHEMA = "vec_id long, embedding array<float>, label int, n string, component string, x int"


def leverrier(m):
    """Characteristic polynomial by Faddeev and LeVerrier, constant first."""
    d, out, k = len(m), [1], [[Fraction(0)] * len(m) for _ in m]
    for step in range(1, d + 1):
        k = [[k[i][j] + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        k = [[sum(m[i][t] * k[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        out.append(-sum(k[i][i] for i in range(d)) / Fraction(step))
    return [int(c) for c in reversed(out)]


def scatter(rng, d, n, rank=None):
    y = [[rng.randrange(-50, 50) for _ in range(rank or d)] for _ in range(n)]
    mix = [[rng.randrange(-3, 4) for _ in range(d)] for _ in range(rank or d)]
    y = [[sum(a * mix[t][j] for t, a in enumerate(r)) for j in range(d)] for r in y]
    return [[sum(r[i] * r[j] for r in y) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("d, rank", [(1, None), (2, None), (7, None), (9, 4)])
def test_polynomial_is_exact(spark, d, rank):
    configure(spark)
    m = scatter(random.Random(d), d, 12, rank)
    poly = W.characteristic_polynomial(spark, m)
    assert poly == leverrier(m)
    assert max(map(abs, poly)) <= W.coefficient_bound(m)


def test_roots_of_known_polynomials():
    def times(roots):
        p = [1]
        for r in roots:
            p = [a - r * b for a, b in zip([0, *p], [*p, 0])]
        return p

    assert W.largest_roots(times([0, 0, 5, 5, 5, 9]), 8) == [(Fraction(9), 1), pytest.approx((Fraction(5), 3))]
    far = W.largest_roots(times([1, 10**6, 10**6 + 1, 10**12]), 3)
    assert [m for _, m in far] == [1, 1, 1]
    for (r, _), want in zip(far, (10**12, 10**6 + 1, 10**6)):
        assert abs(r - want) * (1 << (W.ROOT_BITS - 1)) <= want
    assert W.largest_roots(times([0, 0]), 2) == []
    for point in (Fraction(0), Fraction(5), Fraction(9, 2), Fraction(9)):
        assert W.roots_above(times([0, 2, 5, 5, 9]), point) == sum(r > point for r in (0, 2, 5, 5, 9))


def test_null_space_of_close_and_repeated_roots():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    for values in ([100, 100.0001, 7, 3, 2, 1], [5, 5, 5, 2, 1, 1]):
        m = [[round(v * 2**60) for v in row] for row in (q * values) @ q.T]
        m = [[m[min(i, j)][max(i, j)] for j in range(6)] for i in range(6)]
        got = W.null_space(m, Fraction(round(max(values) * 2**60)), 3 if values[0] == 5 else 1)
        assert np.allclose(got @ got.T, np.eye(len(got)), atol=1e-14)
        a = np.array(m, float) / 2**60
        assert np.allclose(got @ a, max(values) * got, atol=1e-9)


def brute(rows, k=8):
    """By numpy, in exact integers up to the eigenvectors."""
    good = [(i, [math.floor(1024 * x) + 100_000 for x in v]) for i, v, *_ in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    n, d = len(good), len(good[0][1])
    s = [sum(v[j] for _, v in good) for j in range(d)]
    y = [[n * v[j] - s[j] for j in range(d)] for _, v in good]
    v = np.array([[float(sum(Fraction(r[i] * r[j], n ** 3) for r in y)) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e)[:k]
    return good, y, e[order], u[:, order], np.trace(v)


def check(spark, rows, k=8):
    configure(spark)
    got = W.whiten(spark.createDataFrame(rows, SCHEMA), k=k).collect()
    good, y, e, u, trace = brute(rows, k)
    assert len(got) == len(good) * len(e) and {r["n"] for r in got} == {len(good)}
    want = sorted((i is None, i or 0, sum(a * a for a in yy)) for (i, _), yy in zip(good, y))
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, int(r["deviation_digits"])) for r in got if r["component"] == 1) == want
    assert all(r["deviation"] == int(r["deviation_digits"]) for r in got)
    assert max(r["identity_error"] for r in got) < 1e-9
    for c in range(len(e)):
        white = {(i, sum(a * a for a in yy)): float(np.array(yy, float) @ u[:, c] / len(good) / math.sqrt(e[c])) for (i, _), yy in zip(good, y)}
        mine = [(r["whitened"], white[r["vec_id"], r["deviation"]]) for r in got if r["component"] == c + 1]
        sign = 1 if sum(a * b for a, b in mine) > 0 else -1
        assert max(abs(a - sign * b) for a, b in mine) < 1e-8
        assert all(r["explained"] == pytest.approx(e[c] / trace) for r in got if r["component"] == c + 1)


def test_equals_numpy(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.1 * (j + 1)) for j in range(10)], 1, "", "", 0) for i in range(150)]
    check(spark, rows + rows[:5] + [(None, rows[7][1], None, None, None, None)])
    check(spark, [(r[0], r[1][:3], *r[2:]) for r in rows])


def test_awkward_rows(spark):
    configure(spark)
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, [nan, 1.0, 1.0]), (3, [None, 1.0, 1.0]), (4, [inf, 0.0, 1.0]), (5, []), (6, [1.0]), (7, [1.0, 2.0, 3.0, 4.0])]
    rng = random.Random(3)
    good = [(100 + i, [rng.random(), rng.random(), 0.5]) for i in range(20)]  # one dimension is constant
    full = lambda rows: spark.createDataFrame([(*r, 0, None, "y", 1) for r in rows], SCHEMA)
    got = W.whiten(full(bad + good)).collect()
    assert sorted({r["vec_id"] for r in got}) == [g[0] for g in good] and {r["component"] for r in got} == {1, 2}
    assert W.whiten(full([])).count() == 0
    assert W.whiten(full(good[:1])).count() == 0
    assert W.whiten(full([good[0]] * 9)).count() == 0


def test_huge_entries_stay_exact(spark):
    configure(spark)
    rows = [(i, [float(2 ** (40 + i % 3)) * (i - 7), float(i * i)], 0, "", "", 0) for i in range(15)]
    got = W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    _, y, *_ = brute([(i, [float(np.float32(x)) for x in v]) for i, v, *_ in rows])
    assert {r["vec_id"]: int(r["deviation_digits"]) for r in got} == {i: sum(a * a for a in yy) for i, yy in enumerate(y)}
    assert all(r["deviation"] is None for r in got if int(r["deviation_digits"]) >= 1 << 63)
    assert got[0]["identity_error"] < 1e-9


def test_repeated_eigenvalues(spark):
    configure(spark)
    rows = [(n, [s if j == i else 0.0 for j in range(5)], 0, "", "", 0) for n, (i, s) in enumerate((i, s) for i in range(5) for s in (-1.0, 1.0))]
    got = W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component"] for r in got} == {1, 2, 3, 4, 5} and got[0]["identity_error"] < 1e-12
    assert all(r["explained"] == pytest.approx(0.2) for r in got)


def test_query_over_the_given_table(spark):
    folder = "/root/testdata/sf0.01"
    got = op12(spark, folder).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    good, y, e, u, trace = brute(rows)
    assert len(got) == 8 * len(good) and got[0]["identity_error"] < 1e-9
    at = {i: n for n, (i, _) in enumerate(good)}
    white = np.array(y, float) @ u / len(good) / np.sqrt(e)
    for c in range(8):
        pairs = [(r["whitened"], white[at[r["vec_id"]], c]) for r in got if r["component"] == c + 1]
        sign = 1 if sum(a * b for a, b in pairs) > 0 else -1
        assert max(abs(a - sign * b) for a, b in pairs) < 1e-6
