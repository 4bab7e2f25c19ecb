import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbflow.llm import hardneg as H
from ebbflow.llm.common import configure

from .test_llm_queries import compare

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int, id long, cell string"
LONG = (1 << 63) - 1


@pytest.mark.parametrize("n, k, m", [(1, 1, 1), (3, 5, 7), (33, 64, 50), (40, 17, 129), (0, 4, 3)])
def test_strassen_equals_the_plain_product(n, k, m):
    rng = np.random.default_rng(n + k)
    a, b = rng.integers(-300, 300, (n, k)), rng.integers(-300, 300, (m, k))
    assert (H.products(a, b) == a @ b.T).all()
    assert (H.strassen(a, b.T, leaf=2) == a @ b.T).all()


def test_products_beyond_doubles_and_longs_are_exact():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-(1 << 30), 1 << 30, (20, 18)), rng.integers(-(1 << 30), 1 << 30, (19, 18))
    want = a.astype(object) @ b.T.astype(object)
    assert (H.products(a, b).astype(object) == want).all() and abs(want).max() > 1 << 60
    wide = H.products(a * (1 << 20), b * (1 << 10))
    assert (wide.astype(object) == np.clip(want * (1 << 30), -LONG - 1, LONG)).all()


def test_heaps_merge_to_the_best_of_all():
    rng = random.Random(5)
    rows = [(rng.randrange(4), rng.randrange(6), at) for at in range(200)]
    whole, halves = H.Heaps(4, 3), H.Heaps(4, 3)
    whole.push(*np.array(rows).T)
    for part in (rows[:90], rows[90:]):
        one = H.Heaps(4, 3)
        one.push(*np.array(part).T)
        halves.push(one.owner, one.score, one.at)
    for h in (whole, halves):
        for owner in range(4):
            want = sorted((-s, at) for o, s, at in rows if o == owner)[:3]
            assert [(-s, a) for o, s, a in zip(h.owner, h.score, h.at) if o == owner] == want


def test_window_bounds_are_the_integers_of_the_inequality():
    for score in [*range(-25, 200), LONG, LONG - 7]:
        lo, hi = H.window(np.array([score]), (3, 10), (9, 10))
        assert int(lo[0]) == -((-3 * score) // 10) and int(hi[0]) == 9 * score // 10


def brute(rows, scale=256):
    good = sorted({(i is None, i or 0, lab, tuple(math.floor(scale * x) for x in v), n) for n, (i, v, lab, *_) in enumerate(rows)
                   if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    anchors = sorted({(i, lab, v) for null, i, lab, v, _ in good if not null and i % 100 == 0})
    out = []
    for a, lab, v in anchors:
        found = [(-max(-LONG - 1, min(LONG, sum(map(lambda p: p[0] * p[1], zip(v, w))))), null, i, n, l2)
                 for null, i, l2, w, n in good if (null or i != a) and len(w) == len(v)]
        for s, null, i, _, _ in sorted(f for f in found if f[4] == lab)[:5]:
            ok = sorted(f for f in found if f[4] != lab and -30 * s <= -100 * f[0] <= -90 * s)[:10]
            out += [(a, None if null else i, rank + 1, None if n2 else j, -s, -s2) for rank, (s2, n2, j, _, _) in enumerate(ok)]
    return sorted(out, key=str)


def check(spark, rows):
    configure(spark)
    df = spark.createDataFrame(rows, SCHEMA)
    got = H.mine(df, F.col("vec_id") % 100 == 0)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([tuple(r) for r in df.collect()])


def test_many_cells_hot_label_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(H, "MIN_CELL_ROWS", 90)
    monkeypatch.setattr(H, "TILE_ROWS", 40)
    monkeypatch.setattr(H, "TILE_ANCHORS", 3)
    rng = random.Random(2)
    base = [rng.gauss(0, 1) for _ in range(19)]
    near = lambda s: [x + rng.gauss(0, s) for x in base]
    rows = [(i * 20, near(rng.choice([0.2, 1, 3])), rng.choice([1, 1, 1, 1, 2, 3]), "", 0, 1, "") for i in range(300)]
    rows += [(7 + i, base, 1 + i % 2, "", 0, 1, "") for i in range(120)] + [(100, base, 1, "", 0, 1, "")] * 3
    check(spark, rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    one = lambda i, v, lab=1: (i, v, lab, None, None, None, None)
    rows = [one(0, [1.0, 2.0]), one(100, [1.0, None]), one(200, [nan, 1.0]), one(300, None), one(400, [inf, 1.0], None), one(500, [0.5]),
            one(600, []), one(700, []), one(701, [], 2), one(None, [1.0, 2.0]), one(None, [1.0, 2.0]), one(3, [1.0, 1.9]), one(4, [-1.0, -2.0]),
            one(5, [0.5, 1.0], 2), one(None, [0.5, 1.1], 3), one(6, [0.5, 1.0], 2), one(800, [0.0, 0.0]), one(800, [0.0, 0.0], 4),
            one(900, [3e12, 1.0]), one(901, [3e12, -1.0]), one(902, [2e12, 0.0], 5), one(1000, [1e30, 0.0], None)]
    check(spark, rows)
    assert H.mine(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0


def test_query(spark):
    compare(spark, "op11_hard_negatives", "/root/testdata/sf0.01")
