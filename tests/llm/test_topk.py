import math
import random

from pyspark.sql import functions as F
from .test_llm_queries import compare

from ebbflow.llm import topk as T
from ebbflow.llm.common import configure

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int"


def brute(rows, k, is_query, scale=1024):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v, *_ in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in good:
        if i is not None and is_query(i):
            found = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j is None, j or 0) for j, w in good if j != i and len(w) == len(v))
            out += [(i, n + 1, None if null else j, -s) for n, (s, null, j) in enumerate(found[:k])]
    return sorted(out, key=str)


def check(spark, rows, k=10):
    configure(spark)
    df = spark.createDataFrame(rows, SCHEMA)
    got = T.top_k(df, F.col("vec_id") % 100 == 0, k)
    rows = [tuple(r) for r in df.collect()]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, k, lambda i: i % 100 == 0)


def vec(rng, dim, size=1.0):
    v = [rng.gauss(0, 1) for _ in range(dim)]
    n = math.sqrt(sum(x * x for x in v)) or 1
    return [size * x / n for x in v]


def test_lengths_ties_and_copies(spark):
    rng = random.Random(2)
    base = vec(rng, 16)
    rows = [(i * 20, vec(rng, 16, rng.choice([0.01, 1, 1, 5, 40])), 0, "", 0) for i in range(400)]
    rows += [(7 + i, base, 0, "", 0) for i in range(60)] + [(100, base, 0, "", 0)] * 3 + [(200, [2 * x for x in base], 0, "", 0)]
    check(spark, rows)


def test_close_vectors_use_coordinates(spark, monkeypatch):
    monkeypatch.setattr(T, "MIN_CELL_ROWS", 100)
    rng = random.Random(4)
    base = vec(rng, 12, 3)
    rows = [(i, [x + rng.gauss(0, 0.05) for x in base], 0, "", 0) for i in range(1000)]
    check(spark, rows, 3)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1, "", 1), (100, [1.0, None], 1, "", 1), (200, [nan, 1.0], 1, "", 1), (300, None, 1, "", 1),
            (400, [inf, 1.0], None, None, None), (500, [0.5], 1, "", 1), (600, [], 1, "", 1), (700, [], 1, "", 1),
            (None, [1.0, 2.0], 1, "", 1), (None, [1.0, 2.0], 1, "", 1), (3, [1.0, 2.0], 1, "", 1), (4, [-1.0, -2.0], 1, "", 1),
            (800, [0.0, 0.0], 1, "", 1), (900, [3e6, 1.0], 1, "", 1), (901, [3e6, -1.0], 1, "", 1), (1000, [1e12, 0.0], 1, "", 1)]
    check(spark, rows, 5)
    assert T.top_k(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0


def test_query(spark):
    compare(spark, "op1_topk_search", "/root/testdata/sf0.01")
