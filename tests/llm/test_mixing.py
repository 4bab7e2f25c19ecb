from collections import defaultdict

from ebbflow.llm import mixing as M
from ebbflow.llm.common import configure

from .test_llm_queries import compare


def fill(sizes, weights, cap):
    """Share all sizes by weight; what exceeds a cap is shared again."""
    target, open_ = {}, dict(weights)
    rest = float(sum(sizes.values()))
    while open_:
        level = rest / sum(open_.values())
        over = [s for s in open_ if level * open_[s] > cap * sizes[s]]
        if not over:
            return target | {s: level * w for s, w in open_.items()}
        for s in over:
            target[s] = float(cap * sizes[s])
            rest -= target[s]
            del open_[s]
    return target


def order(sources):
    return sorted(sources, key=lambda s: (s is None, (s or "").encode()))


def check(df, cap=3):
    got = M.mix(df, max_epochs=cap).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    from pyspark.sql import functions as F
    of = {(r["doc_id"], r["size"]): r["source"] for r in df.select("doc_id", M.n_words(F.col("text")).alias("size"), "source").collect()}
    for r in got:
        s = of[r["doc_id"], r["size"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert 0 <= r["taken"] <= cap * r["size"]
    assert all(r["source_size"] == sizes[of[r["doc_id"], r["size"]]] for r in got)
    want = fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order(sizes))}, cap)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6
        assert abs(taken[s] - target[s]) <= 3, (s, taken[s], target[s])
    return got


def test_awkward_rows(spark, awkward, nothing):
    configure(spark)
    first = check(awkward)
    assert sorted(first, key=str) == sorted(check(awkward.repartition(3)), key=str)
    assert M.mix(nothing).count() == 0


def test_capped_sources(spark):
    configure(spark)
    rows = [(i, "w " * (i % 7 + 1), s) for i, s in enumerate(["a"] * 3 + ["b"] * 200 + ["c"] * 40 + [None] * 5 + ["d"])]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    check(spark.createDataFrame(rows[:3], "doc_id long, text string, source string"))


def test_no_words(spark):
    configure(spark)
    df = spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")
    assert [(r["taken"], r["target"]) for r in M.mix(df).collect()] == [(0, 0.0)] * 2


def test_query(spark):
    compare(spark, "op10_mixing")
