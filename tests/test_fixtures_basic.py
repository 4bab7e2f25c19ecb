"""Row operators and running values on visits drawn by a rule, against plain Python."""

from pyspark.sql import functions as F

from conftest import rows
from ebbflow.functions.text import split_words
from ebbflow.operators import aggregates as A
from ebbflow.operators import basic as B

VISITORS = ["ines", "otto", "ravi", None]


def visits():
    """24 rows: visitor and dwell time by residues, a null time in every ninth row."""
    return [(n, VISITORS[(n * 5 + n // 7) % 4], f"/p{n % 6}", None if n % 9 == 4 else (n * 37) % 50) for n in range(24)]


def frame(spark):
    return spark.createDataFrame(visits(), "seq long, visitor string, page string, dwell long")


def test_filter_eq(spark):
    for who in ("otto", "nobody"):
        assert B.filter_eq(frame(spark), "visitor", who).count() == sum(v[1] == who for v in visits())


def test_flatmap_gives_one_row_per_field(spark):
    out = B.flatmap_fields(frame(spark), "seq", ["visitor", "page", "dwell"])
    assert out.count() == 3 * 24
    seq, who, page, dwell = visits()[6]
    assert rows(out.filter("seq = 6"), "pos", "field") == [(0, who), (1, page), (2, str(dwell))]


def running(step, start):
    """Fold ``step(state, visit)`` per visitor, one output per visit."""
    state, out = {}, []
    for v in visits():
        state[v[1]], value = step(state.get(v[1], start), v)
        out.append((v[0], value))
    return out


def test_running_keyed_max_keeps_first_fields(spark):
    def step(s, v):
        page = s[0] if s else v[2]
        seen = [x for x in ((s[1] if s else None), v[3]) if x is not None]
        new = (page, max(seen) if seen else None)
        return new, new
    out = A.running_keyed_max(frame(spark), "visitor", "dwell", "seq", ["page"])
    assert [(r["seq"], (r["page"], r["dwell"])) for r in out.orderBy("seq").collect()] == running(step, None)


def test_running_count_and_label(spark):
    want = running(lambda n, _: (n + 1, n + 1), 0)
    assert rows(A.running_count(frame(spark), "visitor", "seq"), "seq", "cnt") == want
    labels = rows(A.labelled_count(frame(spark), "visitor", "seq"), "seq", "label")
    assert labels == [(s, f"count：{n}") for s, n in want]


def test_most_active_ties_go_to_newer(spark):
    counts, best, want = {}, (0, None), []
    for _, who, _, _ in visits():
        counts[who] = counts.get(who, 0) + 1
        if counts[who] >= best[0]:
            best = (counts[who], who)
        want.append((best[1], best[0]))
    out = A.most_active(frame(spark), "visitor", "seq").orderBy("seq").collect()
    assert [(r["leader_visitor"], r["leader_cnt"]) for r in out] == want


def test_mean_of_sums_beyond_a_long(spark):
    big = 2**62
    df = spark.createDataFrame([(n, "k", big + n) for n in range(8)], "seq long, k string, v long")
    out = rows(A.every_nth_mean(df, "k", "seq", "v", 4), "rn", "avg_v")
    assert out == [(4, sum(big + n for n in range(4)) // 4), (8, sum(big + n for n in range(8)) // 8)]


def test_word_split_java_semantics(spark):
    df = spark.createDataFrame([("x y x",), ("x  y ",), ("",), ("   ",)], "line string")
    words = df.select(F.explode(split_words("line")).alias("word"))
    assert dict(rows(A.reduce_count(words, "word"), "word", "cnt")) == {"x": 3, "y": 2, "": 2}


def test_sql_select_and_view_chain(spark):
    df = frame(spark)
    assert B.sql_select(spark, df, "visits_v", ["visitor", "page"]).count() == 24
    out = B.view_chain(spark, df, "visitor", "ravi", ["visitor", "page"], "ravi_v")
    assert rows(out) == sorted((v[1], v[2]) for v in visits() if v[1] == "ravi")
