import random
import re

from pyspark.sql import functions as F
from .test_llm_queries import compare

from ebbflow.llm import linededup as L
from ebbflow.llm.common import configure, table


def brute(rows):
    """Removed line numbers of rows (key, text), in the order given."""
    seen, out = [], []
    for key, text in rows:
        gone = []
        for no, line in enumerate([] if text is None else text.split("\n")):
            words = set(re.findall("[^\x20\x09-\x0d]+", line))
            if not words:
                continue
            if any(5 * len(words & o) >= 4 * len(words | o) for o in seen):
                gone.append(no)
            seen.append(words)
        out.append((key, 0 if text is None else text.count("\n") + 1, len(gone), gone))
    return out


def check(df):
    order = [F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)), L.row_key(df)]
    rows = [(r["doc_id"], r["text"]) for r in df.orderBy(*order).select("doc_id", "text").collect()]
    want = brute(rows)
    got = [tuple(r) for r in L.report(df).collect()]
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    texts = sorted((str(i), str(None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)))
                   for (i, t), (_, _, _, gone) in zip(rows, want))
    cleaned = L.remove(df)
    assert cleaned.columns == df.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in cleaned.collect()) == texts


def test_awkward_rows(spark, awkward, nothing):
    configure(spark)
    check(awkward)
    assert L.report(nothing).count() == 0 and L.remove(nothing).count() == 0


def test_random_lines(spark):
    configure(spark)
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    lines = [" ".join(rng.choices(vocab, weights=[1 / (i + 1) for i in range(60)], k=rng.randint(1, 25))) for _ in range(60)]

    def edit(line):
        w = line.split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        return " ".join(w)

    rows = [(i, "\n".join(edit(rng.choice(lines)) if rng.random() < 0.9 else rng.choice(["", " ", lines[0]])
                          for _ in range(rng.randint(0, 12)))) for i in range(120)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_group_of_near_copies(spark):
    configure(spark)
    base = [f"word{i}" for i in range(40)]
    rng = random.Random(6)
    rows = []
    for i in range(300):
        w = base[:]
        for _ in range(4):
            w[rng.randrange(40)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_documents(spark):
    configure(spark)
    check(table(spark, "/root/testdata/sf0.001", "documents"))


def test_query(spark):
    compare(spark, "op6_line_dedup", "/root/testdata/sf0.01")


def test_plan_is_native(spark):
    configure(spark)
    plan = L.report(table(spark, "/root/testdata/sf0.001", "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_prefix_join_reads_one_shuffle(spark, tmp_path):
    configure(spark)
    rows = spark.createDataFrame([(i, 7, " ".join(f"w{i * k % 11}" for k in range(1, 9))) for i in range(40)], "d long, rk long, t string")
    L._classes(rows, 4, 5).write.parquet(str(tmp_path / "classes"))
    classes = spark.read.parquet(str(tmp_path / "classes"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the plan shows no reuse before it runs
    try:
        pairs = L._prefix_pairs(classes, classes.select(*L.PLACE).filter("d < 5"), 4, 5)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        configure(spark)
    assert plan.count("Generate") == 1
    assert "ReusedExchange" in plan


def test_longer_and_shorter_lines_in_either_order(spark):
    configure(spark)
    full = [f"u{i}" for i in range(20)]
    texts = [" ".join(full[:16]), " ".join(full), " ".join(full[:16] + ["v"]), " ".join(full[1:17]) + "\n" + " ".join(full[:19])]
    rows = [(g * 10 + i, t.replace("u", f"g{g}u")) for g, order in enumerate(([0, 1, 2, 3], [3, 2, 1, 0], [1, 0, 3, 2]))
            for i, t in enumerate(texts[k] for k in order)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_all_blanks_part_words(spark):
    configure(spark)
    words = [f"b{i}" for i in range(12)]
    blanks = [" ", "\t", "\x0b", "\f", "\r", " \t", "\r ", "\f\x0b\t  "]
    rows = [(2 * i, b.join(words)) for i, b in enumerate(blanks)]
    rows += [(2 * i + 1, f"{b}c{i}{b}d{i} e{i}{b}\n{b}\n e{i} c{i}\r\n\u00a0{b}\x1c") for i, b in enumerate(blanks)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_pairs_lie_in_fewer_partitions(spark, monkeypatch):
    configure(spark)
    before, seen, verified = spark.conf.get("spark.sql.shuffle.partitions"), [], L._verified_pairs

    def watched(pairs, *rest):
        seen.append((pairs.rdd.getNumPartitions(), spark.conf.get("spark.sql.shuffle.partitions")))
        return verified(pairs, *rest)

    monkeypatch.setattr(L, "_verified_pairs", watched)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        check(spark.createDataFrame([(i, " ".join(f"p{(i // 3 + k) % 50}" for k in range(10 + i % 3))) for i in range(60)], "doc_id long, text string"))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 4 and all(n <= 2 and conf == "2" for n, conf in seen)
