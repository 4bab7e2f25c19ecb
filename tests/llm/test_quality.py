import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbflow.llm import quality as Q
from ebbflow.llm.common import configure, table
from ebbflow.llm.queries import op9


def test_held_out_accuracy(spark):
    configure(spark)
    folder = "/root/testdata/sf0.01"
    got = op9(spark, folder).join(table(spark, folder, "labels"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    right = sum(r["predicted"] == r["quality"] for r in held)
    assert right >= 0.95 * len(held)
    good = [r for r in held if r["quality"] == 1]
    assert sum(r["predicted"] for r in good) >= 0.98 * len(good)


def test_awkward_rows(spark, awkward, nothing):
    configure(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(15)] + [(None, 1), (3, None), (4, 7), (2, 1), (99, 0)],
                                   "doc_id long, quality int")
    model = Q.train(awkward, labels)
    rows = Q.score(awkward, model, keep=("doc_id", "text")).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["text"] in (None, "", " \t\n")}) == 1
    assert len({r["score"] for r in rows if r["text"] == "a b c d"}) == 1
    again = Q.score(awkward.repartition(3), Q.train(awkward.repartition(5), labels), keep=("doc_id", "text")).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert Q.score(nothing, model).count() == 0


def test_one_class_or_none(spark, awkward):
    configure(spark)
    for labels, share in (([(1, 1)], 2 / 3), ([], 0.5)):
        model = Q.train(awkward, spark.createDataFrame(labels, "doc_id long, quality int"))
        got = {round(r["score"], 6) for r in Q.score(awkward, model).collect()}
        assert got == {round(share, 6)}


def test_labels_of_held_out_rows_change_nothing(spark, awkward):
    configure(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(15)], "doc_id long, quality int")
    flipped = labels.withColumn("quality", F.when(Q.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.train(awkward, labels), Q.train(awkward, flipped)
    assert a.weights()[2] == b.weights()[2]


def slow_score(text, model):
    """From the table, the layer and the features, one word after another."""
    words, s = (text or "").encode().split(), model.settings
    rows = [int(f) for w in words for f in Q.word_features([w], s)[0]]
    rows += [Q.REPEAT] * Q.REPEAT_WEIGHT * sum(a == b for a, b in zip(words, words[1:]))
    hidden = model.table[rows].astype(float).mean(0) if rows else np.zeros(s.dim)
    logit = hidden @ model.layer + model.bias
    p = np.exp(logit - logit.max())
    return p[1] / p.sum()


def test_scores_equal_the_slow_way(spark, awkward):
    configure(spark)
    docs = spark.createDataFrame([(i, f"some words of text {i} " + "again again " * (i % 3)) for i in range(80)], "doc_id long, text string")
    model = Q.train(docs, spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(80)], "doc_id long, quality int"))
    for df in (awkward, docs):
        for r in Q.score(df, model, keep=("text",)).collect():
            assert r["score"] == pytest.approx(slow_score(r["text"], model), abs=1e-5)
