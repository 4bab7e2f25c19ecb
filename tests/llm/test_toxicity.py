import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbflow.llm import toxicity as T
from ebbflow.llm.common import configure, table
from ebbflow.llm.queries import op13

#: Words that the toxic texts of the given tables hold.
TELLING = r"(?i)trash|pathetic|disgusting|idiot|worthless|stupid|clown|loser|scum|moron"


def test_held_out_accuracy(spark):
    configure(spark)
    folder = "/root/testdata/sf0.1"
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").rlike(TELLING).alias("telling"))
    got = op13(spark, folder).join(table(spark, folder, "labels"), "doc_id").join(docs, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    bad = [r for r in held if r["toxic"] == 1 and r["telling"]]
    clean = [r for r in held if r["toxic"] == 0]
    assert sum(r["predicted"] for r in bad) >= 0.95 * len(bad)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got)


def slow_score(text, model):
    """From the table, the layer and the bags, one word after another."""
    words = Counter(w for piece in T.words_of(text) for w in piece)
    mean, total = np.zeros(model.settings.dim), T.NEUTRAL + sum(1 + math.log(c) for c in words.values())
    for w, c in words.items():
        rows, size = T.bags([w], model.settings)
        grams = [f"<{w}>"[i:i + g] for g in model.settings.ngrams for i in range(len(w) + 3 - g)]
        assert size[0] == len(rows) == 1 + len(grams)
        mean += (1 + math.log(c)) * model.table[rows].astype(float).mean(0) / total
    logit = mean @ model.layer + model.bias
    p = np.exp(logit - logit.max())
    return p[1] / p.sum()


@pytest.fixture(scope="module")
def taught(spark):
    configure(spark)
    texts = [f"plain words of text number {i} and more" for i in range(300)]
    rows = [(i, t.replace("text", "horrible" if i % 3 == 0 else "nice")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    return docs, labels, T.train(docs, labels)


def test_scores_equal_the_slow_way(spark, taught, awkward):
    _, _, model = taught
    for r in T.score(awkward, model, keep=("doc_id", "text")).collect():
        assert r["score"] == pytest.approx(slow_score(r["text"], model), abs=1e-6)


def test_unseen_misspellings_share_n_grams(spark, taught):
    _, _, model = taught
    docs = spark.createDataFrame([(1, "plain words of horrible number"), (2, "plain words of horrrible number"), (3, "plain words of HORRIBLEE!! number"),
                                  (4, "plain words of nice number"), (5, "plain words of nicce number")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in T.score(docs, model).collect()}
    assert min(got[1], got[2], got[3]) > 0.5 > max(got[4], got[5])


def test_long_texts_are_scored_whole(spark, taught, monkeypatch):
    _, _, model = taught
    monkeypatch.setattr(T, "PIECE_CHARS", 50)
    text = " ".join(f"word{i % 700} plain horrible" for i in range(5000))
    assert [w for p in T.words_of(text) for w in p] == text.split()
    w, bias, _ = model.weights()
    assert T.Scorer(w, bias, model.settings).score(text) == pytest.approx(slow_score(text, model), abs=1e-6)


def test_awkward_rows(spark, awkward, nothing):
    configure(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(15)] + [(None, 1), (3, None), (4, 7), (2, 1), (99, 0)], "doc_id long, toxic int")
    model = T.train(awkward, labels)
    rows = T.score(awkward, model, keep=("doc_id", "text")).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["text"] in (None, "", " \t\n")}) == 1
    assert len({r["score"] for r in rows if r["text"] == "a b c d"}) == 1
    again = T.score(awkward.repartition(3), T.train(awkward.repartition(5), labels), keep=("doc_id", "text")).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert T.score(nothing, model).count() == 0
    assert T.train(nothing, labels.limit(0)).weights()[1] == 0


def test_one_class_or_none(spark, awkward):
    configure(spark)
    for labels, share in (([(1, 1)], 2 / 3), ([], 0.5)):
        model = T.train(awkward, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {round(r["score"], 6) for r in T.score(awkward, model).collect()} == {round(share, 6)}


def test_labels_of_held_out_rows_change_nothing(taught):
    docs, labels, model = taught
    flipped = labels.withColumn("toxic", F.when(T.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.train(docs, flipped).weights()[2] == model.weights()[2]


def test_features_are_bounded_in_bytes(spark, taught, monkeypatch):
    from ebbflow.llm import fitting
    docs, labels, _ = taught
    rows = T.features(fitting.sample_of(docs, labels, "toxic", T.held_out("doc_id"), 40), T.Settings())
    assert rows.count() == 40
    assert fitting.fit_in_task(rows, lambda i, v, y: len(y)) == 40
    one = rows.selectExpr("max(length(idx) + length(val))").first()[0]
    assert 1 <= fitting.fit_in_task(rows, lambda i, v, y: len(y), max_bytes=5 * one) < 40
