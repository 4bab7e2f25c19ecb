import hashlib
from collections import Counter, defaultdict

import corpus_pipeline as C
import public_tokenizers as P
import pytest
from .conftest import brute_components
from pyspark.sql import functions as F
from .test_linededup import brute
from .test_mixing import fill, order
from .test_simhash import slow_fingerprint
from tokenizers import Tokenizer

from ebbflow.llm.common import configure, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    configure(spark)
    return table(spark, FOLDER, "documents")


def test_each_stage_against_brute_force(spark, docs):
    kept = C.quality_filter(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    rows = kept.orderBy("doc_id").collect()
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()} and 0.7 * docs.count() < len(rows)

    cut = C.line_dedup(spark, kept, FOLDER)
    want = {}
    for key, _, _, gone in brute([(r["doc_id"], r["text"]) for r in rows]):
        t = next(r["text"] for r in rows if r["doc_id"] == key)
        want[key] = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)
    cut_rows = cut.collect()
    assert cut.columns == docs.columns and {r["doc_id"]: r["text"] for r in cut_rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in cut_rows)

    one = C.near_dedup(spark, cut, FOLDER)
    ids = sorted(want)
    comp = brute_components(len(ids), lambda i, j: (slow_fingerprint(want[ids[i]]) ^ slow_fingerprint(want[ids[j]])).bit_count() <= 2)
    one_rows = one.collect()
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in one_rows) == sorted({ids[c] for c in comp})

    mix = C.mix_sources(spark, one, FOLDER)
    size = {r["doc_id"]: len(r["text"].split()) for r in one_rows}
    sums, got = defaultdict(int), defaultdict(int)
    for r in one_rows:
        sums[r["source"]] += size[r["doc_id"]]
    mix_rows = mix.collect()
    for r in mix_rows:
        got[r["source"]] += size[r["doc_id"]]
    goal = fill(sums, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order(sums))}, 3)
    assert all(abs(got[s] - goal[s]) <= max(size.values()) for s in sums)
    assert max(Counter(r["doc_id"] for r in mix_rows).values()) <= 3

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    text = {r["doc_id"]: r["text"] for r in one_rows}
    last = C.encode(spark, mix, FOLDER).collect()
    assert Counter(r["doc_id"] for r in last) == Counter(r["doc_id"] for r in mix_rows)
    for r in last:
        assert list(r["ids"]) == library.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in C.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup",
                                        "mixing sources to target weights", "BPE encoding and decoding"]
    a, b = (sorted((r["doc_id"], r["ids_sha256"]) for r in C.run(spark, FOLDER).collect()) for _ in range(2))
    assert a == b and a


def test_awkward_rows(spark, awkward, nothing):
    docs = awkward.withColumn("n_chars", F.length("text").cast("long"))
    for df in (docs, nothing):
        for _, stage in C.STAGES[1:-1]:
            out = stage(spark, df, FOLDER)
            assert out.columns == C.COLUMNS
            assert (out.count() > 0) == (df is docs)
        assert C.STAGES[-1][1](spark, df, FOLDER).count() == df.count()
        assert C.STAGES[0][1](spark, df, FOLDER).count() <= df.count()
    one = C.near_dedup(spark, docs, FOLDER)
    assert one.filter("text = 'a b c d'").count() == 1
