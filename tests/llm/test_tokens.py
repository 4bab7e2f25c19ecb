import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from .conftest import SF_SMALL, TEXTS
from tokenizers import Tokenizer

from ebbflow.llm import bpe, transducer
from ebbflow.llm.common import configure, table, text_buffer
from ebbflow.llm.queries import vocabulary


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


PARTS = ["'s", "'", "'re", "'ll", " ", "  ", "\n", "\t", "a", "é", "1", "½", "!", "?", "'v", "'t", "'d", "　", "\x1c",
         "日本", "<|endoftext|>", "<|endoftext|", "😀", "́", "l", "r", "e", "x" * 30, "\x85", "\xa0", "aaa", "A"]


def texts():
    rng = random.Random(11)
    mixed = ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(3000)]
    wide = ["".join(chr(rng.choice([rng.randint(1, 0x7F), rng.randint(0x80, 0xD7FF), rng.randint(0xE000, 0x10FFFF)]))
                    for _ in range(100)) for _ in range(200)]
    long = ["".join(rng.choices("etaoin", k=20_000)), "a" * 9_000, "ab" * 4_000]
    return [t or "" for t in TEXTS] + mixed + wide + long


def test_encoder_counter_and_library_agree(library):
    ts = texts()
    raw, off = text_buffer(pa.array(ts))
    enc = bpe.Encoder(vocabulary())
    ids, at = enc.encode(raw, off)
    want = [e.ids for e in library.encode_batch(ts, add_special_tokens=False)]
    assert [ids[at[i]:at[i + 1]].tolist() for i in range(len(ts))] == want
    plain, ends = enc.decode(ids, at)
    assert [plain[ends[i]:ends[i + 1]].decode() for i in range(len(ts))] == ts
    assert transducer.Counter(vocabulary()).count(raw, off).tolist() == [len(w) for w in want]


def test_memory_can_be_forgotten_between_blocks(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_BYTES", 100)
    monkeypatch.setattr(transducer, "MEMORY_BYTES", 100)
    enc, cnt = bpe.Encoder(vocabulary()), transducer.Counter(vocabulary())
    for t in ("one two", "two three", "one two"):
        raw, off = text_buffer(pa.array([t, t]))
        want = library.encode(t, add_special_tokens=False).ids
        assert enc.encode(raw, off)[0].tolist() == want * 2
        assert cnt.count(raw, off).tolist() == [len(want)] * 2


def test_prefix_scan_equals_one_pass():
    rng = np.random.default_rng(1)
    s = rng.integers(0, len(transducer.SYMBOLS) - 1, 20_000).astype(np.uint8)
    state, flags = 0, np.zeros(len(s), np.uint8)
    for i, x in enumerate(s):
        c = transducer.CUT[state, x]
        flags[i] |= c & 1
        if c & 2:
            flags[i - 1] |= 1
        state = transducer.STEP[state, x]
    assert (transducer.cut_flags(s) == flags).all()


def test_encode_rows(spark, awkward, nothing, library):
    configure(spark)
    got = {r["doc_id"]: r for r in bpe.encode(awkward, vocabulary(), outputs=("ids", "decoded", "ids_sha256", "decoded_sha256")).collect()}
    for i, t in enumerate(TEXTS):
        if i in (3, 5):  # repeated ids
            continue
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert list(got[i]["ids"]) == ids and got[i]["n_tokens"] == len(ids) and got[i]["decoded"] == (t or "")
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode(awkward, vocabulary()).count() == awkward.count()
    assert bpe.encode(nothing, vocabulary()).count() == 0


def test_count_rows(spark, awkward, nothing, library):
    configure(spark)
    got = transducer.count_tokens(awkward, vocabulary(), 10).collect()
    assert len(got) == awkward.count()
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] not in (3, 5):
            t = TEXTS[r["doc_id"]] or ""
            n = len(library.encode(t, add_special_tokens=False).ids)
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 10)
    assert transducer.count_tokens(nothing, vocabulary(), 10).count() == 0


def test_documents(spark, library):
    configure(spark)
    docs = table(spark, SF_SMALL, "documents")
    want = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in docs.collect()}
    assert {r["doc_id"]: list(r["ids"]) for r in bpe.encode(docs, vocabulary()).collect()} == want
    assert {r["doc_id"]: r["n_tokens"] for r in transducer.count_tokens(docs, vocabulary(), 9).collect()} == \
        {k: len(v) for k, v in want.items()}


def test_workers_keep_no_pieces_after_a_task(spark):
    configure(spark)
    df = spark.createDataFrame([(i, f"piece{i} word{7 * i} and more") for i in range(64)], "doc_id long, text string").repartition(4)
    assert bpe.encode(df, vocabulary()).count() == 64
    bpe.encode(df, vocabulary()).collect()

    def held(batches):  # in the workers that Spark has kept
        for batch in batches:
            encoders = list(bpe._ENCODERS.values())
            yield pa.RecordBatch.from_arrays([pa.array([len(encoders)]), pa.array([sum(len(e.index) + e.ids.n for e in encoders)])], ["encoders", "pieces"])

    found = spark.range(0, 16, 1, 16).mapInArrow(held, "encoders bigint, pieces bigint").collect()
    assert sum(r["encoders"] for r in found) and not sum(r["pieces"] for r in found)
