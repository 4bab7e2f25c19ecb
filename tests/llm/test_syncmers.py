import hashlib
import random

import numpy as np
import pytest
from .conftest import SF_SMALL

from ebbflow.llm import syncmers as S
from ebbflow.llm.common import configure, table


def slow_anchors(text):
    """Positions of closed syncmers by the definition, on the same hashes."""
    out = []
    for i in range(len(text) - S.K + 1):
        kmer = text[i:i + S.K]
        h = [smer_hash(kmer[j:j + S.S]) for j in range(S.K - S.S + 1)]
        if min(h) in (h[0], h[-1]):
            out.append(i)
    return out


def mix(x):
    m = (1 << 64) - 1
    x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & m
    return x ^ (x >> 29)


def smer_hash(s):
    h = 0
    for c in s:
        h = (h * 0x9E3779B97F4A7C15 + ord(c)) & ((1 << 64) - 1)
    return mix(h)


def test_anchors_are_closed_syncmers():
    rng = random.Random(1)
    texts = ["".join(rng.choices("abcdé ", k=n)) for n in (0, 1, 15, 16, 17, 300, 40)] + ["a" * 50]
    value, place, offsets = S.anchors(texts)
    for i, t in enumerate(texts):
        got = place[offsets[i]:offsets[i + 1]].tolist()
        assert got == ([0] if 0 < len(t) < S.K else slow_anchors(t))


def test_equal_passages_give_equal_anchors():
    rng = random.Random(2)
    shared = "".join(rng.choices("etaoin shrdlu", k=500))
    a, b = "x" * 37 + shared, shared + "tail" * 9
    v, p, o = S.anchors([a, b])
    first = {(h, q - 37) for h, q in zip(v[:o[1]].tolist(), p[:o[1]].tolist()) if q >= 37}
    second = {(h, q) for h, q in zip(v[o[1]:].tolist(), p[o[1]:].tolist()) if q <= 500 - S.K}
    assert second <= first | {(h, q) for h, q in second if q > 500 - S.K} and len(second) > 50


def test_likeness():
    rng = random.Random(3)
    a, b = ("".join(rng.choices("etaoin shrdlu", k=4000)) for _ in range(2))
    half = S.edited(a, b)
    x, y, z, e = S.sketch([a, b, half, ""])
    assert S.likeness(x, x) == 1 and S.likeness(e, e) == 1 and S.likeness(x, e) == 0
    assert S.likeness(x, y) < 0.05 and 0.35 < S.likeness(x, z) < 0.65
    assert (S.unpacked(S.packed(x)) == x).all()


def slow_chain(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        new = [0]
        for j, b in enumerate(y):
            new.append(row[j] + 1 if a == b else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_common_chain():
    rng = random.Random(4)
    for n, kinds in ((0, 1), (5, 2), (40, 3), (40, 30), (130, 4), (300, 2)):
        for _ in range(5):
            x, y = (np.array(rng.choices(range(kinds), k=rng.randint(0, n)), np.uint32) for _ in range(2))
            want = slow_chain(x.tolist(), y.tolist())
            assert S.common_chain(x, y) == want
            at = {v: np.flatnonzero(y == v).tolist() for v in range(kinds)}
            assert S._by_pairs(x.tolist(), at) == S._by_bits(x.tolist(), at, len(y)) == want


def test_long_texts_keep_all_anchors(monkeypatch):
    """A passage that long texts share, or in which they differ, shows."""
    rng = random.Random(5)
    a, b = ("".join(rng.choices("etaoin shrdlu", k=100_000)) for _ in range(2))
    shared = a[:50_000] + b[50_000:50_300] + a[50_300:]
    x, y, z = S.sketch([a, b, shared])
    assert len(x) == len(slow_anchors(a)) and (S.unpacked(S.packed(x)) == x).all()
    assert S.packed(x) != S.packed(z) and 0.99 < S.likeness(x, z) < 1
    far = S.sketch([b[:20_000] + a[70_000:70_300] + b[20_300:]])[0]  # at another place of another text
    assert S.likeness(x, far) > S.likeness(x, y) and S.likeness(x, far) >= 2 * 40 / (len(x) + len(far))
    once, twice = S.sketch([a[:1000], a[:1000] * 2])  # places of an anchor beyond the first
    assert 0.6 < S.likeness(once, twice) < 0.72
    # anchors that meet in very many pairs
    p, q = S.sketch(["lorem ipsum dolor " * 4000, "dolor " + "lorem ipsum dolor " * 3000])
    monkeypatch.setattr(S, "MASK_BYTES", 0)
    assert S.likeness(p, q) > 0.85


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))


def check(df):
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    got = S.fingerprints(df).collect()
    assert len(got) == len(rows)
    texts = [t for _, t in rows]
    prints = dict(zip(texts, map(S.packed, S.sketch(texts))))
    ids = [i for i, _ in rows]
    ordered = order(rows)
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if ids.count(r["doc_id"]) == 1:
            at = next(k for k, x in enumerate(ordered) if x[0] == r["doc_id"])
            t = ordered[at][1]
            assert (r["n_chars"], r["fingerprint"]) == (len(t), prints[t])
            after = {x[1] for x in ordered if x[0] == ordered[(at + 1) % len(ordered)][0]}
            # equal ids leave the next text open
            after = [f for f in after if hashlib.sha256(S.edited(t, f).encode()).hexdigest() == r["edited_sha256"]]
            a, b, *others = S.sketch([t, S.edited(t, after[0]), *after])
            assert (r["edited_fingerprint"], r["near_edited"]) == (S.packed(b), S.likeness(a, b))
            assert r["near_next"] in [S.likeness(a, c) for c in others]


@pytest.mark.parametrize("block", [50, 1 << 21])
def test_awkward_rows(spark, awkward, nothing, block, monkeypatch):
    configure(spark)
    monkeypatch.setattr(S, "BLOCK_CHARS", block)
    check(awkward)
    check(awkward.filter("doc_id = 7"))
    assert S.fingerprints(nothing).count() == 0


def test_documents(spark):
    configure(spark)
    check(table(spark, SF_SMALL, "documents"))
