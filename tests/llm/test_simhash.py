import random
import re

import numpy as np
import xxhash
from .conftest import brute_components

from ebbflow.llm import simhash as S
from ebbflow.llm.common import configure, table


def slow_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def check(df, spark, leaf):
    rows = df.select("doc_id", "text").collect()
    got = S.near_duplicates(df, leaf=leaf).select("doc_id", "fp", "component_id").collect()
    fps = sorted({slow_fingerprint(r["text"]) for r in rows})
    comp = brute_components(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    at = {f: comp[i] for i, f in enumerate(fps)}
    least = {}
    for r in rows:
        c = at[slow_fingerprint(r["text"])]
        if r["doc_id"] is not None:
            least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
    key = lambda t: tuple((x is None, x) for x in t)
    want = sorted(((r["doc_id"], f := slow_fingerprint(r["text"]), least.get(at[f])) for r in rows), key=key)
    assert sorted(((r[0], r[1] % (1 << 64), r[2]) for r in got), key=key) == want


def test_awkward_rows(spark, awkward, nothing):
    configure(spark)
    check(awkward, spark, 2)
    assert S.near_duplicates(nothing).count() == 0


def test_documents_against_brute_force(spark):
    configure(spark)
    check(table(spark, "/root/testdata/sf0.01", "documents"), spark, 16)


def test_links_keep_every_component(spark):
    """Random fingerprints with dense clusters, for leaves from tiny to all."""
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1, 1 << 63, 3 << 62}
    for c in list(fps)[:6]:
        for _ in range(60):
            fps.add(c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = sorted(fps)
    want = brute_components(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    for leaf in (1, 7, 10_000):
        edges = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in S.links(df, 2, leaf).collect()]
        assert all((a ^ b).bit_count() <= 64 for a, b in edges)
        linked = set(edges) | {(b, a) for a, b in edges}
        assert brute_components(len(fps), lambda i, j: (fps[i], fps[j]) in linked) == want


def test_trie_pairs_are_all_pairs_within_the_budget():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 12, 300).astype(np.uint64) << np.uint64(52) | np.uint64(5))
    full = np.full(len(a), 64)
    got = {(int(i), int(j)) for x, y in S.trie_pairs(a, full, a, full, 2) for i, j in zip(x, y)}
    want = {(i, j) for i in range(len(a)) for j in range(len(a)) if (int(a[i]) ^ int(a[j])).bit_count() <= 2}
    assert got == want
