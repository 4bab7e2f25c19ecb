"""Operator 5: document fingerprints of closed syncmers.

A k-mer of code points is a closed syncmer if the least hash among its inner
s-mers stands first or last in it. Whether a k-mer is chosen depends on its own
characters only, so equal passages give equal anchors wherever they stand. A
fingerprint holds every anchor of the text at all its places, in the order of
the text, as ten hex digits each: the hash and the step from the place before
(of any k - s neighbouring k-mers one is closed, so a step is at most k - s).

Two fingerprints are compared by the longest chain of shared anchors that rises
in both texts, L: the likeness of texts of n and m anchors is 2 L / (n + m),
the part of the anchors that both texts have in the same order. It is exact.

A text shorter than k has one anchor, its whole; null and empty texts have
none, an empty fingerprint, likeness 1 to each other and 0 to others. Equal
texts have equal fingerprints. The next document of a row is the next by
descending id, null ids last, equal ids by a hash of the text; the last row's
next is the first row, which may be itself. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a k-mer and of its inner s-mers.
K, S = 16, 6
#: Characters worked on at once inside a task.
BLOCK_CHARS = 2 << 20
#: Bytes of place bits that are held while two fingerprints are compared.
MASK_BYTES = 64 << 20
_ANCHOR = np.dtype([("hash", ">u4"), ("step", "u1")])
_MULT, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def anchors(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash (32 bits) and position of every anchor of all texts, and the
    offset of each text's anchors."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.cumsum(size) - size
    cp = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    n, w = len(cp), K - S + 1
    found_at, found_hash = np.empty(0, np.int64), np.empty(0, np.uint64)
    if n >= K:
        h = np.zeros(n - S + 1, np.uint64)
        for i in range(S):
            h = h * _MULT + cp[i:n - S + 1 + i]
        h = _mix(h)
        least, span = h, 1
        while 2 * span <= w:  # least hash of windows of 1, 2, 4, ... s-mers
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        many = len(h) - w + 1
        least = np.minimum(least[:many], least[w - span:w - span + many])
        closed = (h[:many] == least) | (h[w - 1:w - 1 + many] == least)
        inside = np.zeros(n + 1, np.int64)  # k-mers within one text only
        long = size >= K
        np.add.at(inside, start[long], 1)
        np.add.at(inside, start[long] + size[long] - K + 1, -1)
        at = np.flatnonzero(closed & (np.cumsum(inside)[:many] > 0))
        value = _mix((_mix(h[at] * _MULT + h[at + S]) * _MULT) + h[at + w - 1])
        found_at, found_hash = at, value >> np.uint64(32)
    short = np.flatnonzero((size > 0) & (size < K))
    if len(short):
        own = np.array([int.from_bytes(hashlib.blake2b(texts[i].encode(), digest_size=4).digest(), "big") for i in short], np.uint64)
        found_at, found_hash = np.concatenate([found_at, start[short]]), np.concatenate([found_hash, own])
        order = np.argsort(found_at, kind="stable")
        found_at, found_hash = found_at[order], found_hash[order]
    edges = np.append(start, n)
    offsets = np.searchsorted(found_at, edges)
    of = np.repeat(np.arange(len(texts)), np.diff(offsets))
    return found_hash.astype(np.uint32), (found_at - start[of]).astype(np.uint32), offsets


def sketch(texts: list[str]) -> list[np.ndarray]:
    """For each text all its anchors in order: rows (hash, position)."""
    value, place, offsets = anchors(texts)
    both = np.stack([value, place], 1)
    return [both[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def _by_pairs(x: list[int], at: dict[int, list[int]]) -> int:
    """Longest common chain by the pairs of equal anchors."""
    chain: list[int] = []  # least ends of the chains of each length
    for v in x:
        for p in reversed(at[v]):
            k = bisect_left(chain, p)
            chain[k:k + 1] = [p]
    return len(chain)


def _by_bits(x: list[int], at: dict[int, list[int]], m: int) -> int:
    """The same by one long addition for each anchor of ``x``."""
    full = (1 << m) - 1
    held, masks = MASK_BYTES, {}
    open_ends = full
    for v in x:
        mask = masks.get(v)
        if mask is None:
            bits = np.zeros(m, np.uint8)
            bits[at[v]] = 1
            mask = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
            if held > m // 8:
                masks[v] = mask
                held -= m // 8
        met = open_ends & mask
        open_ends = ((open_ends + met) | (open_ends - met)) & full
    return m - open_ends.bit_count()


def common_chain(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest sequence of hashes that rises in both."""
    least = min(len(x), len(y))
    differ = np.flatnonzero(x[:least] != y[:least])
    head = int(differ[0]) if len(differ) else least  # equal ends are in a longest chain
    x, y, least = x[head:], y[head:], least - head
    differ = np.flatnonzero(x[len(x) - least:] != y[len(y) - least:])
    tail = least - 1 - int(differ[-1]) if len(differ) else least
    xs, ys = x[:len(x) - tail].tolist(), y[:len(y) - tail].tolist()
    common = set(xs).intersection(ys)
    if not common:
        return head + tail
    xs, ys = [v for v in xs if v in common], [v for v in ys if v in common]
    at = defaultdict(list)
    for i, v in enumerate(ys):
        at[v].append(i)
    pairs = sum(len(at[v]) for v in xs)
    if pairs <= len(xs) * (8 + len(ys) // 256):
        return head + tail + _by_pairs(xs, at)
    return head + tail + _by_bits(xs, at, len(ys))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    return 2 * common_chain(a[:, 0], b[:, 0]) / (len(a) + len(b))


def packed(s: np.ndarray) -> str:
    out = np.empty(len(s), _ANCHOR)
    out["hash"], out["step"] = s[:, 0], np.diff(s[:, 1], prepend=s[:1, 1] * 0)
    return out.tobytes().hex()


def unpacked(fingerprint: str) -> np.ndarray:
    got = np.frombuffer(bytes.fromhex(fingerprint), _ANCHOR)
    return np.stack([got["hash"].astype(np.uint32), np.cumsum(got["step"], dtype=np.uint32)], 1)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]




def with_next(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows dealt to partitions in the order of the operator, each partition
    closed by a copy of the row that comes next (``guest`` = 1)."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keys = [F.col(doc_id).isNull().cast("long").alias("k1"), F.coalesce(F.bitwise_not(F.col(doc_id).cast("long")), F.lit(0)).alias("k2"),
            F.xxhash64(t).alias("k3")]
    docs = df.select(F.col(doc_id).alias("id"), t.alias("t"), *keys)
    key = F.struct("k1", "k2", "k3")
    # the first key of each range of keys: one row per partition
    firsts = (docs.select("k1", "k2", "k3").repartitionByRange(parts, "k1", "k2", "k3")
              .groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("k")).select("k.*"))
    bounds = sorted(tuple(r) for r in firsts.collect())
    n = max(1, len(bounds))
    edges = np.array(bounds, dtype=[("k1", "i8"), ("k2", "i8"), ("k3", "i8")])

    @F.pandas_udf("int")
    def part_of(k1: pd.Series, k2: pd.Series, k3: pd.Series) -> pd.Series:
        got = np.empty(len(k1), edges.dtype)
        got["k1"], got["k2"], got["k3"] = k1, k2, k3
        return pd.Series(np.searchsorted(edges, got, "right").astype(np.int32) - 1)

    own = docs.withColumn("part", part_of("k1", "k2", "k3")).withColumn("guest", F.lit(0))
    first_rows = spark.createDataFrame([(*b, (i - 1) % n) for i, b in enumerate(bounds)], "b1 long, b2 long, b3 long, part int")
    guests = (docs.join(F.broadcast(first_rows), (F.col("k1") == F.col("b1")) & (F.col("k2") == F.col("b2")) & (F.col("k3") == F.col("b3")))
              .dropDuplicates(["b1", "b2", "b3"]).drop("b1", "b2", "b3").withColumn("guest", F.lit(1)))
    return (own.unionByName(guests).repartitionById(n, F.col("part"))
            .sortWithinPartitions("part", "guest", "k1", "k2", "k3").select("part", "guest", "id", "t"))


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` of every row."""
    ordered = with_next(df, doc_id, text)
    kind = ordered.schema["id"].dataType.simpleString()
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def done(ids: list, texts: list[str], following: list[str]) -> Iterator[pa.RecordBatch]:
        """Rows whose next text is known, a block at a time."""
        at = 0
        while at < len(ids):
            end, held = at, 0
            while end < len(ids) and (end == at or held + len(texts[end]) <= BLOCK_CHARS):
                held += len(texts[end])
                end += 1
            part, nxt = texts[at:end], following[at:end]
            own = sketch(part + nxt[-1:])
            new = [edited(t, f) for t, f in zip(part, nxt)]
            changed = sketch(new)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[at:end], ordered_type), pa.array(list(map(len, part)), pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in new]),
                pa.array(list(map(packed, own[:-1])), pa.string()), pa.array(list(map(packed, changed)), pa.string()),
                pa.array([likeness(a, b) for a, b in zip(own, changed)]),
                pa.array([likeness(a, b) for a, b in zip(own, own[1:])])], names)
            at = end

    from pyspark.sql.pandas.types import to_arrow_type
    ordered_type = to_arrow_type(ordered.schema["id"].dataType)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # a row whose next is not known yet
        for batch in batches:
            guest = batch.column("guest").to_pylist()
            ids, texts = batch.column("id").to_pylist(), batch.column("t").to_pylist()
            known, own, following = [], [], []
            for i, t, g in zip(ids, texts, guest):
                if waiting is not None:
                    known.append(waiting[0])
                    own.append(waiting[1])
                    following.append(t)
                waiting = None if g else (i, t)
            yield from done(known, own, following)

    return (ordered.mapInArrow(run, f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
                                    "edited_fingerprint string, near_edited double, near_next double")
            .withColumnRenamed("id", doc_id))
