"""Operator 2: near-duplicates by SimHash and a binary trie self-join.

Texts become 64-bit fingerprints, equal fingerprints are one node, and nodes
whose fingerprints differ in at most ``max_bits`` bits are linked. The join
traverses pairs of trie nodes together, one bit level after the other: a pair
of nodes carries the bits in which their prefixes differ, and is dropped as
soon as these exceed the budget.

For Spark the trie is cut into leaves of bounded size (dense regions are cut
deeper). The leaves, at most a fixed number times 2^16 whatever the input,
are themselves joined by the same traversal; every pair of leaves within the
budget is a cell, to which the fingerprints of both are dealt, and in a cell
the traversal goes on to the last bit. A cell returns a spanning forest of its
links, not the links, so groups of near copies give as many rows as they have
fingerprints.

Null and empty texts have the fingerprint zero and are linked like others.
Repeated rows and ids keep their rows. A null id never names a component
unless all ids of the component are null. Columns other than the id and the
text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import ranges, row_key, slices, sorted_groups, text_buffer
from ebbflow.llm.components import components
from ebbflow.session import checkpointed

BLOCK_BYTES = 1 << 20
#: A leaf holds at most this many fingerprints, or a 2^-16 part of all if more.
LEAF, MAX_LEAVES_LOG2 = 512, 16
#: Node pairs of the traversal that are worked on at once.
FRONTIER = 1 << 19
_LANES = np.uint64(0x0101010101010101)


# -- fingerprints -------------------------------------------------------------

def shingle_hashes(raw: bytes, offsets: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every word shingle of every text, and how many each text has.
    A text of fewer words has its whole sequence, one without words none."""
    raw = raw.lower()  # A-Z only, these are bytes
    u8 = np.frombuffer(raw, np.uint8)
    solid = ~((u8 == 32) | ((u8 >= 9) & (u8 <= 13)))
    edge = np.zeros(len(u8) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], solid[:-1]])
    first = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.concatenate([solid[1:], [False]])
    last = np.flatnonzero(solid & (~after | edge[1:])) + 1
    size = last - first
    words = np.diff(np.searchsorted(first, offsets))
    # the words end to end, one blank after each
    out_start = np.cumsum(size + 1) - (size + 1)
    flat = np.full(int((size + 1).sum()), 32, np.uint8)
    keep = np.ones(len(flat), bool)
    keep[out_start + size] = False
    flat[keep] = u8[solid]
    joined = flat.tobytes()
    out_end = out_start + size
    n = np.where(words == 0, 0, np.maximum(1, words - width + 1))
    text_first = np.cumsum(words) - words
    start = np.repeat(text_first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    stop = start + np.repeat(np.minimum(words, width), n) - 1
    spans = map(slice, out_start[start].tolist(), out_end[stop].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in map(joined.__getitem__, spans)), np.uint64, len(start))
    return hashes, n


def majority_bits(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each text the bits set in over half of its hashes."""
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    size = n[full]
    # byte lanes hold counts up to 255, so sum runs of 255 first
    runs = -(-size // 255)
    text_start = np.cumsum(size) - size
    run_no = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
    run_start = np.repeat(text_start, runs) + 255 * run_no
    lanes = np.stack([np.add.reduceat((hashes >> np.uint64(j)) & _LANES, run_start) for j in range(8)], 1)
    counts = lanes.view(np.uint8).reshape(len(run_start), 8, 8).astype(np.int64)  # run, bit j, byte
    counts = np.add.reduceat(counts, np.cumsum(runs) - runs, axis=0)
    bits = 2 * counts > size[:, None, None]
    place = np.arange(8)[:, None] + 8 * np.arange(8)[None, :]
    out[full] = (bits.astype(np.uint64) << place.astype(np.uint64)).sum(axis=(1, 2), dtype=np.uint64)
    return out


def fingerprints(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), width: int = 3,
                 seed: int = 42) -> DataFrame:
    """Columns ``keep`` and ``fp`` (the 64 bits as a long) of every row."""
    narrow = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("t"))
    schema = ", ".join([*(f"k{i} {narrow.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))), "fp bigint"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "t", BLOCK_BYTES):
                raw, offsets = text_buffer(batch.column("t"))
                fp = majority_bits(*shingle_hashes(raw, offsets, width, seed)).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(batch.column(f"k{i}") for i in range(len(keep))), pa.array(fp)],
                                                 [*(f"k{i}" for i in range(len(keep))), "fp"])

    return narrow.mapInArrow(run, schema).withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})


# -- trie traversal -----------------------------------------------------------

def trie_pairs(a: np.ndarray, a_depth: np.ndarray, b: np.ndarray, b_depth: np.ndarray,
               budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) whose first min(a_depth[i], b_depth[j]) bits differ in
    at most ``budget`` places, in blocks. ``a`` and ``b`` are sorted, with no
    element inside another's subtree."""
    if not len(a) or not len(b):
        return
    z = np.zeros(1, np.int64)
    todo = [(0, z, z + len(a), z, z + len(b), z)]
    while todo:
        level, al, ah, bl, bh, diff = todo.pop()
        if len(al) > FRONTIER:
            for k in range(0, len(al), FRONTIER):
                todo.append((level, *(x[k:k + FRONTIER] for x in (al, ah, bl, bh, diff))))
            continue
        a_end, b_end = a_depth[al] <= level, b_depth[bl] <= level
        both = a_end & b_end
        if both.any():
            yield al[both], bl[both]
            al, ah, bl, bh, diff, a_end, b_end = (x[~both] for x in (al, ah, bl, bh, diff, a_end, b_end))
        if not len(al):
            continue
        am, bm = _middle(a, al, ah, level), _middle(b, bl, bh, level)
        # an ended side stands for both of its (equal) halves, at no cost
        am = np.where(a_end, ah, am)
        bm = np.where(b_end, bh, bm)
        free = a_end | b_end
        parts = []
        for x, y in ((0, 0), (1, 1), (0, 1), (1, 0)):
            nal, nah = (al, am) if x == 0 else (am, ah)
            nbl, nbh = (bl, bm) if y == 0 else (bm, bh)
            d = diff + (0 if x == y else np.where(free, 0, 1))
            ok = (nah > nal) & (nbh > nbl) & (d <= budget)
            parts.append([v[ok] for v in (nal, nah, nbl, nbh, d)])
        todo.append((level + 1, *(np.concatenate(v) for v in zip(*parts))))


def _middle(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
    """Where, in each range with a common prefix of ``level`` bits, the next
    bit turns to one."""
    shift = np.uint64(63 - level)
    edge = ((values[lo] >> shift) | np.uint64(1)) << shift
    return np.clip(np.searchsorted(values, edge), lo, hi)


class Forest:
    """Union of links between ``n`` nodes, fed in blocks."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        lab = self.label
        while True:
            a, b = lab[u], lab[v]
            open_ = a != b
            if not open_.any():
                return
            u, v, a, b = u[open_], v[open_], a[open_], b[open_]
            np.minimum.at(lab, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = lab[lab]
                if (up == lab).all():
                    break
                lab[:] = up


def cut_leaves(values: np.ndarray, cap: int) -> list[tuple[int, int]]:
    """Trie nodes (first value, depth) of at most ``cap`` of the sorted values."""
    out, todo = [], [(0, len(values), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo <= cap or depth == 64:
            if hi > lo:
                shift = 64 - depth
                out.append((int(values[lo]) >> shift << shift, depth))
            continue
        mid = int(_middle(values, np.array([lo]), np.array([hi]), depth)[0])
        todo += [(lo, mid, depth + 1), (mid, hi, depth + 1)]
    return out


def disjoint(leaves: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Nodes that contain other nodes of the list give way to their halves."""
    todo = sorted(set(leaves), key=lambda x: (-x[0], -x[1]))  # a stack: smallest first, outer before inner
    out: list[tuple[int, int]] = []
    while todo:
        start, depth = todo.pop()
        if todo and depth < 64 and todo[-1][0] < start + (1 << 64 - depth):
            if todo[-1] == (start, depth):
                continue
            halves = {(start, depth + 1), (start + (1 << 63 - depth), depth + 1)}
            inner = []
            while todo and todo[-1][0] < start + (1 << 64 - depth):
                inner.append(todo.pop())
            todo += sorted(halves | set(inner), key=lambda x: (-x[0], -x[1]))
            continue
        out.append((start, depth))
    return out


# -- the operator -------------------------------------------------------------

def links(fps: DataFrame, max_bits: int, leaf: int = LEAF) -> DataFrame:
    """Spanning links (u, v) of the graph over distinct fingerprints ``fp``."""
    spark = fps.sparkSession
    # ranges of fingerprints, as unsigned numbers, give each task a stretch of the trie
    n = fps.count()
    cap = max(leaf, n >> MAX_LEAVES_LOG2)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))
    ranged = fps.select("fp", order.alias("o")).repartitionByRange(parts, "o").sortWithinPartitions("o")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.asarray(b.column("fp")).view(np.uint64) for b in batches]
        found = cut_leaves(np.concatenate(held), cap) if held else []
        yield pa.RecordBatch.from_arrays([pa.array(np.array([s for s, _ in found], np.uint64).view(np.int64)),
                                          pa.array([d for _, d in found], pa.int32())], ["start", "depth"])

    # At most 64 * 2^16 nodes, as each level has at most 2^16 nodes over the cap.
    nodes = ranged.mapInArrow(cut, "start bigint, depth int").collect()
    leaves = sorted(disjoint((r["start"] % (1 << 64), r["depth"]) for r in nodes))
    starts = np.array([s for s, _ in leaves], np.uint64)
    depths = np.array([d for _, d in leaves], np.int64)
    tree = spark.sparkContext.broadcast((starts, depths))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, depths = tree.value
        for batch in batches:
            fp = np.asarray(batch.column("fp")).view(np.uint64)
            if not len(fp):
                continue
            of = np.searchsorted(starts, fp, "right") - 1
            own = np.unique(of)
            place = np.searchsorted(own, of)
            for i, j in trie_pairs(starts[own], depths[own], starts, depths, max_bits):
                here = own[i]
                low, high = np.minimum(here, j), np.maximum(here, j)
                order = np.argsort(i, kind="stable")
                low, high, i = low[order], high[order], i[order]
                first = np.searchsorted(i, np.arange(len(own)))
                many = np.diff(np.append(first, len(i)))
                for k in range(0, len(fp), 1 << 14):
                    p = place[k:k + (1 << 14)]
                    at = ranges(first[p], many[p])
                    copies = np.repeat(fp[k:k + (1 << 14)], many[p])
                    side = (np.repeat(of[k:k + (1 << 14)], many[p]) != low[at]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(low[at] << 32 | high[at]), pa.array(side),
                                                      pa.array(copies.view(np.int64))], ["cell", "side", "fp"])

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, held = [], [], 0
        for cell, g in sorted_groups(batches, "cell"):
            fp = g["fp"].view(np.uint64)
            a = np.sort(fp[g["side"] == 0])
            alone = int(cell) >> 32 == int(cell) & 0xFFFFFFFF
            b = a if alone else np.sort(fp[g["side"] == 1])
            full = lambda x: np.full(len(x), 64)
            forest = Forest(len(a) if alone else len(a) + len(b))
            for i, j in trie_pairs(a, full(a), b, full(b), max_bits):
                forest.link(i, j if alone else j + len(a))
            both = a if alone else np.concatenate([a, b])
            moved = np.flatnonzero(forest.label != np.arange(len(both)))
            if len(moved):
                us.append(both[moved])
                vs.append(both[forest.label[moved]])
                held += len(moved)
            if held > 1 << 16:
                yield _edge_batch(us, vs)
                us, vs, held = [], [], 0
        if held:
            yield _edge_batch(us, vs)

    cells = ranged.select("fp").mapInArrow(deal, "cell bigint, side int, fp bigint")
    return (cells.repartition(parts, "cell").sortWithinPartitions("cell")
            .mapInArrow(join, "u bigint, v bigint"))


def _edge_batch(us: list[np.ndarray], vs: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us).view(np.int64)),
                                       pa.array(np.concatenate(vs).view(np.int64))], ["u", "v"])


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3,
                    max_bits: int = 2, seed: int = 42, extra: tuple[str, ...] = (), leaf: int = LEAF) -> DataFrame:
    """``doc_id``, columns ``extra``, ``fp`` (long), ``component_id`` (the
    smallest id reachable over links) and ``root`` (the component's smallest
    fingerprint, as a long) of every row."""
    docs = checkpointed(fingerprints(df, text, (doc_id, *extra), width, seed))
    nodes = checkpointed(docs.groupBy("fp").agg(F.min(F.col(doc_id)).alias("least")))
    roots = components(links(nodes, max_bits, leaf))
    placed = (nodes.join(roots, nodes["fp"] == roots["node"], "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select(F.col("fp").alias("_fp"), "component_id", "root")
    return docs.join(named, docs["fp"] == named["_fp"]).drop("_fp")


def keep_one(df: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3, max_bits: int = 2,
             seed: int = 42) -> DataFrame:
    """One row of each component: that of the smallest id (null ids last), of
    rows with equal ids that of the smallest digest, of equal rows any one."""
    last = F.lit((1 << 63) - 1)
    rows = df.withColumns({"_d": F.coalesce(F.col(doc_id).cast("long"), last), "_rk": row_key(df)})
    found = near_duplicates(rows, text, "_d", width, max_bits, seed, ("_rk",))
    best = found.groupBy("root").agg(F.min(F.struct("_d", "_rk")).alias("best")).select("best.*")
    copies = found.groupBy("_d", "_rk").agg(F.count("*").alias("_copies"))
    chosen = checkpointed(best.join(copies, ["_d", "_rk"]))
    met = rows.join(chosen, ["_d", "_rk"])
    single = met.filter("_copies = 1").select(*df.columns)
    return single.unionByName(met.filter("_copies > 1").select(*df.columns).dropDuplicates())


def hex16(column) -> F.Column:
    """The 64 bits of a long as 16 hex digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")
