"""Operator 11: hard-negative mining by Strassen products of int64 tiles.

All rows that take part are dealt to cells by a hash of the row and its input
partition, whatever their label, so no label or group of copies fills a cell; anchors go to every cell in
blocks (the anchors are the stated query set). A cell holds its candidates by
id, and meets the anchors block by block: the tile of their inner products is a
recursive Strassen multiplication of int64 matrices padded with zeros. Two runs
over the cells use the same tiles. The first keeps each anchor's best rows of
its own label (over tiles of one label each); the second, for each (anchor,
positive), the best rows of other labels inside the positive's score window.
What a cell keeps is a heap of bounded size for each anchor; heaps of an anchor
merge by taking the best of them together.

Sums and products wrap at 2^64, so every intermediate value may overflow and the
product is still exact if it fits a long. Leaf products go through float64 where
2^53 bounds them; components so large that a score might pass 2^63 are
multiplied as Python's integers and the score cut to the range of a long.

Rows with a null label, a null vector or a null, NaN or infinite component take
no part; those of other sizes are not compared with each other. A row without an
id is no anchor, is a candidate after all ids, and keeps its label. An anchor's
other rows are those of another id. Rows equal in id, label and vector are one
anchor; as candidates each of them counts. An anchor without positives, or a
positive without rows in its window (as when its score is negative), returns
nothing. Empty tables return nothing; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.session import checkpointed

#: Bytes of a cell's vectors, and the least rows worth a cell of their own.
CELL_BYTES, MIN_CELL_ROWS = 64 << 20, 2048
#: Anchors and candidates of a tile; sides up to this are not halved any more.
TILE_ANCHORS, TILE_ROWS, LEAF = 256, 2048, 16
_LONG = (1 << 63) - 1


# -- exact products ---------------------------------------------------------

def _leaf(a: np.ndarray, b: np.ndarray, small: bool) -> np.ndarray:
    if small:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _pad(m: np.ndarray, rows: int, cols: int) -> np.ndarray:
    if m.shape == (rows, cols):
        return m
    out = np.zeros((rows, cols), m.dtype)
    out[:m.shape[0], :m.shape[1]] = m
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF, limit: int | None = None) -> np.ndarray:
    """``a @ b`` of integer matrices with seven products of halves, down to
    sides of ``leaf``; odd sides get a row or column of zeros. ``limit`` bounds
    the absolute entries of ``a`` times those of ``b`` (None: unknown)."""
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= leaf:
        return _leaf(a, b, limit is not None and limit * k < 2 ** 53)
    hn, hk, hm = -(-n // 2), -(-k // 2), -(-m // 2)
    a, b = _pad(a, 2 * hn, 2 * hk), _pad(b, 2 * hk, 2 * hm)
    a11, a12, a21, a22 = a[:hn, :hk], a[:hn, hk:], a[hn:, :hk], a[hn:, hk:]
    b11, b12, b21, b22 = b[:hk, :hm], b[:hk, hm:], b[hk:, :hm], b[hk:, hm:]
    below = None if limit is None else 4 * limit  # sums of two entries on both sides

    def times(x, y):
        return strassen(x, y, leaf, below)

    p1, p2 = times(a11 + a22, b11 + b22), times(a21 + a22, b11)
    p3, p4 = times(a11, b12 - b22), times(a22, b21 - b11)
    p5, p6, p7 = times(a11 + a12, b22), times(a21 - a11, b11 + b12), times(a12 - a22, b21 + b22)
    out = np.empty((2 * hn, 2 * hm), np.result_type(p1))
    out[:hn, :hm], out[:hn, hm:] = p1 + p4 - p5 + p7, p3 + p5
    out[hn:, :hm], out[hn:, hm:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:n, :m]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two int64 matrices, as longs."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    limit = max(abs(int(a.max())), abs(int(a.min()))) * max(abs(int(b.max())), abs(int(b.min())))
    if limit * a.shape[1] <= _LONG:
        return strassen(a, np.ascontiguousarray(b.T), limit=limit)
    wide = strassen(a.astype(object), b.T.astype(object))
    return np.clip(wide, -_LONG - 1, _LONG).astype(np.int64)


# -- heaps ------------------------------------------------------------------

class Heaps:
    """For each of ``n`` owners the ``k`` candidates of the highest score, ties
    to the candidate met first. Two of them merge by :meth:`push`."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.owner, self.score, self.at = (np.empty(0, np.int64) for _ in range(3))
        self.full, self.floor = np.zeros(n, bool), np.zeros(n, np.int64)

    def open(self, scores: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """Which allowed candidates of a tile can enter (candidates come in the
        order of ties: what only equals a full heap's floor cannot)."""
        return allowed & (~self.full[:, None] | (scores > self.floor[:, None]))

    def push(self, owner: np.ndarray, score: np.ndarray, at: np.ndarray) -> None:
        owner, score, at = (np.concatenate(x) for x in ((self.owner, owner), (self.score, score), (self.at, at)))
        order = np.lexsort((at, ~score, owner))  # ~score falls as the score rises, without overflow
        owner, score, at = owner[order], score[order], at[order]
        new = np.ones(len(owner), bool)
        new[1:] = owner[1:] != owner[:-1]
        place = np.arange(len(owner)) - np.maximum.accumulate(np.where(new, np.arange(len(owner)), 0))
        keep = place < self.k
        self.owner, self.score, self.at = owner[keep], score[keep], at[keep]
        last = place == self.k - 1
        self.full[owner[last]], self.floor[owner[last]] = True, score[last]


def _meet(heaps: Heaps, scores: np.ndarray, allowed: np.ndarray, base: int) -> None:
    i, j = np.nonzero(heaps.open(scores, allowed))
    if len(i):
        heaps.push(i, scores[i, j], base + j)


# -- cells ------------------------------------------------------------------

class Cell:
    """The candidates of a cell in the order of their ids (null last)."""

    def __init__(self, parts: list[pa.RecordBatch], dim: int):
        t = pa.Table.from_batches(parts)
        null = np.asarray(t.column("id").is_null())
        ids = np.asarray(t.column("id").fill_null(0))
        order = np.lexsort((ids, null))
        self.id, self.null = ids[order], null[order]
        self.label = np.asarray(t.column("label"))[order]
        self.m = _matrix(t.column("ints").combine_chunks(), dim)[order]
        by_label = np.lexsort((np.arange(len(order)), self.label))  # places, label by label, in order of ids
        names, first = np.unique(self.label[by_label], return_index=True)
        self.places = dict(zip(names.tolist(), np.split(by_label, first[1:])))


def _matrix(column, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dim)


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Cell, pa.RecordBatch]]:
    """Each cell with each of its blocks of anchors. Rows come sorted by cell,
    candidates (kind 0) first."""
    at, cell, parts = None, None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([np.asarray(batch.column(c)) for c in ("dim", "cell", "kind")], 1)
        edges = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(key)]):
            here, kind = tuple(key[lo][:2].tolist()), key[lo][2]
            if here != at:
                at, cell, parts = here, None, []
            if kind == 0:
                parts.append(batch.slice(lo, hi - lo))
            elif parts or cell:
                if cell is None:
                    cell, parts = Cell(parts, here[0]), []
                for a in range(lo, hi, TILE_ANCHORS):
                    yield cell, batch.slice(a, min(TILE_ANCHORS, hi - a))


def best_positives(k: int):
    """Task: each anchor's ``k`` best rows of its own label in a cell."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, block in _runs(batches):
            ids, label = np.asarray(block.column("id")), np.asarray(block.column("label"))
            m = _matrix(block.column("ints"), cell.m.shape[1])
            heaps = Heaps(len(ids), k)
            for name in np.unique(label).tolist():
                mine, places = np.flatnonzero(label == name), cell.places.get(name, np.empty(0, np.int64))
                for lo in range(0, len(places), TILE_ROWS):
                    part = places[lo:lo + TILE_ROWS]
                    scores = products(m[mine], cell.m[part])
                    other = cell.null[part] | (cell.id[part] != ids[mine, None])
                    few = Heaps(len(mine), k)
                    few.full, few.floor = heaps.full[mine], heaps.floor[mine]
                    i, j = np.nonzero(few.open(scores, other))
                    heaps.push(mine[i], scores[i, j], part[j])
            yield pa.RecordBatch.from_arrays(
                [block.column("uid").take(pa.array(heaps.owner)), pa.array(cell.id[heaps.at], mask=cell.null[heaps.at]),
                 pa.array(heaps.score)], ["uid", "other", "score"])

    return run


def window(score: np.ndarray, low: tuple[int, int], high: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer x with low <= x / score <= high (fractions),
    without products that pass a long. Empty for negative scores."""
    def part(n: int, d: int) -> tuple[np.ndarray, np.ndarray]:
        return n * (score // d), n * (score % d)
    (lo, lo_rest), (hi, hi_rest) = part(*low), part(*high)
    return lo - (-lo_rest // low[1]), hi + hi_rest // high[1]


def best_negatives(k: int, low: tuple[int, int], high: tuple[int, int]):
    """Task: for each anchor and positive, a cell's ``k`` best rows of another
    label inside the window."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, block in _runs(batches):
            ids, label = np.asarray(block.column("id")), np.asarray(block.column("label"))
            m = _matrix(block.column("ints"), cell.m.shape[1])
            counts = np.asarray(block.column("scores").value_lengths())
            flat = np.asarray(block.column("scores").flatten(), np.int64)
            start = np.cumsum(counts) - counts
            ranks = int(counts.max(initial=0))
            heaps = [Heaps(len(label), k) for _ in range(ranks)]
            bounds = []
            for r in range(ranks):
                has = counts > r
                lo, hi = window(flat[np.where(has, start + r, 0)], low, high)
                bounds.append((np.where(has, lo, 1)[:, None], np.where(has, hi, 0)[:, None]))
            for at in range(0, len(cell.id), TILE_ROWS):
                part = slice(at, at + TILE_ROWS)
                scores = products(m, cell.m[part])
                other = (cell.label[part] != label[:, None]) & (cell.null[part] | (cell.id[part] != ids[:, None]))
                for h, (lo, hi) in zip(heaps, bounds):
                    _meet(h, scores, other & (scores >= lo) & (scores <= hi), at)
            for r, h in enumerate(heaps):
                yield pa.RecordBatch.from_arrays(
                    [block.column("uid").take(pa.array(h.owner)), pa.array(np.full(len(h.owner), r, np.int32)),
                     pa.array(cell.id[h.at], mask=cell.null[h.at]), pa.array(h.score)], ["uid", "place", "other", "score"])

    return run


# -- the operator -----------------------------------------------------------

def prepare(df: DataFrame, vec_id: str, vector: str, label: F.Column, scale: int) -> DataFrame:
    """``id, label, ints, dim`` of the rows that take part."""
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return (df.select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"),
                      F.col(vector).cast("array<double>").alias("x"))
            .filter(F.col("label").isNotNull() & F.col("x").isNotNull()).filter(finite)
            .select("id", "label", F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c)).alias("ints"))
            .withColumn("dim", F.size("ints")))


def mine(df: DataFrame, is_anchor: F.Column, vec_id: str = "vec_id", vector: str = "embedding", label: F.Column | None = None,
         scale: int = 256, positives: int = 5, negatives: int = 10, low: tuple[int, int] = (3, 10),
         high: tuple[int, int] = (9, 10)) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for every row with ``is_anchor`` and each of its best
    ``positives`` rows of the same label, the best ``negatives`` rows of other
    labels whose score is between the fractions ``low`` and ``high`` of the
    positive's."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    label = F.col("label") if label is None else label
    rows = prepare(df, vec_id, vector, label, scale)
    asked = (prepare(df.filter(is_anchor & F.col(vec_id).isNotNull()), vec_id, vector, label, scale).distinct()
             .withColumn("uid", F.sha2(F.concat_ws(",", "id", "label", F.col("ints").cast("array<string>")), 256)))
    size = rows.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    fits = max(1, CELL_BYTES // (8 * max(1, size["dim"] or 1)))  # rows of a cell
    cells = max(-(-size["n"] // fits), min(parts, -(-size["n"] // MIN_CELL_ROWS)), 1)
    dealt = rows.select("dim", F.pmod(F.xxhash64("id", "label", "ints", F.spark_partition_id()), F.lit(cells)).alias("cell"),
                        F.lit(0).alias("kind"), "id", "label", "ints")

    def in_cells(anchors: DataFrame, task, schema: str) -> DataFrame:
        everywhere = anchors.withColumns({"cell": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))), "kind": F.lit(1)})
        return (dealt.unionByName(everywhere, allowMissingColumns=True).repartition(max(parts, min(cells, 4 * parts)), "dim", "cell")
                .sortWithinPartitions("dim", "cell", "kind").mapInArrow(task, schema))

    def ranked(found: DataFrame, *owner: str) -> F.Column:
        return F.row_number().over(Window.partitionBy(*owner).orderBy(F.col("score").desc(), F.col("other").asc_nulls_last()))

    near = in_cells(asked, best_positives(positives), "uid string, other long, score long")
    near = near.withColumn("place", ranked(near, "uid")).filter(F.col("place") <= positives)
    # at most ``positives`` rows an anchor
    lists = near.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("place", "other", "score"))).alias("near"))
    anchors = checkpointed(asked.join(lists, "uid").withColumn("scores", F.col("near.score")))
    far = in_cells(anchors.drop("near"), best_negatives(negatives, low, high), "uid string, place int, other long, score long")
    far = far.withColumn("rank", ranked(far, "uid", "place")).filter(F.col("rank") <= negatives)
    got = far.join(anchors.select("uid", F.col("id").alias("anchor_id"), "near"), "uid")
    mine_ = F.element_at("near", F.col("place") + 1)
    return got.select("anchor_id", mine_["other"].alias("positive_id"), "rank", F.col("other").alias("negative_id"),
                      mine_["score"].alias("positive_score"), F.col("score").alias("negative_score"))
