"""Operator 1: exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into buckets cut at quantiles of the length; a
bucket that many vectors of one length make too large is dealt to several
cells by a hash of the id. A first threshold for each query comes from the
longest vectors (a bounded number); it rules out every bucket whose longest
vector times the query's length stays below it. What remains meets in cells of
one bucket part and one block of queries. In a cell candidates stream in, the
longest first, and the threshold rises. For each block of candidates the local
cosine threshold - the score to beat over the product of lengths - decides:
where it is high, candidates are pruned by the query's largest coordinates and
a bound on the rest, else by their length alone. Scores of what is left are
exact products; ties go to the smaller id.

Vectors that are null or hold null, NaN or infinite components take no part;
those of different sizes are not compared. Rows with a null id are no queries,
and as candidates come after all ids. A query's candidates are all rows with
another id; repeated rows count each, as query and as candidate. Products are
exact beyond 2^53 too (then without BLAS), and cut to the range of a long.
Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Length buckets at most; rows of a cell; queries of a cell.
BUCKETS, CELL_ROWS, MIN_CELL_ROWS, CELL_QUERIES = 256, 1 << 18, 2048, 1 << 14
#: Longest vectors that give the first threshold.
SEEDS = 1024
#: From this local cosine threshold on, coordinates prune; so many of them.
COORDINATE_COSINE, FOCUS = 0.8, 8
#: Candidates and queries multiplied at once.
BLOCK, QUERY_BLOCK = 4096, 512
_LONG = (1 << 63) - 1


def prepare(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """``id, ints, norm2, dim`` of the vectors that take part."""
    x = F.col(vector).cast("array<double>")
    # null if any component is null, as then one comparison is null
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    ints = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c))
    return (df.filter(F.col(vector).isNotNull()).filter(finite)
            .select(F.col(vec_id).cast("long").alias("id"), ints.alias("ints"))
            .withColumn("norm2", F.aggregate("ints", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))
            .withColumn("dim", F.size("ints")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dim)


class Best:
    """The ``k`` best (score, id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.q, self.score = np.empty(0, np.int64), np.empty(0, np.int64)
        self.id, self.null = np.empty(0, np.int64), np.empty(0, bool)
        self.floor = np.full(n, -np.inf)

    def add(self, q, score, ids, null) -> None:
        wide = score.dtype == object or self.score.dtype == object
        q, score = np.concatenate([self.q, q]), np.concatenate([self.score, score])
        ids, null = np.concatenate([self.id, ids]), np.concatenate([self.null, null])
        if wide:  # Python's integers
            order = np.array(sorted(range(len(q)), key=lambda i: (q[i], -score[i], null[i], ids[i])), np.int64)
        else:
            order = np.lexsort((ids, null, -score, q))
        q, score, ids, null = q[order], score[order], ids[order], null[order]
        first = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.empty(0, bool)
        place = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
        keep = place < self.k
        self.q, self.score, self.id, self.null = q[keep], score[keep], ids[keep], null[keep]
        last = place == self.k - 1
        self.floor[q[last]] = score[last].astype(np.float64)


class Cell:
    """Queries of one cell, and their best candidates."""

    def __init__(self, k: int):
        self.k, self.parts = k, []

    def ready(self) -> None:
        self.uid, self.id, self.m, self.floor0 = (np.concatenate(x) for x in zip(*self.parts))
        self.f = self.m.astype(np.float64)
        self.norm = np.sqrt((self.f * self.f).sum(1))
        self.top = np.abs(self.f).max(initial=0)
        self.best = Best(len(self.id), self.k)
        self.best.floor = self.floor0.astype(np.float64)
        self.focus = np.argsort(-np.abs(self.f), axis=1)[:, :FOCUS]

    def meet(self, ids: np.ndarray, null: np.ndarray, m: np.ndarray) -> None:
        """Candidates, the longest first."""
        for lo in range(0, len(ids), BLOCK):
            part = slice(lo, lo + BLOCK)
            order = np.lexsort((ids[part], null[part]))  # ties by id
            self._block(ids[part][order], null[part][order], m[part][order])

    def _block(self, ids, null, m) -> None:
        f = m.astype(np.float64)
        norm = np.sqrt((f * f).sum(1))
        longest = norm.max(initial=0)
        slack = 1 + 1e-9
        reach = self.norm * longest * slack
        live = np.flatnonzero(self.best.floor <= reach)
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(reach[live] > 0, self.best.floor[live] / reach[live], 0)
        exact = self.top * np.abs(f).max(initial=0) * max(1, m.shape[1]) < 2**53
        sharp = cosine >= COORDINATE_COSINE
        for q in live[sharp]:
            self._score(np.array([q]), self._by_coordinates(q, f, norm, slack), ids, null, m, f, exact)
        rest = live[~sharp]
        for lo in range(0, len(rest), QUERY_BLOCK):
            q = rest[lo:lo + QUERY_BLOCK]
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(self.norm[q] > 0, self.best.floor[q] / self.norm[q], -np.inf).min()
            self._score(q, np.flatnonzero(norm * slack >= need), ids, null, m, f, exact)

    def _by_coordinates(self, q: int, f, norm, slack) -> np.ndarray:
        """Candidates whose product over the query's largest coordinates, and
        the most the others can add, reach the query's floor."""
        at = self.focus[q]
        part = f[:, at] @ self.f[q, at]
        p_rest = np.sqrt(np.maximum(0, norm ** 2 - (f[:, at] ** 2).sum(1)) + 1)
        q_rest = math.sqrt(max(0.0, self.norm[q] ** 2 - (self.f[q, at] ** 2).sum()) + 1)
        return np.flatnonzero(part + p_rest * q_rest * slack + 1 >= self.best.floor[q])

    def _score(self, q, keep, ids, null, m, f, exact) -> None:
        if not len(q) or not len(keep):
            return
        ids, null = ids[keep], null[keep]
        if exact:
            s = self.f[q] @ f[keep].T
        else:
            s = np.clip(self.m[q].astype(object) @ m[keep].T.astype(object), -_LONG - 1, _LONG)
        own = (self.id[q][:, None] == ids[None, :]) & ~null[None, :]
        floor = self.best.floor[q].copy()
        rough = np.where(own, -np.inf, s.astype(np.float64))
        if rough.shape[1] >= self.k:  # nothing below this block's k-th best matters
            floor = np.maximum(floor, np.partition(rough, -self.k, axis=1)[:, -self.k])
        if exact:
            over = rough > floor[:, None]
            tie = (rough == floor[:, None]) & ~own
            over |= tie & (np.cumsum(tie, 1) <= self.k)  # candidates stand by id
        else:
            over = (rough >= floor[:, None]) & ~own
        i, j = np.nonzero(over)
        if len(i):
            score = s[i, j].astype(np.int64) if exact else s[i, j]
            self.best.add(q[i], score, ids[j], null[j])

    def rows(self) -> pa.RecordBatch:
        b = self.best
        return pa.RecordBatch.from_arrays(
            [pa.array(self.uid[b.q].astype(str), pa.string()), pa.array(self.id[b.q], pa.int64()),
             pa.array(b.id, pa.int64(), mask=b.null), pa.array(b.score.astype(np.int64), pa.int64())],
            ["uid", "query_id", "vec_id", "score"])


def top_k(df: DataFrame, is_query: F.Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
          scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row with ``is_query`` the
    ``k`` rows of other ids with the highest inner product of
    ``floor(scale * x)``."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cand = prepare(df, vec_id, vector, scale)
    asked = prepare(df.filter(is_query & F.col(vec_id).isNotNull()), vec_id, vector, scale)
    # equal rows ask the same: once, with the number of copies
    asked = (asked.groupBy("id", "ints", "norm2", "dim").agg(F.count("*").alias("copies"))
             .withColumn("uid", F.md5(F.concat_ws(",", F.col("id"), F.col("ints").cast("array<string>")))))
    got = cand.agg(F.count("*").alias("n"), F.percentile_approx(
        "norm2", [i / BUCKETS for i in range(1, BUCKETS)], 10_000).alias("cuts")).first()
    n, cuts = got["n"], sorted(set(got["cuts"] or []))
    bucket = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("norm2"))) if cuts else F.lit(0)
    cand = cand.withColumn("b", bucket)
    cell_rows = min(CELL_ROWS, max(MIN_CELL_ROWS, -(-n // parts)))
    known = cand.groupBy("b").agg(F.count("*").alias("n"), F.max("norm2").alias("longest")).collect()  # BUCKETS rows at most
    # neighbouring small buckets share a cell, a large one is dealt to several
    layout, group, filled = {}, -1, cell_rows
    for r in sorted(known, key=lambda r: -r["b"]):
        if filled + r["n"] > cell_rows:
            group, filled = group + 1, 0
        filled += r["n"]
        layout[r["b"]] = (group, -(-r["n"] // cell_rows), math.sqrt(r["longest"]))
    blocks = max(1, -(-asked.count() // CELL_QUERIES))
    seeds = [(r["id"], r["ints"]) for r in cand.orderBy(F.col("norm2").desc(), "id").limit(SEEDS).select("id", "ints").collect()]
    spread, goal = spark.sparkContext.broadcast(layout), spark.sparkContext.broadcast(seeds)

    def aim(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """First thresholds, and the cells that each query has to see."""
        by_dim: dict[int, list] = {}
        for i, v in goal.value:
            by_dim.setdefault(len(v), []).append((i, v))
        groups: dict[int, tuple[int, float]] = {}
        for g, copies, longest in spread.value.values():
            c, top = groups.get(g, (1, 0.0))
            groups[g] = max(c, copies), max(top, longest)
        for batch in batches:
            q_id, norm = np.asarray(batch.column("id")), np.sqrt(np.asarray(batch.column("norm2")))
            vectors = batch.column("ints").to_pylist()
            rows, cells, floors = [], [], []
            for r, v in enumerate(vectors):
                near = _near(v, [w for i, w in by_dim.get(len(v), []) if i != q_id[r]])
                floor = float(near[k - 1]) if len(near) >= k else -math.inf
                for g, (copies, longest) in groups.items():
                    if norm[r] * longest * (1 + 1e-9) >= floor:
                        rows += [r] * copies
                        cells += [g << 28 | s for s in range(copies)]
                        floors += [floor] * copies
            out = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [out.column("dim"), pa.array(cells, pa.int64()), out.column("block"), pa.array(np.zeros(len(rows), np.int32)),
                 out.column("norm2"), out.column("id"), out.column("ints"), out.column("uid"), pa.array(floors, pa.float64())], names)

    names = ["dim", "cell", "block", "kind", "norm2", "id", "ints", "uid", "floor"]
    schema = "dim int, cell bigint, block bigint, kind int, norm2 double, id bigint, ints array<bigint>, uid string, floor double"
    aimed = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).select(
        "dim", "block", "norm2", "id", "ints", "uid").repartition(parts, "uid").mapInArrow(aim, schema)
    group_of = F.element_at(F.create_map(*[F.lit(x) for b, (g, _, _) in layout.items() for x in (b, g)] or [F.lit(-1), F.lit(0)]), F.col("b"))
    copies_of = F.element_at(F.create_map(*[F.lit(x) for b, (_, c, _) in layout.items() for x in (b, c)] or [F.lit(-1), F.lit(1)]), F.col("b"))
    placed = cand.select(
        "dim", (F.shiftleft(group_of.cast("long"), 28) + F.pmod(F.xxhash64("id", "ints"), copies_of.cast("long"))).alias("cell"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.lit(1).alias("kind"), "norm2", "id", "ints", F.lit(None).cast("string").alias("uid"), F.lit(0.0).alias("floor"))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cell, asking = None, None, False
        for batch in batches:
            key = np.stack([np.asarray(batch.column(c)) for c in ("dim", "cell", "block", "kind")], 1)
            if not len(key):
                continue
            edges = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(key)]):
                here, kind = tuple(key[lo][:3]), key[lo][3]
                if here != at:
                    if cell is not None and not asking:
                        yield cell.rows()
                    at, cell, asking = here, None, True
                part = batch.slice(lo, hi - lo)
                m = _matrix(part.column("ints"), int(here[0]))
                if kind == 0:
                    cell = cell or Cell(k)
                    cell.parts.append((part.column("uid").to_numpy(zero_copy_only=False), np.asarray(part.column("id")),
                                       m, np.asarray(part.column("floor"))))
                elif cell is not None:
                    if asking:
                        cell.ready()
                        asking = False
                    null = np.asarray(part.column("id").is_null())
                    cell.meet(np.asarray(part.column("id").fill_null(_LONG)), null, m)
        if cell is not None and not asking:
            yield cell.rows()

    both = aimed.unionByName(placed)
    found = (both.repartition(parts, "dim", "cell", "block")
             .sortWithinPartitions("dim", "cell", "block", "kind", F.col("norm2").desc())
             .mapInArrow(search, "uid string, query_id bigint, vec_id bigint, score bigint"))
    best = F.row_number().over(Window.partitionBy("uid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    ranked = found.withColumn("rank", best).filter(F.col("rank") <= k)
    copies = asked.filter("copies > 1").select(F.col("uid").alias("u"), "copies")
    return (ranked.join(copies, F.col("uid") == F.col("u"), "left")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1).cast("long")))))
            .select("query_id", "rank", "vec_id", "score"))


def _near(v: list[int], others: list[list[int]]) -> np.ndarray:
    """Lower bounds of the products with ``others``, the highest first."""
    if not others:
        return np.empty(0)
    a, b = np.array(v, np.float64), np.array(others, np.float64)
    s = b @ a
    s -= 1e-12 * (np.abs(b) @ np.abs(a)) * (np.abs(s) >= 2**53)
    return -np.sort(-s)
