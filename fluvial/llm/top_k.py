"""Exact top-k inner-product search by ball-tree branch and bound.

The vectors are dealt into shards. A task builds a ball tree over each shard it gets: a node knows the centre c and radius
r of its vectors, and no inner product with a query q can exceed q.c + |q| r. Pairs of query and node are bounded level by
level from the root; a pair whose bound lies under the query's current k-th score is dropped with all below it. The leaves
that are left are visited best bound first, all queries of a round at once, and the k-th scores rise as they go. They are
shared: from one shard of a task to the next, and by all tasks at the start, since each block of queries is scored on the
driver against one bounded sample of vectors first, whose k-th score is a floor for the k-th score over all.

Queries go in blocks of bounded size, each broadcast by itself and matched in a scan of the shards, which are dealt out and written once.

Scores are exact: components are whole numbers and sums are taken in doubles where every partial sum stays below 2 ** 53,
else in 64-bit integers; a score that doesn't fit into a long is an error. Bounds are widened by a relative 1e-9, so rounding never
drops a pair; equal scores go to the smaller id, since only bounds strictly under the k-th score are dropped.

Vectors that are null or hold a null or non-finite component take no part, as query or candidate, nor do rows without an id.
Shorter vectors count as padded with zeros; an empty vector is all zeros. Rows are told apart by a number of their own: each row
that repeats an id is a query, if its id is one, and a candidate for all others, its twins too. Of rows with equal ids and scores,
either stands first. Fewer candidates than k give all. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvial.llm.common import materialize, partitions

K = 5
SCALE = 256
#: Rows of a shard's tree; leaves of a tree hold up to LEAF.
SHARD = 16_384
LEAF = 128
#: Queries of one pass over the table.
BLOCK = 4_096
#: Vectors, those of the least hashed ids, that give the first k-th scores.
SAMPLE = 2_048


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (whole numbers, as doubles) of the rows of vectors(vec_id, embedding) that take part."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    v = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * float(scale)).cast("double"))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(F.col("embedding").cast("array<double>"), good))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of numbers, padded with zeros to the longest."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact."""
    n = min(q.shape[1], x.shape[1])
    q, x = q[:, :n], x[:, :n]
    most = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(n, 1)
    if most < 2**53:
        return (q @ x.T).astype(np.int64)
    if most < 2**63 and np.abs(q).max(initial=0) < 2**63 and np.abs(x).max(initial=0) < 2**63:
        return q.astype(np.int64) @ x.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    return (whole(q) @ whole(x).T).astype(np.int64) if n else np.zeros((len(q), len(x)), np.int64)


class BallTree:
    """A balanced tree over the rows of x: halves along the coordinate of the widest spread."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(x))
        self.levels: list[list[tuple[int, int]]] = [[(0, len(x))]]
        while max(e - s for s, e in self.levels[-1]) > leaf:
            nodes = []
            for s, e in self.levels[-1]:
                part = self.order[s:e]
                rows = x[part]
                axis = int(np.argmax(rows.var(axis=0))) if rows.shape[1] else 0
                middle = (e - s) // 2
                if rows.shape[1]:
                    self.order[s:e] = part[np.argpartition(rows[:, axis], middle)]
                nodes += [(s, s + middle), (s + middle, e)]
            self.levels.append(nodes)
        self.balls = []
        for nodes in self.levels:
            centres = np.stack([x[self.order[s:e]].mean(axis=0) for s, e in nodes])
            radii = np.array([np.sqrt(((x[self.order[s:e]] - c) ** 2).sum(axis=1).max()) for (s, e), c in zip(nodes, centres, strict=True)])
            self.balls.append((centres, radii))

    def leaf_bounds(self, q: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Upper bounds of every query with every leaf; minus infinity where the leaf or a node above it is under the query's floor."""
        norm, alive = np.sqrt((q**2).sum(axis=1)), np.ones((len(q), 1), bool)
        for depth, (centres, radii) in enumerate(self.balls):
            if depth:
                alive = np.repeat(alive, 2, axis=1)
            rows = np.flatnonzero(alive.any(axis=1))
            bound = np.full(alive.shape, -np.inf)
            n = min(q.shape[1], centres.shape[1])
            raw = q[rows, :n] @ centres[:, :n].T + norm[rows, None] * radii
            slack = 1e-9 * (norm[rows, None] * (np.sqrt((centres**2).sum(axis=1)) + radii)) + 1e-6
            bound[rows] = np.where(alive[rows], raw + slack, -np.inf)
            alive = bound >= floor[:, None]
            bound[~alive] = -np.inf
        return bound


class Best:
    """The k best (score, smaller id first) of each query so far."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.score = np.full((queries, k), np.iinfo(np.int64).min, np.int64)
        self.id = np.full((queries, k), np.iinfo(np.int64).max, np.int64)
        self.found = np.zeros((queries, k), bool)
        self.floor = floor  # at or under the k-th score over all candidates

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> None:
        k = self.score.shape[1]
        low = np.iinfo(np.int64).min
        score = np.concatenate([self.score[rows], np.where(valid, scores, low)], axis=1)
        ident = np.concatenate([self.id[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        found = np.concatenate([self.found[rows], valid], axis=1)
        order = np.lexsort((ident, -score.astype(np.float64) if np.abs(score[found]).max(initial=0) < 2**53 else ~score, ~found), axis=1)[:, :k]
        self.score[rows] = np.take_along_axis(score, order, 1)
        self.id[rows] = np.take_along_axis(ident, order, 1)
        self.found[rows] = np.take_along_axis(found, order, 1)
        full = self.found[rows, -1]
        self.floor[rows[full]] = np.maximum(self.floor[rows[full]], self.score[rows[full], -1].astype(np.float64))


def search_shard(q: np.ndarray, q_rows: np.ndarray, x: np.ndarray, rows_x: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """Improve best by the rows of one shard, given with their numbers and ids."""
    tree = BallTree(x)
    bounds = tree.leaf_bounds(q, best.floor)
    visit = np.argsort(-bounds, axis=1)
    leaves = tree.levels[-1]
    for turn in range(len(leaves)):
        leaf = visit[:, turn]
        active = np.flatnonzero(bounds[np.arange(len(q)), leaf] >= np.where(np.isneginf(best.floor), -1.7e308, best.floor))
        if not len(active):
            break
        by_leaf = active[np.argsort(leaf[active], kind="stable")]
        for rows in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
            s, e = leaves[leaf[rows[0]]]
            members = tree.order[s:e]
            best.add(rows, products(q[rows], x[members]), ids[members], rows_x[members] != q_rows[rows, None])


def _blocks(queries: DataFrame, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(numbers, ids, vectors) of up to size queries each, streamed through the driver."""
    held: list = []
    for row in queries.toLocalIterator():
        held.append(row)
        if len(held) == size:
            yield _block(held)
            held = []
    if held:
        yield _block(held)


def _block(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = max((len(r.v) for r in rows), default=0)
    numbers, ids = np.array([r.row_no for r in rows], np.int64), np.array([r.vec_id for r in rows], np.int64)
    return numbers, ids, np.array([list(r.v) + [0.0] * (width - len(r.v)) for r in rows]).reshape(len(rows), width)


def top_k(vectors: DataFrame, is_query: Column, *, k: int = K, scale: int = SCALE, block: int = BLOCK, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of vectors(vec_id, embedding) for each row where is_query holds."""
    spark = vectors.sparkSession
    rows = usable(vectors, scale).repartition(partitions(spark)).withColumn("row_no", F.monotonically_increasing_id())
    rows = materialize(rows, "shards")
    s_numbers, s_ids, s_rows = _block(rows.orderBy(F.xxhash64("vec_id"), "row_no").limit(sample).collect())
    out = None
    for q_rows, q_ids, q in _blocks(rows.where(is_query), block):
        first = Best(len(q), k, np.full(len(q), -np.inf))
        for at in range(0, len(q), 512):
            part = np.arange(at, min(at + 512, len(q)))
            if len(s_numbers):
                first.add(part, products(q[part], s_rows), s_ids, s_numbers != q_rows[part, None])
        shared = spark.sparkContext.broadcast((q_rows, q_ids, q, first.floor))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            q_rows, q_ids, q, floor = shared.value
            best = Best(len(q), k, floor.copy())
            held, n = [], 0
            for batch in batches:
                for at in range(0, len(batch), shard):
                    held.append(batch.slice(at, shard))
                    n += len(held[-1])
                    if n >= shard:
                        _search(held, q, q_rows, best)
                        held, n = [], 0
            if n:
                _search(held, q, q_rows, best)
            at, rank = np.nonzero(best.found)
            yield pa.RecordBatch.from_arrays([pa.array(q_rows[at]), pa.array(q_ids[at]), pa.array(best.id[at, rank]), pa.array(best.score[at, rank])], ["query_row", "query_id", "vec_id", "score"])

        found = rows.select("row_no", "vec_id", "v").mapInArrow(run, "query_row long, query_id long, vec_id long, score long")
        out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(held: list[pa.RecordBatch], q: np.ndarray, q_rows: np.ndarray, best: Best) -> None:
    batch = pa.concat_batches(held)
    if len(batch):
        search_shard(q, q_rows, matrix(batch.column("v")), batch.column("row_no").to_numpy(), batch.column("vec_id").to_numpy(), best)


#: The same in DuckDB's SQL, for vectors of one length.
ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
