"""Exact top-k inner products with a KD-tree in each shard of the vectors.

Vectors are dealt to shards by a hash of their id. In a task, a shard's vectors get a KD-tree:
median splits along the widest axis down to small leaves, every node with its tight bounding box and
its smallest id. A query walks the tree best first, by the largest inner product that a box allows,
and stops at a box that cannot better the k-th score it holds. That k-th score is propagated: a first
pass over one shard alone gives every query a bound with which it enters all the others. Queries and
shards meet in blocks; each block pair returns k rows a query at most.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import stage
from .common import ship

SHARD_ROWS, QUERY_ROWS, LEAF = 4096, 512, 64
SCALE = 256


class KdTree:
    """Median-split tree over integer vectors; boxes, smallest ids and leaf ranges of all nodes in arrays."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.kids, self.span, todo = [(-1, -1)], [(0, len(ids))], [0]
        while todo:
            node = todo.pop()
            lo, hi = self.span[node]
            if hi - lo <= LEAF:
                continue
            block = points[order[lo:hi]]
            axis = int(np.argmax(block.max(0) - block.min(0))) if block.shape[1] else 0
            keys = block[:, axis] if block.shape[1] else np.zeros(hi - lo)
            order[lo:hi] = order[lo:hi][np.argsort(keys, kind="stable")]
            mid = (lo + hi) // 2
            self.kids[node] = (len(self.kids), len(self.kids) + 1)
            for part in ((lo, mid), (mid, hi)):
                todo.append(len(self.kids))
                self.kids.append((-1, -1))
                self.span.append(part)
        self.ids, self.points = ids[order], points[order]
        self.low = np.array([self.points[a:b].min(0) for a, b in self.span])
        self.high = np.array([self.points[a:b].max(0) for a, b in self.span])
        self.least_id = np.array([self.ids[a:b].min() for a, b in self.span])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product of each query with a point of each node's box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query_id: int, query: np.ndarray, bound: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The k best (score, -id) of the tree, apart from those below the floor score."""
        best: list[tuple[int, int]] = []
        heap = [(-bound[0], 0)]
        while heap:
            top, node = heapq.heappop(heap)
            if len(best) == k and (-top < best[0][0] or -top == best[0][0] and -self.least_id[node] < best[0][1]):
                if -top < best[0][0]:
                    break
                continue
            if floor is not None and -top < floor:
                break
            left, right = self.kids[node]
            if left >= 0:
                heapq.heappush(heap, (-bound[left], left))
                heapq.heappush(heap, (-bound[right], right))
                continue
            a, b = self.span[node]
            scores = self.points[a:b] @ query
            least = best[0][0] if len(best) == k else floor
            at = np.flatnonzero(scores >= least) if least is not None else np.arange(b - a)
            at = at[self.ids[a:b][at] != query_id]                 # however often the query's own id is repeated
            if len(at) > 4 * k:
                at = at[np.lexsort((self.ids[a:b][at], -scores[at]))][:k]
            for i in at:
                found = (int(scores[i]), -int(self.ids[a + i]))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return best


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return np.asarray(flat.flatten(), np.int64).reshape(len(flat), -1)


def _search(k: int):
    def run(key: tuple[pa.Scalar, ...], queries: pa.Table, points: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if queries.num_rows and points.num_rows:
            tree = KdTree(points.column("vec_id").to_numpy(), _matrix(points.column("v")))
            wanted = _matrix(queries.column("v"))
            bound = tree.bounds(wanted)
            for i, (qid, floor) in enumerate(zip(queries.column("query_id").to_pylist(), queries.column("floor").to_pylist())):
                out += [(qid, -m, s) for s, m in tree.search(qid, wanted[i], bound[i], k, floor)]
        cols = np.array(out, np.int64).reshape(-1, 3)
        return pa.table({"query_id": cols[:, 0], "vec_id": cols[:, 1], "score": cols[:, 2]})
    return run


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v, dim): components floor(256 x); vectors that are null or hold null, NaN or infinity are left out."""
    v = F.col(vector_col).cast("array<double>")
    good = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(good & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x * SCALE).cast("long")).alias("v"),
        F.size(v).alias("dim"))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by `every`, its k highest integer inner products.

    Candidates are all rows of the same dimension but those of the query's own id; ties go to the
    smaller id, repeated vectors all count. Fewer than k candidates: all of them. An empty table gives
    no rows. Scores must fit in 64 bits.
    """
    spark = vectors.sparkSession
    ship(spark)
    points = stage(quantised(vectors, id_col, vector_col), "vectors")
    n = points.count()
    shards = max(1, -(-n // SHARD_ROWS))
    points = points.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    queries = points.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v", "dim").dropDuplicates()
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))

    def met(asked: DataFrame, held: DataFrame, shard_ids) -> DataFrame:
        left = asked.withColumn("shard", F.explode(shard_ids)).select("block", "shard", "dim", "query_id", "v", "floor")
        right = held.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).select(
            "block", "shard", "dim", "vec_id", "v")
        return left.groupBy("block", "shard", "dim").cogroup(
            right.toDF(*right.columns).groupBy("block", "shard", "dim")).applyInArrow(_search(k), "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = stage(met(queries.withColumn("floor", F.lit(None).cast("long")), points.where("shard = 0"),
                      F.array(F.lit(0).cast("long"))), "first")
    floor = first.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("floor"))
    found = first
    if shards > 1:
        rest = queries.join(floor, "query_id", "left").select("query_id", "v", "dim", "block", "floor")
        found = found.union(met(rest, points.where("shard > 0"),
                                F.sequence(F.lit(1).cast("long"), F.lit(shards - 1).cast("long"))))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest scores of every fiftieth vector."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) q from embeddings
  where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id query_id, b.vec_id, cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) as bigint) score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)
), ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""
