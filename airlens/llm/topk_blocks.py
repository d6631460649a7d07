"""Exact top-k search (operator 4): block-at-a-time pruning over integer vectors.

Components become integers, floor(256 * x). Vectors are put in an order that keeps alike ones
together (sign codes of fixed random projections, then id), and consecutive ranges of them
form blocks; a block stores its ids, its vectors (the forward index) and the largest and
smallest value of each component. For a query the sum over components of the better of
query * max and query * min bounds every score in the block.

Blocks lie in shards, queries in groups. A task takes one group and one shard: each query
goes through the shard's blocks by falling bound, scores a block against its forward index, and
stops when the next bound falls below its k-th score (or equals it, with only larger
ids left). The best of all shards are merged per query. A task holds one shard and one
group, whose sizes are parameters; nothing is broadcast.

Cases: vectors that are null, empty or hold null or non-finite components take no part, nor do
those whose length differs from ``dim`` (by default the most frequent length, the larger of
equals); rows that repeat a vec_id count once, with the smallest vector; a query's own id is
never a candidate; ties go to the smaller id; with fewer candidates than k all are returned; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

SCALE = 256
BLOCK_ROWS = 64
SHARD_ROWS = 4096
GROUP_QUERIES = 512
SIGN_BITS = 24
LEAST = np.iinfo(np.int64).min + 1  # its negative is a number, too
LAST = np.iinfo(np.int64).max


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def place(dim: int) -> Column:
    """Sign code of fixed random projections of the vector ``v``."""
    plane = np.random.default_rng(0).standard_normal((dim, SIGN_BITS))

    @F.pandas_udf("long")
    def code(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype="int64")
        bits = np.stack(vectors.to_list()).astype(np.float64) @ plane > 0
        return pd.Series(bits @ (1 << np.arange(SIGN_BITS)[::-1]))

    return code("v")


def blocks_of(vectors: DataFrame, dim: int, rows: int = BLOCK_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index: shard, ids, forward, high, low (64-bit integers as bytes), one row per block of (vec_id, v)."""
    n = vectors.count()
    shards = max(1, -(-n // shard_rows))
    ordered = vectors.withColumn("place", place(dim)).repartitionByRange(shards, "place", "vec_id").sortWithinPartitions(
        "place", "vec_id")

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, ids, v = TaskContext.get().partitionId(), np.zeros(0, np.int64), np.zeros((0, dim), np.int64)
        for last, f in _with_last(frames):
            if f is not None and len(f):
                ids = np.concatenate([ids, f["vec_id"].to_numpy(np.int64)])
                v = np.concatenate([v, np.stack(f["v"].to_list()).astype(np.int64)])
            full = len(ids) if last else len(ids) // rows * rows
            out = []
            for k in range(0, full, rows):
                i, m = ids[k:min(k + rows, full)], v[k:min(k + rows, full)]
                out.append((shard, i.tobytes(), m.tobytes(), m.max(axis=0).tobytes(), m.min(axis=0).tobytes()))
            ids, v = ids[full:], v[full:]
            if out:
                yield pd.DataFrame(out, columns=["shard", "ids", "forward", "high", "low"])

    return ordered.select("vec_id", "v").mapInPandas(
        pack, "shard int, ids binary, forward binary, high binary, low binary")


def _with_last(frames: Iterator) -> Iterator:
    for f in frames:
        yield False, f
    yield True, None


class Shard:
    """Blocks side by side: bounds of all of them, forward indexes one at a time."""

    def __init__(self, blocks: pd.DataFrame, dim: int):
        self.ids = [np.frombuffer(b, np.int64) for b in blocks["ids"]]
        self.forward = [np.frombuffer(b, np.int64).reshape(-1, dim) for b in blocks["forward"]]
        self.high = np.stack([np.frombuffer(b, np.int64) for b in blocks["high"]])
        self.low = np.stack([np.frombuffer(b, np.int64) for b in blocks["low"]])
        self.first = np.array([i.min() for i in self.ids])
        self.largest = int(max(abs(int(self.high.max())), abs(int(self.low.min()))))
        self.scored = 0

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids), k of each query, best first; places that nobody took have the id ``LAST``."""
        # floating-point products are exact below 2^53; beyond, integers do the work
        exact = float(self.largest) * float(np.abs(q).max()) * q.shape[1] < 2**52
        kind = np.float64 if exact else np.int64
        qk = q.astype(kind)
        bound = (np.maximum(qk, 0) @ self.high.T.astype(kind) + np.minimum(qk, 0) @ self.low.T.astype(kind))
        bound = bound.astype(np.int64)
        order = np.lexsort((np.broadcast_to(self.first, bound.shape), -bound), axis=1)
        score = np.full((len(q), k), LEAST)
        found = np.full((len(q), k), LAST)
        active = np.arange(len(q))
        for step in range(len(self.ids)):
            block = order[active, step]
            b, worst = bound[active, block], score[active, k - 1]
            go = (b > worst) | ((b == worst) & (self.first[block] < found[active, k - 1]))
            active, block = active[go], block[go]
            if not len(active):
                break
            by_block = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[by_block])) + 1
            for part in np.split(by_block, cuts):
                rows, at = active[part], block[part[0]]
                s = (qk[rows] @ self.forward[at].T.astype(kind)).astype(np.int64)
                own = self.ids[at][None, :] == query_ids[rows][:, None]
                s[own] = LEAST
                self.scored += s.size
                better = (s >= score[rows, k - 1][:, None]).any(axis=1)
                rows, s, own = rows[better], s[better], own[better]
                if not len(rows):
                    continue
                ids = np.where(own, LAST, self.ids[at][None, :])
                all_s, all_i = np.concatenate([score[rows], s], axis=1), np.concatenate([found[rows], ids], axis=1)
                best = np.lexsort((all_i, -all_s), axis=1)[:, :k]
                score[rows], found[rows] = np.take_along_axis(all_s, best, 1), np.take_along_axis(all_i, best, 1)
        return score, found


def search(index: DataFrame, queries: DataFrame, dim: int, k: int = 5,
           group_queries: int = GROUP_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of the index for each of ``queries`` (vec_id, v)."""
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    groups = max(1, -(-queries.count() // group_queries))
    # a stated query set against all rows, in blocks: each (group, shard) cell is a task's work
    left = (
        queries.select(F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("grp"),
                       F.col("vec_id").alias("query_id"), "v")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    right = index.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def cell(q: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(q) or not len(blocks):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
        ids = q["query_id"].to_numpy(np.int64)
        score, found = Shard(blocks, dim).search(ids, np.stack(q["v"].to_list()).astype(np.int64), k)
        taken = found != LAST
        return pd.DataFrame({"query_id": np.repeat(ids, taken.sum(axis=1)), "vec_id": found[taken],
                             "score": score[taken]})

    best = left.groupBy("grp", "shard").cogroup(right.groupBy("grp", "shard")).applyInPandas(
        cell, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def top_scores(table: DataFrame, every: int = 50, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
               dim: int | None = None) -> DataFrame:
    """The k best rows for each row whose id is divisible by ``every``."""
    v = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(
        F.col("vec_id").isNotNull() & usable(F.col("v")))
    if dim is None:
        common = v.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
        dim = common["dim"] if common else 1
    v = v.where(F.size("v") == dim).groupBy("vec_id").agg(F.min("v").alias("v"))
    v = written(v.select("vec_id", integers(F.col("v")).alias("v")), "vectors")
    index = written(blocks_of(v, dim), "blocks")
    return search(index, v.where(F.col("vec_id") % every == 0), dim, k)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum([z[1] * z[2] FOR z IN list_zip(q.v, c.v)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
