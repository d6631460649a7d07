"""Near-duplicate vectors (operator 11): pivot-permutation index, shared-pivot counts, exact check.

Reference points (pivots) are vectors of the table, taken by the digest of their id out of a sample
of ``SAMPLE`` times their number: twice the root of the number of vectors, as many as fit in ``PIVOT_VALUES``
numbers at most. No two are closer than the cosine ``APART``, so that a large group of near copies lies round one
pivot and does not fill the descriptions with its own members. Each vector is described by its ``DEPTH`` nearest pivots in order (cosine, then the smaller number). An inverted list
holds, for one label and pivot, the vectors that have this pivot among the first ``LISTED`` of their
description. Two vectors of a list are candidates if their descriptions share at least ``SHARED`` pivots;
the cosine of candidates is computed in double precision and decides alone.

A long list is split into blocks of about ``BLOCK_ROWS`` vectors and a task takes two of them, so the work
on a large group is spread and nothing is cut off. In a task the shared pivots are counted through the
postings of its own rows; a pair is looked at in the list of the smallest pivot that both have among their
first, so once in all. Pairs never leave the task: it returns, for each vector with links, how
many it found and the smallest vector that they reach there, from which the components follow.

Equal vectors of a label are one node with a number of copies. The index is approximate (vectors
that share too few pivots are missed); recall against brute force is measured in the tests and the README.

Cases: a vector that is null, empty, zero or holds null or non-finite components, or whose label is null,
links with nothing; vectors of different length never link; rows that repeat a vec_id are one vector, the
usable one with the smallest (label, components), and give one row; rows without vec_id are returned
with null component and kept; a cosine equal to the threshold links; very large and very small components
are scaled before they are squared; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType

from .common import ranges, written
from .graph import components, lowest_reachable
from .topk_blocks import usable

COSINE = 0.98
DEPTH = 12
LISTED = 6
SHARED = 3
LEAST_PIVOTS = 64
PIVOT_VALUES = 1 << 20
SAMPLE = 4
APART = 0.9
BLOCK_ROWS = 1024
BUNDLE_BLOCKS = 4
CHUNK = 1 << 20


@F.pandas_udf(BinaryType())
def _unit(vectors: pd.Series) -> pd.Series:
    """Each vector at length one, as bytes of doubles."""
    out = []
    for v in vectors:
        v = np.asarray(v, np.float64)
        v = v / np.abs(v).max() + 0.0
        out.append((v / np.sqrt(v @ v)).tobytes())
    return pd.Series(out, dtype=object)


def fit_pivots(nodes: DataFrame) -> np.ndarray:
    """The pivots, one a row; shorter vectors are filled up with zeros."""
    n, length = nodes.agg(F.count("*"), F.max(F.length("unit"))).first()
    if not n:
        return np.zeros((1, 1))
    wanted = max(LEAST_PIVOTS, min(2 * isqrt(n), PIVOT_VALUES * 8 // length))
    drawn = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE * wanted).select("unit").collect()
    drawn = [np.frombuffer(r["unit"], np.float64) for r in drawn]
    pivots, taken = np.zeros((wanted, max(map(len, drawn)))), 0
    for v in drawn:
        if taken < wanted and (pivots[:taken, :len(v)] @ v < APART).all():
            pivots[taken, :len(v)] = v
            taken += 1
    return pivots[:taken]


def nearest(units: list[bytes], pivots: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The numbers of each vector's nearest pivots in order; beyond the pivots' length components are not read."""
    v = np.zeros((len(units), pivots.shape[1]))
    for row, unit in zip(v, units):
        x = np.frombuffer(unit, np.float64)[:len(row)]
        row[:len(x)] = x
    depth = min(depth, len(pivots))
    out = np.zeros((len(v), depth), np.int32)
    step = max(1, CHUNK // len(pivots))
    for k in range(0, len(v), step):
        # rounded, so that equal distances are equal whatever the block of the product
        close = np.round(v[k:k + step] @ pivots.T, 12)
        out[k:k + step] = np.argsort(-close, axis=1, kind="stable")[:, :depth]
    return out


def described(nodes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``nodes`` with ``near``, the ordered description (bytes of pivot numbers), and ``pivots``, the first of it."""
    shared = nodes.sparkSession.sparkContext.broadcast(pivots)   # at most PIVOT_VALUES numbers

    @F.pandas_udf("near binary, pivots array<int>")
    def near(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for units in batches:
            found = nearest(list(units), shared.value)
            yield pd.DataFrame({"near": [row.tobytes() for row in found], "pivots": list(found[:, :LISTED])})

    return nodes.withColumn("d", near("unit")).select(*nodes.columns, "d.near", "d.pivots")


def links_in_cell(pivot: int, node: np.ndarray, copies: np.ndarray, block: np.ndarray, near: np.ndarray,
                  unit: np.ndarray, cosine: float = COSINE) -> pd.DataFrame:
    """node, root, links: what the candidates of one pair of blocks of the list of ``pivot`` come to."""
    n, depth = near.shape
    order = np.argsort(node, kind="stable")
    node, copies, block, near, unit = node[order], copies[order], block[order], near[order], unit[order]
    known, code = np.unique(near, return_inverse=True)
    code = code.reshape(n, depth)
    held = np.bincount(code.ravel(), minlength=len(known))
    owner = np.argsort(code.ravel(), kind="stable") // depth
    start = np.cumsum(held) - held
    first = near[:, :LISTED]
    two = block.min() != block.max()
    needed = min(SHARED, depth)
    a, b = [], []
    for x in np.flatnonzero(block == block.min()) if two else range(n):
        shared = np.bincount(owner[ranges(start[code[x]], held[code[x]])], minlength=n)
        y = np.flatnonzero(shared >= needed)
        y = y[block[y] != block[x]] if two else y[y > x]
        if not len(y):
            continue
        earlier = first[x][first[x] < pivot]
        if len(earlier):
            y = y[~np.isin(first[y], earlier).any(axis=1)]
        y = y[unit[y] @ unit[x] >= cosine]
        a.append(np.full(len(y), x))
        b.append(y)
    a, b = (np.concatenate(k).astype(np.int64) if k else np.zeros(0, np.int64) for k in (a, b))
    links = np.zeros(n, np.int64)
    np.add.at(links, a, copies[b])
    np.add.at(links, b, copies[a])
    root = node[lowest_reachable(n, a, b)]
    some = links > 0
    return pd.DataFrame({"node": node[some], "root": root[some], "links": links[some]})


def found_links(index: DataFrame, cosine: float = COSINE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """node, root, links: one row for each vector with links in a cell; ``index`` has label, node, copies, unit, near."""
    listed = index.withColumn("dim", F.length("unit")).withColumn("pivot", F.explode("pivots")).drop("pivots")
    keys = ["label", "dim", "pivot"]
    lists = written(listed.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(
        *keys, F.ceil(F.col("n") / block_rows).cast("int").alias("parts"), "n"), "lists")
    rows = lists.agg(F.sum(F.col("n") * F.col("parts"))).first()[0] or 0
    bundles = max(1, rows // (BUNDLE_BLOCKS * block_rows))
    placed = listed.join(lists.drop("n"), keys).withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        *keys, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "node", "copies", "block", "near", "unit")

    def bundle(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, _, pivot, _, _), cell in rows.groupby([*keys, "low", "high"], sort=False):
            out.append(links_in_cell(
                int(pivot), cell["node"].to_numpy(np.int64), cell["copies"].to_numpy(np.int64),
                cell["block"].to_numpy(np.int64), np.frombuffer(b"".join(cell["near"]), np.int32).reshape(len(cell), -1),
                np.frombuffer(b"".join(cell["unit"]), np.float64).reshape(len(cell), -1), cosine))
        return pd.concat(out)

    # short lists share a task's call
    number = F.pmod(F.xxhash64(*keys, "low", "high"), F.lit(bundles)).alias("bundle")
    return cells.groupBy(number).applyInPandas(bundle, "node long, root long, links long")


def linked_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                   cosine: float = COSINE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept for each vector of ``table``."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
                        F.col(vector).cast("array<double>").alias("v"))
    not_zero: Column = F.exists("v", lambda x: x != 0)
    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"))).where(not_zero)
    one = good.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x")).select("vec_id", "x.*")
    units = written(one.select("vec_id", "label", _unit("v").alias("unit")), "units")
    keyed = units.withColumn("digest", F.md5("unit"))
    groups = keyed.groupBy("label", "digest").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("unit").alias("unit"))
    nodes = written(groups, "nodes")
    own = keyed.select("vec_id", "label", "digest").join(nodes.select("label", "digest", "node", "copies"),
                                                         ["label", "digest"]).select("vec_id", "node", "copies")
    index = written(described(nodes.select("label", "node", "copies", "unit"), fit_pivots(nodes)), "index")
    found = written(found_links(index, cosine, block_rows), "found")
    reached = components(found.select(F.col("root").alias("a"), F.col("node").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    told = own.join(links, "node", "left").join(reached, "node", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "node").alias("c"))
    ids = rows.select("vec_id").where("vec_id is not null").distinct()
    out = ids.join(told, "vec_id", "left").unionByName(
        rows.where("vec_id is null").select("vec_id", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("c")))
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                     F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


#: All pairs and what they reach: the exact answer, of which the index has to find nine tenths at least.
ORACLE_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, r.low AS component_id, e.vec_id = r.low AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) r ON r.a = e.vec_id
"""
