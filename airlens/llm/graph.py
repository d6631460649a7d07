"""Connected components of link tables, and of the links inside one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of the undirected ``links`` (a, b long).

    Each round hooks every node to its smallest neighbour, if that is smaller than itself, follows the
    hooks to their roots and contracts: what is left are the distinct links between different roots. A
    group that hangs on few nodes is gone after one round, so its links are joined once or twice in all.
    Links with a null end and links of a node to itself say nothing.
    """
    edges = written(links.select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b"))
                    .where("a < b").distinct(), "edges")
    placed = None
    while placed is None or not edges.isEmpty():
        hooked = edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionAll(edges.select("a", "a"))
        roots = written(hooked.groupBy("node").agg(F.min("root").alias("root")), "hooks")
        while True:
            up = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
            higher = written(roots.join(up, "root").select("node", F.col("above").alias("root"),
                                                           (F.col("above") < F.col("root")).alias("moved")), "hooks")
            roots = higher.select("node", "root")
            if higher.where("moved").isEmpty():
                break
        to = roots.select(F.col("node").alias("old"), F.col("root").alias("new"))
        if placed is None:
            placed = roots
        else:
            placed = written(placed.join(to, placed["root"] == to["old"], "left").select(
                "node", F.coalesce("new", "root").alias("root")), "placed")
        for end in ("a", "b"):
            edges = edges.join(to, edges[end] == to["old"]).drop(end, "old").withColumnRenamed("new", end)
        edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
                        .distinct(), "edges")
    return placed.select("node", F.col("root").alias("component"))


def lowest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the smallest one it reaches over the undirected links a - b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
