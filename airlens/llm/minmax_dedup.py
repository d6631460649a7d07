"""Near-duplicate documents (operator 7): min-max hashing, banding, exact confirmation.

A document's set holds the 64-bit hashes of its distinct shingles of ``width`` words. Each of
``PERMUTATIONS`` hash functions gives two signature values, the smallest and the largest; both
agree between two sets with the probability of their Jaccard similarity, so half the
hash evaluations give the same signature length, with less variance. Bands of
``ROWS`` values make a document's keys; at similarity 0.8 two documents share none of the
32 keys with a probability below 5e-8.

Documents with one set are one node, named by the smallest id. The smallest node of each group of nodes with a
common key is the group's hub. Every node is compared, on full sets, with the smallest of its hubs; then, in groups
that hold several components still, with the hubs of other components. Nodes that the confirmed links
join already need no more, so large groups of copies cost one comparison for each member. Where a
group still falls into several components, a link that does not touch the hub could be missing: all
nodes of such groups that overlap are joined by their full sets, across components, in blocks of
about ``CELL_SHINGLES`` shingles. A task takes two blocks, finds common shingles through postings and
returns links only, never pairs that fail.

Cases: a text of any length is one set (its hashes are taken in chunks; memory holds the set once); of equal
sizes or similarities nothing is chosen, the smallest id names a group; null and empty texts have an empty set and link with nothing; texts with fewer words than
``width`` have one shingle; rows that repeat an id are one document (its texts are linked through it); a null id links
with nothing and is its own, null component; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import WORD, groups, ranges, roughly_in, whole, written
from .graph import components

PERMUTATIONS = 64
ROWS = 4
WIDTH = 4
PERCENT = 80
CHUNK = 1 << 14
CACHED = 300_000
CELL_SHINGLES = 1 << 19
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(UPPER, LOWER)
_RANDOM = np.random.default_rng(20_240_607)
_A = _RANDOM.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)

FEATURES = StructType([StructField("n", LongType(), False), StructField("digest", BinaryType(), False),
                       StructField("bands", ArrayType(LongType(), False), False)])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """64-bit word hashes that are the same in every process, remembered up to ``CACHED`` words."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __getitem__(self, word: str) -> int:
        h = self.known.get(word)
        if h is None:
            if len(self.known) >= CACHED:
                self.known.clear()
            h = int.from_bytes(hashlib.blake2b(word.encode("utf-8"), digest_size=8).digest(), "little")
            self.known[word] = h
        return h


def shingles(text: str, words: Words, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    found = WORD.findall(text.translate(_TO_LOWER) if text.isascii() is False else text.lower())
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    size = min(width, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = out * _BASE + _mix(h[k:len(h) - size + 1 + k] + np.uint64(k))
    return np.unique(_mix(out))


def signature(s: np.ndarray) -> np.ndarray:
    """Smallest values under every hash function, then the largest ones."""
    low, high = None, None
    for k in range(0, len(s), CHUNK):
        v = s[k:k + CHUNK][None, :] * _A[:, None] + _B[:, None]
        a, b = v.min(axis=1), v.max(axis=1)
        low = a if low is None else np.minimum(low, a)
        high = b if high is None else np.maximum(high, b)
    return np.concatenate([low, high])


def band_keys(s: np.ndarray) -> np.ndarray:
    if not len(s):
        return np.zeros(0, np.int64)
    rows = _mix(signature(s)).reshape(-1, ROWS)
    key = np.arange(len(rows), dtype=np.uint64)
    for k in range(ROWS):
        key = _mix(key * _BASE + rows[:, k])
    return key.view(np.int64)


@F.pandas_udf(FEATURES)
def _features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    words = Words()
    for batch in batches:
        for texts in groups(list(batch)):     # sets are larger than their texts: a group's are held at once
            sets = [shingles(t, words) for t in texts]
            yield pd.DataFrame({
                "n": np.array([len(s) for s in sets], np.int64),
                "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                "bands": [band_keys(s) for s in sets],
            })


@F.pandas_udf(ArrayType(LongType(), False))
def _sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    words = Words()
    for batch in batches:
        for texts in groups(list(batch)):
            yield pd.Series([shingles(t, words).view(np.int64) for t in texts], dtype=object)


def alike(a: Column, b: Column, n_a: Column, n_b: Column, percent: int = PERCENT) -> Column:
    both = F.size(F.array_intersect(a, b)).cast("long")
    return 100 * both >= percent * (n_a + n_b - both)


def sizes_allow(n_a: Column, n_b: Column, percent: int = PERCENT) -> Column:
    """No two sets whose sizes fail this can be similar enough."""
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, s: the sets of ``nodes`` (distinct); ``docs`` has node, text."""
    texts = roughly_in(docs, F.col("node"), nodes, F.col("node")).join(nodes, "node", "left_semi")
    return written(texts.select("node", _sets(F.col("text")).alias("s")), "sets")


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The distinct ``pairs`` (a, b) of node ids whose full sets are similar enough; ``docs`` has node, text."""
    pairs = written(pairs, "pairs")
    sets = full_sets(docs, pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct())
    x = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("s_a")), "a")
    x = x.join(sets.select(F.col("node").alias("b"), F.col("s").alias("s_b")), "b")
    good = x.where(alike(F.col("s_a"), F.col("s_b"), F.size("s_a"), F.size("s_b")))
    return written(good.select("a", "b").distinct(), "links")


def links_in_cell(node: np.ndarray, component: np.ndarray, block: np.ndarray, sets: list[np.ndarray]) -> list[tuple]:
    """Links between nodes of different components (and blocks, if the cell has two), as many as it takes to join
    the components that links of the cell join: fewer than there are components.

    One end of such a link lies outside the cell's largest component, so only those nodes look for the other.
    """
    size = np.array([len(s) for s in sets])
    shingle, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    held = np.bincount(code, minlength=len(shingle))
    posting = owner[np.argsort(code, kind="stable")]
    start = np.cumsum(held) - held
    first = np.cumsum(size) - size
    label, members = np.unique(component, return_inverse=True, return_counts=True)[1:]
    anchor, two = np.flatnonzero(label == members.argmax())[0], block.min() != block.max()
    out = []
    for x in np.flatnonzero(label != label[anchor]):
        if label[x] == label[anchor]:
            continue    # joined by now; whoever else is missing looks for itself
        codes = code[first[x]:first[x] + size[x]]
        codes = codes[held[codes] > 1]
        both = np.bincount(posting[ranges(start[codes], held[codes])], minlength=len(sets))
        good = (100 * both >= PERCENT * (size[x] + size - both)) & (both > 0) & (label != label[x])
        if two:
            good &= block != block[x]
        found = np.flatnonzero(good)
        for y in found[np.unique(label[found], return_index=True)[1]]:
            out.append((min(node[x], node[y]), max(node[x], node[y])))
            label[label == label[y]] = label[x]
    return out


def links_across(open_: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between components among the nodes of groups (key, node, n, component) that hold several.

    Groups that share components form one cluster, so that each node's set is there once for each of the
    cluster's blocks; the clusters are found over components, not nodes.
    """
    lowest = open_.groupBy("key").agg(F.min("component").alias("a"))
    cluster = components(open_.select("key", "component").distinct().join(lowest, "key").select(
        "a", F.col("component").alias("b"))).select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    nodes = open_.select("node", "n", "component").distinct().join(cluster, "component")
    parts = nodes.groupBy("cluster").agg(
        F.greatest(F.ceil(F.sum("n") / CELL_SHINGLES), F.lit(1)).cast("int").alias("parts"))
    nodes = written(nodes.join(parts, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")), "clusters")
    placed = nodes.join(full_sets(docs, nodes.select("node").distinct()), "node").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = placed.select("cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                          "node", "component", "block", "s")

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        found = links_in_cell(rows["node"].to_numpy(np.int64), rows["component"].to_numpy(np.int64),
                              rows["block"].to_numpy(np.int64), [np.asarray(s, np.int64) for s in rows["s"]])
        return pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])

    return written(cells.groupBy("cluster", "low", "high").applyInPandas(cell, "a long, b long").distinct(), "links")


def still_open(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``groups`` whose key holds several components, with their own and their hub's."""
    placed = written(groups.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                      F.min_by("component", "node").alias("of_hub")).where("low <> high")
    return written(placed.join(split.select("key", "of_hub"), "key"), "open")


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """node, component after more links (a, b); what is joined already counts as one link for each node."""
    return components(labels.select(F.col("component").alias("a"), F.col("node").alias("b")).where("a <> b").unionAll(links))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row."""
    d = docs.select(F.col(key).cast("long").alias("doc_id"), whole(text).alias("text"))
    rows = written(d.select("doc_id", _features(F.col("text")).alias("f")).select("doc_id", "f.*"), "features")
    known = rows.where("n > 0 and doc_id is not null")
    nodes = known.groupBy("digest", "n").agg(F.min("doc_id").alias("node"))
    own = written(known.select("doc_id", "digest").distinct().join(nodes.select("digest", "node"), "digest")
                  .select("doc_id", "node"), "nodes")
    first = known.join(nodes.select("digest", F.col("node").alias("doc_id")), ["digest", "doc_id"], "left_semi")
    keyed = first.select(F.col("doc_id").alias("node"), "n", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min(F.struct("node", "n")).alias("hub"), F.count("*").alias("members")).where(
        "members > 1")
    groups = written(keyed.join(hubs, "key").select("key", "node", "n", "hub", "members"), "groups")
    texts = d.withColumnRenamed("doc_id", "node")

    # each node against the smallest of its groups' smallest only, then against those it is not joined with yet
    starred = groups.where(F.col("node") > F.col("hub.node")).where(sizes_allow(F.col("n"), F.col("hub.n")))
    links = confirmed(starred.groupBy(F.col("node").alias("b")).agg(F.min("hub.node").alias("a")).select("a", "b"), texts)
    labels = components(links)
    open_ = still_open(groups, labels)
    rest = open_.where(F.col("component") != F.col("of_hub")).where(F.col("node") > F.col("hub.node")).where(
        sizes_allow(F.col("n"), F.col("hub.n"))).select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct()
    labels = joined(labels, confirmed(rest, texts))

    # groups that the links did not join; of two nodes, the pair has just been compared
    more = links_across(still_open(groups.where("members > 2"), labels), texts)

    # an id with several texts is one document
    shared = own.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    again = own.join(shared.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b")).where("a <> b")
    labels = joined(labels, more.unionAll(again))
    of_doc = own.join(labels, "node", "left").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "node")).alias("component_id"))
    out = rows.join(of_doc, "doc_id", "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group (the smallest id), columns unchanged; rows without id stay."""
    gone = near_duplicates(docs, key, text).where("not kept").select(F.col("doc_id").alias("gone_")).distinct()
    return docs.join(gone, docs[key].cast("long") == gone["gone_"], "left_anti")
