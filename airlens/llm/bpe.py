"""Byte-level BPE encoding and decoding (operator 6) in numpy matrices.

A text is split by the vocabulary's pattern. Pieces that are tokens as they stand are
done; the others go, once per distinct piece, into matrices of byte ids, bucketed by
length so that padding stays below half. In each round every row of a matrix merges
its leftmost pair of smallest rank: pair ranks come from an open-addressing hash table
over (left id, right id), the row is compacted by one cell, only the two pairs beside
the merge are looked up again, and finished rows leave the matrix.

A piece longer than ``HEAP_BYTES`` (one unbroken run of letters, say) would need as many
rounds as it has bytes; it merges in the same order with a heap of pairs instead.

Cases: null is the empty text and gives no ids; very long texts are encoded whole, a
slice of pieces at a time; repeated rows and ties give the same ids; an empty table gives
an empty result; extra columns are left alone.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import groups, whole

HEAP_BYTES = 4096
CELLS = 1 << 20          # cells of one matrix
PIECES = 200_000         # pieces handled at once
CACHED = 400_000         # distinct pieces remembered by a task
NONE = np.int32(2**31 - 1)

RESULT = StructType([StructField("n_tokens", LongType(), False),
                     StructField("ids_sha256", StringType(), False),
                     StructField("decoded_sha256", StringType(), False)])


class Vocabulary:
    """Token bytes, byte ids and the pair table of a rank file."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, rank_file.splitlines()) if t}
        self.split = regex.compile(pattern)
        self.size = max(self.ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, rank = [], [], []
        for token, r in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self._hash(np.array(left, np.int64), np.array(right, np.int64), np.array(rank, np.int32))
        self.cache: dict[str, bytes] = {}

    def _hash(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> None:
        """Open addressing with linear probing; the table is at most a quarter full."""
        bits = max(8, int(4 * max(1, len(left)) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_key = np.full(1 << bits, -1, np.int64)
        self.slot_rank = np.full(1 << bits, NONE, np.int32)
        key = left * self.size + right
        at, todo = self._home(key), np.arange(len(key))
        while len(todo):
            free = self.slot_key[at[todo]] < 0
            _, first = np.unique(at[todo][free], return_index=True)
            won = todo[free][first]
            self.slot_key[at[won]] = key[won]
            self.slot_rank[at[won]] = rank[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            at[todo] = (at[todo] + 1) & self.mask

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, ``NONE`` where it makes none; any shape."""
        key = (left.astype(np.int64) * self.size + right).ravel()
        at = self._home(key)
        out = np.full(len(key), NONE, np.int32)
        found = self.slot_key[at]
        hit = found == key
        out[hit] = self.slot_rank[at[hit]]
        todo = np.flatnonzero(~hit & (found >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            found = self.slot_key[at[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.slot_rank[at[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out.reshape(left.shape)

    def merge_matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of like length: all rows merge one pair a round."""
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        width = int(lengths.max())
        ids = np.zeros((n, width), np.int32)
        inside = np.arange(width) < lengths[:, None]
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full((n, width), NONE, np.int32)  # of the pair that starts at the cell
        pairs = inside[:, 1:]
        rank[:, :-1][pairs] = self.pair_ranks(ids[:, :-1][pairs], ids[:, 1:][pairs])
        rows, out = np.arange(n), [None] * n
        while True:
            at = rank.argmin(axis=1)  # the first of equal ranks is the leftmost
            best = rank[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                for k in np.flatnonzero(done):
                    out[rows[k]] = ids[k, :lengths[k]].astype("<u4")
                go = ~done
                if not go.any():
                    return out
                rows, lengths, at, best = rows[go], lengths[go], at[go], best[go]
                width = int(lengths.max())
                ids, rank = ids[go, :width], rank[go, :width]
            each, cells = np.arange(len(rows)), np.arange(width - 1)
            moved = cells + (cells > at[:, None])  # the cell after the merge goes
            ids[each, at] = best
            ids, rank = np.take_along_axis(ids, moved, 1), np.take_along_axis(rank, moved, 1)
            lengths = lengths - 1
            width -= 1
            for side in (at - 1, at):  # only pairs that hold the new token change
                ok = (side >= 0) & (side + 1 < lengths)
                r, c = each[ok], side[ok]
                rank[r, c] = self.pair_ranks(ids[r, c], ids[r, c + 1])
            last = lengths - 1
            rank[each, last] = NONE

    def merge_heap(self, piece: bytes) -> np.ndarray:
        """Ids of one very long piece, in the same merge order, in n log n steps."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        first = self.pair_ranks(ids[:-1], ids[1:])
        heap = [(int(first[k]), int(k)) for k in np.flatnonzero(first != NONE)]
        heapq.heapify(heap)
        token, n = ids.tolist(), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = first.tolist() + [int(NONE)]
        cached: dict[tuple[int, int], int] = {}

        def pair(a: int, b: int) -> int:
            if (a, b) not in cached:
                cached[a, b] = self.ranks.get(self.tokens[a] + self.tokens[b], int(NONE))
            return cached[a, b]

        while heap:
            best, k = heapq.heappop(heap)
            if rank[k] != best:  # an entry from before a merge beside it
                continue
            gone = after[k]
            token[k], after[k] = best, after[gone]
            rank[gone] = -1
            if after[k] < n:
                before[after[k]] = k
            for left in (before[k], k):
                if left >= 0:
                    rank[left] = pair(token[left], token[after[left]]) if after[left] < n else int(NONE)
                    if rank[left] != NONE:
                        heapq.heappush(heap, (rank[left], left))
        out, k = [], 0
        while k < n:
            out.append(token[k])
            k = after[k]
        return np.array(out, "<u4")

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of pieces into the cache."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8")
            known = self.ranks.get(raw)
            if known is not None:
                self.cache[piece] = known.to_bytes(4, "little")
            elif len(raw) > HEAP_BYTES:
                self.cache[piece] = self.merge_heap(raw).tobytes()
            else:
                buckets.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for bits, members in buckets.items():
            rows = max(1, CELLS >> bits)
            for k in range(0, len(members), rows):
                part = members[k:k + rows]
                for (piece, _), ids in zip(part, self.merge_matrix([raw for _, raw in part])):
                    self.cache[piece] = ids.tobytes()

    def encode(self, pieces: list[str]) -> bytes:
        """Ids of a split text as little-endian unsigned 32-bit integers."""
        out = []
        for k in range(0, len(pieces), PIECES):
            part = pieces[k:k + PIECES]
            new = set(part).difference(self.cache)
            if new:
                if len(self.cache) + len(new) > CACHED:
                    self.cache.clear()
                    new = set(part)
                self.learn(new)
            out.append(b"".join(map(self.cache.__getitem__, part)))
        return out[0] if len(out) == 1 else b"".join(out)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of several texts; their new pieces are learned together, so that matrices are full."""
        split = [self.split.findall(t) for t in texts]
        new = set().union(*split).difference(self.cache)
        if new and len(self.cache) + len(new) <= CACHED:
            self.learn(new)
        return [self.encode(pieces) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[bytes, Vocabulary] = {}


def load_vocabulary(rank_file: bytes, pattern: str) -> Vocabulary:
    """The vocabulary of a rank file, built once per process."""
    key = hashlib.sha256(rank_file + pattern.encode()).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(rank_file, pattern)
    return _LOADED[key]


def share_rank_file(spark: SparkSession, path: str) -> Broadcast:
    """The rank file (a megabyte, fixed by the vocabulary) for all executors."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encoded(text: Column, ranks: Broadcast, pattern: str) -> Column:
    """Array of token ids of a text column (null: the empty text)."""
    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = load_vocabulary(ranks.value, pattern)
        for texts in batches:
            yield pd.Series([np.frombuffer(i, "<u4").astype(np.int32)
                             for group in groups(list(texts)) for i in v.encode_all(group)], dtype=object)
        v.cache.clear()     # a worker that other stages use next keeps the vocabulary only

    return ids(whole(text))


def decoded(ids: Column, ranks: Broadcast, pattern: str) -> Column:
    """Bytes of an array of token ids (null: no bytes); an unknown id fails the job."""
    @F.pandas_udf("binary")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = load_vocabulary(ranks.value, pattern)
        for arrays in batches:
            yield pd.Series([b"" if a is None else b"".join(map(v.tokens.__getitem__, map(int, a))) for a in arrays],
                            dtype=object)

    return raw(ids)


def round_trip(text: Column, ranks: Broadcast, pattern: str) -> Column:
    """Struct ``RESULT``: number of ids, digest of the ids, digest of the bytes they decode to."""
    @F.pandas_udf(RESULT)
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v = load_vocabulary(ranks.value, pattern)
        for texts in batches:
            rows = [
                (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(v.decode(ids)).hexdigest())
                for group in groups(list(texts)) for ids in v.encode_all(group)
            ]
            yield pd.DataFrame(rows, columns=RESULT.names)
        v.cache.clear()

    return digests(whole(text))


def token_report(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``RESULT`` for each row of ``docs``."""
    ranks = share_rank_file(docs.sparkSession, path)
    return docs.select(F.col(key).alias("doc_id"), round_trip(F.col(text), ranks, pattern).alias("t")).select(
        "doc_id", "t.*")
