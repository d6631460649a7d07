"""Quality rules (operator 9): word statistics and zstandard compression bands.

Text that repeats itself compresses too well, noise hardly at all. Both the whole
document and its fixed chunks are compressed; what ratio is normal depends on the
length, so each length band has limits of its own. A document is rejected when its
own ratio lies outside its band, or when more than ``MAX_BAD_CHUNKS`` of its full
chunks do.

Cases: a null or empty text has no words and fails the base rule; texts below
``CHUNK_BYTES`` have no full chunk and are judged as a whole; a ratio equal to a limit is within it, and a text as long as a band's end falls into the next band; very
long texts are compressed whole; repeated rows are judged alike, row by row; an empty table gives an empty result; extra columns are
left alone (results come as one struct column under a free name).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from .common import WORD, free_name, whole

LEVEL = 3
#: (bytes below, smallest ratio, largest ratio) of raw to compressed size
LENGTH_BANDS = (
    (256, 0.0, 6.0),
    (1024, 0.9, 3.0),
    (4096, 1.25, 3.2),
    (16384, 1.4, 3.6),
    (65536, 1.5, 4.2),
    (float("inf"), 1.5, 5.0),
)
CHUNK_BYTES = 2048
CHUNK_BAND = (1.15, 4.0)
MAX_BAD_CHUNKS = 0.25
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
WINDOW = 8

RESULT = StructType(
    [StructField(n, LongType(), False) for n in
     ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [StructField("base_failed", BooleanType(), False), StructField("kept", BooleanType(), False),
       StructField("ratio", DoubleType(), False), StructField("n_chunks", LongType(), False),
       StructField("n_bad_chunks", LongType(), False)]
)

_STEP = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words lying in a window of ``window`` words that occurs at least twice (each occurrence counts)."""
    n = len(words)
    if n <= window:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    roll = np.zeros(n - window + 1, np.uint64)
    for k in range(window):  # a polynomial over 64-bit word hashes, modulo 2^64
        roll = roll * _STEP + (h[k:n - window + 1 + k] ^ (h[k:n - window + 1 + k] >> np.uint64(29)))
    order = np.argsort(roll, kind="stable")
    ranked = roll[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(roll), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def duplicate_lines(text: str) -> int:
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif WORD.search(line):
            seen.add(line)
    return n


def in_band(raw: int, packed: int, low: float, high: float) -> bool:
    return low <= raw / packed <= high


def compression(raw: bytes, packer) -> tuple[bool, float, int, int]:
    """(within all limits, whole ratio, full chunks, chunks outside their limits)."""
    if not raw:
        return True, 0.0, 0, 0
    packed = len(packer.compress(raw))
    low, high = next((lo, hi) for below, lo, hi in LENGTH_BANDS if len(raw) < below)
    n = len(raw) // CHUNK_BYTES
    view = memoryview(raw)
    bad = sum(
        not in_band(CHUNK_BYTES, len(packer.compress(view[k * CHUNK_BYTES:(k + 1) * CHUNK_BYTES])), *CHUNK_BAND)
        for k in range(n)
    )
    fine = in_band(len(raw), packed, low, high) and bad <= MAX_BAD_CHUNKS * n
    return fine, len(raw) / packed, n, bad


def judge(text: str, packer) -> tuple:
    """The fields of ``RESULT`` for one whole text."""
    words = WORD.findall(text)
    n = len(words)
    repeat = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    fine, ratio, chunks, bad = compression(text.encode("utf-8"), packer)
    return (n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeat,
            failed, fine and not failed, ratio, chunks, bad)


@F.pandas_udf(RESULT)
def _judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    packer = zstandard.ZstdCompressor(level=LEVEL)
    for texts in batches:
        yield pd.DataFrame([judge(t, packer) for t in texts], columns=RESULT.names)


def quality(text: str | Column = "text") -> Column:
    """Struct column with the statistics and the verdict of a text column."""
    return _judged(whole(text))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rejected documents, columns unchanged."""
    verdict = free_name(docs, "verdict")
    return docs.withColumn(verdict, quality(text)).where(F.col(verdict)["kept"]).drop(verdict)


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and all fields of ``RESULT``, one row per row of ``docs``."""
    return docs.select(F.col(key).alias("doc_id"), quality(text).alias("q")).select("doc_id", "q.*")
