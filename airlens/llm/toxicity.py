"""Toxicity (operator 1): subword-bag embeddings under a linear softmax, trained jointly.

A word is the mean of the vectors of its character n-grams and of itself (all hashed into
one table), so a misspelling that was never seen shares most of its vectors with the
words it resembles. A window of words is the mean of its words; a softmax over a linear map
of that mean gives the window's probability. A document scores as its worst window, so that
a few words in a very long text are not averaged away.

Table and linear map are trained together with Adam in numpy. The table starts from the
log-odds of the documents that hold a bucket. Labels are per document: each pass learns from
the window of each document that scores highest at the time (of clean documents, too, which
makes them hard negatives).

The fit uses a bounded sample of the labelled rows: at most ``per_class`` documents of each
label, of at most ``max_words`` words each, chosen by a hash of the text. Scoring reads
every document whole. Since map and mean are linear, a word's part in the score is one
number; the model sent to the executors is one float for each bucket.

Cases: null, empty and word-less texts score as a window without words (the bias alone);
repeated rows score alike and count once in the sample; documents of equal digest are drawn by id, texts by text; a
document's equally toxic windows are one score, and of them the first is learned from; without labelled rows of both classes every score is the
share of toxic labels (0 without any); an empty table gives an empty result; extra columns
are left alone; null labels are no labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD_PATTERN, groups, ranges, whole, written

#: Words as the model sees them: letters and digits, lower-cased.
TOKEN = re.compile(r"[^\W_]+")
CACHED = 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    dim: int = 8
    smallest: int = 3
    largest: int = 5
    window: int = 16
    stride: int = 8
    per_class: int = 2500
    max_words: int = 1500
    prior: float = 0.35
    epochs: int = 60
    rate: float = 0.05
    decay: float = 3e-5
    seed: int = 7
    threshold: float = 0.3


def subwords(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word numbers) of all subwords: each word itself and its n-grams, the ends marked.

    Hashes are polynomials over code points modulo 2^64, computed for all words at once.
    """
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    first = np.cumsum(length) - length
    word = np.repeat(np.arange(len(words)), length)
    left = np.repeat(first + length, length) - np.arange(len(code))  # code points up to the word's end
    power = np.cumprod(np.full(int(length.max()), _BASE, np.uint64))
    whole_word = np.add.reduceat(code * power[np.arange(len(code)) - np.repeat(first, length)], first)
    hashes, owners = [_mixed(whole_word)], [np.arange(len(words))]
    for n in range(s.smallest, s.largest + 1):
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * _BASE + code[at + k]
        hashes.append(_mixed(h))
        owners.append(word[at])
    return (np.concatenate(hashes) % np.uint64(s.buckets)).astype(np.int64), np.concatenate(owners)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def window_starts(n: int, s: Settings) -> np.ndarray:
    """Starts of overlapping windows that cover n words (one window if n is small)."""
    if n <= s.window:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - s.window, s.stride), n - s.window)


@dataclass
class Model:
    """A word's part is the mean of its buckets; a window's logit is the mean part plus the bias."""

    bucket_logits: np.ndarray
    bias: float
    settings: Settings

    def __post_init__(self):
        self.cache: dict[str, float] = {}

    def __getstate__(self):
        return {"bucket_logits": self.bucket_logits, "bias": self.bias, "settings": self.settings}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.cache = {}

    def word_logits(self, words: list[str]) -> np.ndarray:
        bucket, owner = subwords(words, self.settings)
        return (np.bincount(owner, self.bucket_logits[bucket], len(words)) / np.bincount(owner, minlength=len(words)))

    def scores(self, texts) -> np.ndarray:
        split = [TOKEN.findall(t.lower()) for t in texts]
        new = list(set().union(*split).difference(self.cache))
        if len(self.cache) + len(new) > CACHED:
            self.cache.clear()
            new = list(set().union(*split))
        if new:
            self.cache.update(zip(new, self.word_logits(new).tolist()))
        return np.array([self._logit(words) for words in split])

    def _logit(self, words: list[str]) -> float:
        logit, s = self.bias, self.settings
        if words:
            part = np.fromiter(map(self.cache.__getitem__, words), np.float64, len(words))
            part = part[np.append(True, part[1:] != part[:-1])]  # a run of one word counts once
            total = np.append(0.0, np.cumsum(part))
            start = window_starts(len(part), s)
            size = min(s.window, len(part))
            logit += float((total[start + size] - total[start]).max()) / size
        return float(1.0 / (1.0 + np.exp(-np.clip(logit, -40.0, 40.0))))

    def score(self, text: str) -> float:
        return float(self.scores([text])[0])


class _Adam:
    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, value: np.ndarray, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        value -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def _spread(values: np.ndarray, target: np.ndarray, size: int) -> np.ndarray:
    """Sum rows of ``values`` into ``size`` rows by ``target``."""
    return np.stack([np.bincount(target, values[:, k], size) for k in range(values.shape[1])], axis=1)


def train(texts: list[str], labels: list[int], s: Settings = Settings()) -> Model:
    """Fit the table and the softmax on a bounded sample."""
    y = np.asarray(labels, np.int64)
    if len(set(labels)) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(s.buckets, np.float32), float(np.log((share + 1e-9) / (1 - share + 1e-9))), s)
    ids: dict[str, int] = {}
    docs = []
    for t in texts:
        d = np.array([ids.setdefault(w, len(ids)) for w in TOKEN.findall(t.lower())], np.int64)
        docs.append(d[np.append(True, d[1:] != d[:-1])] if len(d) else np.zeros(1, np.int64))
    gram, of_word = subwords(list(ids) or [""], s)
    order = np.argsort(of_word, kind="stable")
    gram, of_word = gram[order], of_word[order]
    n_words = max(1, len(ids))
    n_grams = np.bincount(of_word, minlength=n_words)
    first = np.cumsum(n_grams) - n_grams

    # all windows of all documents, as ranges of one long word sequence
    sequence = np.concatenate(docs)
    length = np.array([len(d) for d in docs])
    begin = np.cumsum(length) - length
    starts = [b + window_starts(n, s) for b, n in zip(begin, length)]
    n_windows = np.array([len(w) for w in starts])
    start = np.concatenate(starts)
    size = np.minimum(s.window, np.repeat(length, n_windows))
    first_window = np.cumsum(n_windows) - n_windows
    of_window = np.repeat(np.arange(len(docs)), n_windows)

    # start: each bucket's vector points along the softmax by the log-odds of the documents that hold it
    held = np.zeros((2, s.buckets))
    for d, label in zip(docs, y):
        mark = np.zeros(s.buckets, bool)
        mark[gram[ranges(first[u := np.unique(d)], n_grams[u])]] = True
        held[label] += mark
    n = np.bincount(y, minlength=2)
    odds = np.log((held[1] + 1) / (n[1] + 2)) - np.log((held[0] + 1) / (n[0] + 2))
    rng = np.random.default_rng(s.seed)
    out = rng.normal(0, 1, s.dim)
    out /= np.linalg.norm(out)
    table = odds[:, None] * out + rng.normal(0, 0.05, (s.buckets, s.dim))
    out = np.stack([-out, out], axis=1)
    bias = np.zeros(2)
    steps = [_Adam(table.shape, s.rate), _Adam(out.shape, s.rate), _Adam(2, s.rate)]
    weight = np.where(y == 1, s.prior / n[1], (1 - s.prior) / n[0])

    for _ in range(s.epochs):
        logits = np.bincount(of_word, (table @ (out[:, 1] - out[:, 0]))[gram], n_words) / n_grams
        total = np.append(0.0, np.cumsum(logits[sequence]))
        mean_logit = (total[start + size] - total[start]) / size
        best = np.flatnonzero(mean_logit == np.maximum.reduceat(mean_logit, first_window)[of_window])
        best = best[np.unique(of_window[best], return_index=True)[1]]  # each document's worst window
        word, at = np.unique(sequence[ranges(start[best], size[best])], return_inverse=True)
        of_bag = np.repeat(np.arange(len(docs)), size[best])
        bucket = gram[ranges(first[word], n_grams[word])]
        within = np.repeat(np.arange(len(word)), n_grams[word])
        vectors = _spread(table[bucket], within, len(word)) / n_grams[word][:, None]
        mean = _spread(vectors[at], of_bag, len(docs)) / size[best][:, None]
        z = mean @ out + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1.0
        d_z = p * weight[:, None]
        d_mean = (d_z @ out.T) / size[best][:, None]
        d_word = _spread(d_mean[of_bag], at, len(word)) / n_grams[word][:, None]
        d_table = _spread(d_word[within], bucket, s.buckets) + s.decay * table
        steps[1].step(out, mean.T @ d_z)
        steps[2].step(bias, d_z.sum(axis=0))
        steps[0].step(table, d_table)
    return Model((table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]), s)


def training_sample(labelled: DataFrame, text: str, label: str, s: Settings) -> DataFrame:
    """At most ``per_class`` rows of either label, by a hash of the text; distinct texts of 1 to ``max_words`` words."""
    rows = labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label")).where(
        F.regexp_count("text", F.lit(WORD_PATTERN)).between(1, s.max_words)
    )
    parts = [
        rows.where(F.col("label") == k).groupBy("text").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("text"), "text").limit(s.per_class)
        for k in (0, 1)
    ]
    return parts[0].unionAll(parts[1])


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", s: Settings = Settings()) -> Model:
    """A model from labelled rows; what reaches the driver is bounded by ``s``."""
    rows = training_sample(labelled, text, label, s).toPandas()
    rows = rows.sort_values(["label", "text"])
    return train(rows["text"].tolist(), rows["label"].tolist(), s)


def toxicity(text: str | Column, model: Model, spark) -> Column:
    """Score of every whole text, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            yield pd.Series(np.concatenate([m.scores(group) for group in groups(list(texts))] or [np.zeros(0)]))

    return score(whole(text))


def score_report(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``; the model never sees held-out labels."""
    d = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    seen = labels.select("doc_id", "toxic").where(F.coalesce(remainder, F.lit(2)) != 2)
    # twice the sample, as some are too long; at most 4 * per_class small rows, so the texts need no shuffle
    drawn = [
        seen.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * s.per_class)
        for k in (0, 1)
    ]
    # stored, so that words are counted in the sample alone and the documents are read once for it
    sample = written(d.join(F.broadcast(drawn[0].unionAll(drawn[1]).distinct()), "doc_id"), "labelled")
    model = fit(sample, "text", "toxic", s)
    return d.select(
        "doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"),
        toxicity("text", model, docs.sparkSession).alias("score"),
    ).withColumn("predicted", (F.col("score") >= s.threshold).cast("int"))
