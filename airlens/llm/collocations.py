"""Phrase collocations (operator 13) by SON partitioning.

Texts become chunks of one language (a list of distinct words and a number for each word in order, 0 where a
piece ends), dealt into shards of about ``SHARD_WORDS`` words. A shard with the share w of its language's
words mines completely at the support ceil(SUPPORT * w): a phrase that is frequent in the whole reaches its proportional
support in at least one shard. Mining goes by length: words and pairs first, then 3, 4 and 5
words, each only where both parts that are one word shorter are still candidates. After each length the shards' reports
(ordered hashes and counts, packed by ranges of the hash) are put together range by range: a shard that is silent on a phrase holds at most its support less one of it, so a
phrase whose reported and possible silent occurrences stay below SUPPORT is no candidate anywhere; each shard gets back the
candidates among its own reports. Where shards are so many that their support is one, reports
are complete counts and nothing but frequent phrases goes on to the next length.

Then all candidates are counted globally: every shard counts the phrases of a bitmap of candidate hashes (sized by
their number, ``BITMAP_BITS`` at most) and sends the words themselves, so the sums are exact whatever the hashes;
a full bitmap costs shuffled rows, never results. Scores are decimals of 38 digits.

Only candidates' counts, never texts, are shuffled after the shards are written. A shard is one task's
work of bounded size: a hot language or source has more shards, a long text is cut into chunks where a piece ends.

Cases: null texts are empty, a null language is ``und``; texts without words add nothing; a piece
is never cut, however long; repeated rows count each; equal scores and counts are ranked by the phrase's
UTF-8 bytes; of cuts with one score the first counts; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import whole, written

SUPPORT = 100
LONGEST = 5
BEST = 2000
SHARD_WORDS = 1 << 21
CHUNK_WORDS = 1 << 18
BUCKET_WORDS = 1 << 24
BITMAP_BITS = 1 << 28
BITS_A_CANDIDATE = 64
STEP = 1 << 17
REPORT = pa.schema([("lang", pa.string()), ("length", pa.int32()), ("bucket", pa.int64()), ("hashes", pa.binary()),
                    ("more", pa.binary())])
COUNTS = pa.schema([("lang", pa.string()), ("length", pa.int32()), ("bucket", pa.int64()),
                    ("phrases", pa.list_(pa.field("element", pa.binary()))), ("counts", pa.binary())])
CHUNKS = "lang string, words array<binary>, codes binary, n long"
#: Separators become one sign, which no word holds after that.
_BREAK = bytes(ord(".") if chr(k) in ".,;:!?\n\x0b\x0c\r" else k for k in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Numbers(dict):
    """Words in the order of their first occurrence; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def words_and_breaks(text: bytes) -> list[bytes]:
    """A-Z lower-cased words in order, with ``.`` where a piece ends."""
    return text.lower().translate(_BREAK).replace(b".", b" . ").split()


def _chunk(lang: str, texts: list[list[bytes]]) -> tuple:
    numbers, parts = Numbers(), []
    for words in texts:
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        parts.append(np.zeros(1, np.int32))
    codes = np.concatenate(parts)
    codes = codes[(codes > 0) | np.r_[True, codes[:-1] > 0]]    # one break is enough
    return lang, list(numbers)[1:], codes.astype(_kind(len(numbers))).tobytes(), int((codes > 0).sum())


def _kind(numbers: int) -> type:
    return np.uint16 if numbers <= 1 << 16 else np.int32


def _portions(words: list[bytes], size: int) -> Iterator[list[bytes]]:
    """A long text in parts of at least ``size`` words, cut where a piece ends."""
    start = 0
    while len(words) - start > size:
        try:
            end = words.index(b".", start + size)
        except ValueError:
            break
        yield words[start:end]
        start = end
    yield words[start:]


def chunks(docs: DataFrame, text: str = "text", lang: str = "lang", chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """One row for each chunk: lang, words, codes, n (words in all)."""
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[str, list] = {}
        size: dict[str, int] = {}
        columns = ["lang", "words", "codes", "n"]
        for f in frames:
            for l, t in zip(f["lang"], f["text"]):
                for part in _portions(words_and_breaks(t), chunk_words):
                    if not part:
                        continue
                    waiting.setdefault(l, []).append(part)
                    size[l] = size.get(l, 0) + len(part)
                    if size[l] >= chunk_words:
                        yield pd.DataFrame([_chunk(l, waiting.pop(l))], columns=columns)
                        size[l] = 0
        for l, texts in waiting.items():
            yield pd.DataFrame([_chunk(l, texts)], columns=columns)

    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       whole(text).cast("binary").alias("text")).mapInPandas(pack, CHUNKS)


class Shard:
    """The words of a shard as hashes in order, and how many words follow in each word's piece.

    ``words`` (list<list<binary>>, a list for each chunk) and ``codes`` (binary) stay Arrow arrays: of the distinct words of one
    chunk at a time Python objects are made, and what is as long as the shard is worked on in portions of ``STEP`` places.
    """

    def __init__(self, words: pa.ListArray, codes: pa.BinaryArray):
        self.words = words.flatten()
        known = np.diff(words.offsets.to_numpy())
        kinds = [np.frombuffer(code.as_buffer(), _kind(n + 1)) for code, n in zip(codes, known.tolist())]
        size = sum(map(len, kinds))
        self.hash, self.left, self.word = np.empty(size, np.uint64), np.empty(size, np.int32), np.empty(size, np.int32)
        start = first = 0
        for code, n in zip(kinds, known.tolist()):
            own = np.zeros(n + 1, np.uint64)
            own[1:] = pd.util.hash_array(self.words.slice(first, n).to_numpy(zero_copy_only=False), categorize=False)
            end = start + len(code)
            self.hash[start:end] = own[code]
            self.word[start:end] = code
            self.word[start:end] += first - 1
            # a chunk ends with a piece: words up to the end of the piece
            place = np.arange(len(code), dtype=np.int32)
            ends = np.where(code > 0, np.int32(len(code)), place)
            self.left[start:end] = np.minimum.accumulate(ends[::-1])[::-1] - place
            start, first = end, first + n

    def places(self, length: int, shorter: np.ndarray | None = None) -> np.ndarray:
        """The places of phrases of ``length`` words (both of whose parts, one word shorter, are marked in ``shorter``)."""
        held = self.left >= length
        if shorter is not None:
            held &= shorter[:-1] & shorter[1:]
        return np.flatnonzero(held)

    def phrases(self, length: int, at: np.ndarray) -> np.ndarray:
        """The hash of the phrase of ``length`` words at each of the places ``at``."""
        out = np.empty(len(at), np.uint64)
        for a in range(0, len(at), STEP):
            part = at[a:a + STEP]
            h = np.full(len(part), length, np.uint64)
            for k in range(length):
                h = _mix(h * _BASE + self.hash[part + k])
            out[a:a + STEP] = h
        return out

    def held(self, length: int, at: np.ndarray, bits: Bits) -> np.ndarray:
        """Those of the places ``at`` whose phrase of ``length`` words has its bit set."""
        parts = [at[a:a + STEP] for a in range(0, len(at), STEP)]
        return np.concatenate([at[:0], *(part[bits.holds(self.phrases(length, part))] for part in parts)])

    def marked(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.hash) + 1, bool)
        out[at] = True
        return out

    def spelled(self, length: int, at: np.ndarray) -> pa.Array:
        words = [self.words.take(pa.array(self.word[at + k])) for k in range(length)]
        return pc.binary_join_element_wise(*words, b" ") if length > 1 else words[0]


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which ``values`` are among the sorted ``known``?"""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class Bits:
    """A bit for each candidate hash: what it lacks is no candidate."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    @classmethod
    def of(cls, candidates: DataFrame) -> Bits:
        """Gathered in Spark, a power of two of bits, at most BITMAP_BITS whatever the number of candidates."""
        bits = min(BITMAP_BITS, 1 << max(15, (BITS_A_CANDIDATE * candidates.count()).bit_length()))
        place = (F.col("hash").bitwiseAND(F.lit(bits - 1)) + 1).alias("place")
        parts = candidates.select(place).groupBy(F.bitmap_bucket_number("place").alias("part")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        out = np.zeros((bits >> 15, 4096), np.uint8)
        for r in parts.toLocalIterator():
            out[r["part"] - 1] = np.frombuffer(bytes(r["bits"]), np.uint8)
        return cls(out.ravel())

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & self.mask
        return (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def mine(shard: Shard, lengths: range, least: int, shorter: Bits | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, hashes in order, more) of the phrases of ``lengths`` with at least ``least`` occurrences; ``more`` is what
    they have beyond ``least`` - 1. ``shorter`` holds the candidates that are one word shorter than the first length."""
    known = shard.marked(shard.held(lengths[0] - 1, shard.places(lengths[0] - 1), shorter)) if lengths[0] > 1 else None
    for length in lengths:
        at = shard.places(length, known)
        h = shard.phrases(length, at)
        found, n = np.unique(h, return_counts=True)
        found, n = found[n >= least], n[n >= least]
        if length + 1 in lengths:
            known = shard.marked(np.concatenate([at[:0], *(
                at[a:a + STEP][_is_in(h[a:a + STEP], found)] for a in range(0, len(at), STEP))]))
        at = h = None
        yield length, found, n - (least - 1)


def bucket_ranges(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the ranges of ordered hashes; empty ranges are left out."""
    width = np.uint64(2**64 // buckets)
    ends = np.searchsorted(hashes, np.arange(1, buckets, dtype=np.uint64) * width)
    for k, (a, b) in enumerate(zip(np.r_[0, ends], np.r_[ends, len(hashes)])):
        if a < b:
            yield k, int(a), int(b)


def merged(key: tuple, rows: pd.DataFrame, support: int) -> pd.DataFrame:
    """length, hash of the phrases of a bucket that can be frequent: reported, and possibly silent, occurrences."""
    hashes = np.concatenate([np.frombuffer(b, np.uint64) for b in rows["hashes"]])
    more = np.concatenate([np.frombuffer(b, np.int64) for b in rows["more"]])
    order = np.argsort(hashes, kind="stable")
    hashes, more = hashes[order], more[order]
    first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    held = np.add.reduceat(more, first) + int(rows["silent"].iat[0]) >= support
    found = hashes[first][held]
    return pd.DataFrame({"length": np.full(len(found), key[1], np.int32), "hash": found.view(np.int64)})


def counted(shard: Shard, candidates: list[Bits], longest: int, buckets: int) -> Iterator[tuple]:
    """(length, bucket, phrases, counts) of the shard's phrases whose bit is set (one of ``candidates`` a length)."""
    known = None
    for length in range(1, longest + 1):
        at = shard.held(length, shard.places(length, known), candidates[length - 1])
        known = shard.marked(at)
        found, first, n = np.unique(shard.phrases(length, at), return_index=True, return_counts=True)
        for bucket, a, b in bucket_ranges(found, buckets):
            yield length, bucket, shard.spelled(length, at[first[a:b]]), n[a:b].astype(np.int64).tobytes()


def summed(key: tuple, rows: pd.DataFrame, support: int) -> pd.DataFrame:
    """lang, phrase, length, f of the frequent phrases of a bucket: equal words, whatever their hashes, are one phrase."""
    phrases = np.array([w for part in rows["phrases"] for w in part], object)
    n = np.concatenate([np.frombuffer(b, np.int64) for b in rows["counts"]])
    code, names = pd.factorize(phrases)
    f = np.zeros(len(names), np.int64)
    np.add.at(f, code, n)
    kept = f >= support
    return pd.DataFrame({"lang": key[0], "phrase": names[kept], "length": np.int32(key[1]), "f": f[kept]})


def sharded(docs: DataFrame, text: str, lang: str, shard_words: int, chunk_words: int, support: int) -> tuple[DataFrame, DataFrame]:
    """The stored shards (lang, n, words, codes, least), one row each, and the words of each language (lang, n)."""
    stored = written(chunks(docs, text, lang, chunk_words), "chunks")
    totals = written(stored.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"), "totals")
    total = totals.withColumnRenamed("n", "total")      # one row for each language
    parts = F.greatest(F.lit(1), F.ceil(F.col("total") / shard_words)).cast("int")
    placed = stored.join(F.broadcast(total), "lang").withColumn("shard", F.pmod(F.xxhash64("codes", "n"), parts).cast("int"))

    def whole_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": [key[0]], "n": [int(rows["n"].sum())], "total": [int(rows["total"].iat[0])],
                             "words": [list(rows["words"])], "codes": [list(rows["codes"])]})

    packed = placed.groupBy("lang", "shard").applyInPandas(
        whole_shard, "lang string, n long, total long, words array<array<binary>>, codes array<binary>")
    least = F.expr(f"({support}L * n + total - 1) div total").cast("int")
    return written(packed.withColumn("least", least).drop("total"), "shards"), totals


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, longest: int = LONGEST,
                  shard_words: int = SHARD_WORDS, chunk_words: int = CHUNK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, length, f) of all phrases up to ``longest`` words with f >= ``support``; (lang, n words)."""
    context = docs.sparkSession.sparkContext
    shards, totals = sharded(docs, text, lang, shard_words, chunk_words, support)
    # what silent shards can hold of a phrase; below the support by itself
    silent = written(shards.groupBy("lang").agg(F.sum(F.col("least") - 1).alias("silent")), "silent")

    words = totals.agg(F.sum("n")).first()[0] or 0
    buckets = 1 << max(4, (words // BUCKET_WORDS).bit_length())

    def candidates(lengths: range, shorter) -> DataFrame:
        def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for lang_, least, shard in _each(batches):
                for length, found, more in mine(shard, lengths, least, shorter.value if shorter else None):
                    out = [(bucket, found[a:b].tobytes(), more[a:b].astype(np.int64).tobytes())
                           for bucket, a, b in bucket_ranges(found, buckets)]
                    yield _packed(REPORT, lang_, length, out)

        told = shards.mapInArrow(report, "lang string, length int, bucket long, hashes binary, more binary")
        return written(told.join(F.broadcast(silent), "lang").groupBy("lang", "length", "bucket").applyInPandas(
            lambda key, rows: merged(key, rows, support), "length int, hash long"), "candidates")

    known = []
    for lengths in [range(1, 3), *(range(k, k + 1) for k in range(3, longest + 1))]:
        found = candidates(lengths, known[-1] if known else None)
        # at most BITMAP_BITS each
        known += [context.broadcast(Bits.of(found.where(F.col("length") == k))) for k in lengths]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang_, _, shard in _each(batches):
            for length, *part in counted(shard, [k.value for k in known], longest, buckets):
                yield _packed(COUNTS, lang_, length, [part])

    partial = shards.mapInArrow(count, "lang string, length int, bucket long, phrases array<binary>, counts binary")
    counts = partial.groupBy("lang", "length", "bucket").applyInPandas(
        lambda key, rows: summed(key, rows, support), "lang string, phrase binary, length int, f long")
    return written(counts.withColumn("phrase", F.col("phrase").cast("string")), "counts"), totals


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Shard]]:
    """lang, least and the shard of each row, one shard at a time."""
    for batch in batches:
        for row in range(batch.num_rows):
            words, codes = (batch.column(c)[row].values for c in ("words", "codes"))
            yield batch.column("lang")[row].as_py(), batch.column("least")[row].as_py(), Shard(words, codes)


def _packed(schema: pa.Schema, lang: str, length: int, rows: list) -> pa.RecordBatch:
    """Rows of one language and length: bucket and two more columns."""
    columns = [list(c) for c in zip(*rows)] if rows else [[]] * 3
    if pa.types.is_list(schema.field(3).type):
        ends = np.cumsum([0, *map(len, columns[1])]).astype(np.int32)
        columns[1] = pa.ListArray.from_arrays(ends, pa.concat_arrays([pa.array([], pa.binary()), *columns[1]]))
    columns = [[lang] * len(rows), [length] * len(rows), *columns]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(columns, schema)],
                                      schema=schema)


def _exact(c: str | Column) -> Column:
    return F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)")


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, length, a, l, r, n, score of every candidate phrase, by its lowest-scoring cut."""
    phrases = counts.where("length > 1").select("lang", "phrase", "length", F.col("f").alias("a"))
    words = F.split("phrase", " ", -1)
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1))).withColumn("words", words).select(
        "lang", "phrase", "length", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("rest"))
    part = counts.select("lang", "phrase", "f")
    cuts = cuts.join(part.withColumnsRenamed({"phrase": "first", "f": "l"}), ["lang", "first"])
    cuts = cuts.join(part.withColumnsRenamed({"phrase": "rest", "f": "r"}), ["lang", "rest"])
    # one row for each language
    cuts = cuts.join(F.broadcast(totals), "lang").withColumns({"up": _exact(F.lit(1000)) * _exact("a") * _exact("n"),
                                                  "down": _exact("l") * _exact("r")})
    cuts = cuts.withColumn("score", F.expr("up div down"))
    return cuts.groupBy("lang", "phrase", "length", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "length", "a", "cut.l", "cut.r", "n", "cut.score")


def outside_longer(phrases: DataFrame) -> DataFrame:
    """``phrases`` without those that a longer one, which is as frequent, holds.

    No longer phrase is more frequent than its parts, and what lies between a phrase and a longer one of equal
    count has that count, too; so phrases one word longer tell.
    """
    longer = phrases.where("length > 2")
    words = F.split("phrase", " ", -1)
    parts = longer.select("lang", F.col("a").alias("of"), F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("length") - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.col("length") - 1), " "))).alias("phrase"))
    held = parts.groupBy("lang", "phrase").agg(F.max("of").alias("of"))
    return phrases.join(held, ["lang", "phrase"], "left").where("of IS NULL OR 100 * of < 100 * a").drop("of")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, best: int = BEST,
                 longest: int = LONGEST, shard_words: int = SHARD_WORDS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """The ``best`` collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    counts, totals = phrase_counts(docs, text, lang, support, longest, shard_words, chunk_words)
    left = outside_longer(scored(counts, totals))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_WORD_ROWS = r"""
  SELECT lang, doc, piece, unnest(words) AS w, unnest(range(len(words))) AS i FROM (
    SELECT lang, doc, piece, regexp_extract_all(part, '[^\x20\x09]+') AS words FROM (
      SELECT lang, doc, unnest(parts) AS part, unnest(range(len(parts))) AS piece FROM (
        SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
               regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS parts
        FROM documents)))
"""
ORACLE_SQL = f"""
WITH words AS ({_WORD_ROWS}),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
five AS (
  SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4, lead(w, 4) OVER p AS w5
  FROM words WINDOW p AS (PARTITION BY doc, piece ORDER BY i)
),
counts AS (
  SELECT lang, [w1] AS p, count(*) AS f FROM five GROUP BY ALL HAVING count(*) >= 100
  UNION ALL SELECT lang, [w1, w2], count(*) FROM five WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100
  UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM five WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100
  UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM five WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100
  UNION ALL SELECT lang, [w1, w2, w3, w4, w5], count(*) FROM five WHERE w5 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100
),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, k, l.f AS l, r.f AS r, t.n,
         (1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM counts WHERE len(p) > 1) c
  JOIN counts l ON l.lang = c.lang AND l.p = c.p[1:k] JOIN counts r ON r.lang = c.lang AND r.p = c.p[k + 1:]
  JOIN totals t ON t.lang = c.lang
),
longer AS (
  SELECT lang, part, max(f) AS of FROM (
    SELECT lang, f, p[i:i + size - 1] AS part
    FROM (SELECT lang, f, p, size, unnest(range(1, len(p) - size + 2)) AS i
          FROM (SELECT lang, f, p, unnest(range(2, len(p))) AS size FROM counts)))
  GROUP BY ALL
),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank,
         array_to_string(p, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
  FROM scored s WHERE NOT EXISTS (
    SELECT 1 FROM longer h WHERE h.lang = s.lang AND h.part = s.p AND 100 * h.of >= 100 * s.a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
