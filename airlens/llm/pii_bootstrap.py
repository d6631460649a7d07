"""Personal data (operator 3): fixed patterns, then bootstrapped contextual extraction.

Base spans (email, ip, card, phone) follow fixed patterns. They, and long hexadecimal strings
(``secret``), are the seeds: each occurrence of a seed or of any other identifier-like token (some
digits, six characters or more) emits its lexical patterns, the two tokens before it, and the
tokens on both sides. Spark holds the graph of patterns and instances and scores it in rounds:

* a pattern's confidence for a kind is the sum of its distinct instances' scores over their number
  plus ``SMOOTHING``, so patterns that hold several kinds or unknown tokens score low;
* an instance's score for a kind is the noisy-or of its patterns' confidences (a seed's is 1).

After ``ROUNDS`` the instances that patterns alone score ``ACCEPT`` or more, in patterns of ``SUPPORT``
distinct instances or more, are personal data wherever they occur, unless a base span covers them.

The digits only open the search. The texts are read once more for the slots of the patterns that passed: any token there is a
candidate then, of whatever letters, and a member of the pattern, so a slot that ordinary words fill, too, loses its
confidence. What the patterns score ``ACCEPT`` or more with all their members is personal data in these slots. A bitmap of
``SLOT_BITS`` bits tells which words may stand in front of a slot; an exact join follows.

Cases: base spans of several kinds may overlap and are all kept; a token in slots of several kinds takes the best score, of equals the first kind; null and empty texts have no spans; very long texts are read whole, in linear time; repeated rows
count as one instance in a pattern and all get their spans; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import groups, whole, written

KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)
ROUNDS = 3
SMOOTHING = 1.0
SUPPORT = 5
ACCEPT = 0.7
FAINT = 0.3
CONTEXT = 64
SLOT_BITS = 1 << 22

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a run of digits is tried from its start only: from a later digit the same would follow
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_TOKEN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789@._%+:/-")
_TOKEN = re.compile(r"[A-Za-z0-9@._%+:/-]*")
_HEX = re.compile(r"(?=[^a-fA-F]*[a-fA-F])[0-9a-f]{32,}|(?=[^a-fA-F]*[a-fA-F])[0-9A-F]{32,}")
_OPEN = "\"'([{<"
_EDGE = "@._%+:/-"
_SPACED = re.compile(r"\S+")
_RUN = re.compile(r"[A-Za-z0-9@._%+:/-]+")
# words in which a token follows another sign, and words that are longer than a context
_MIXED = re.compile(r"(?<!\S)[A-Za-z0-9@._%+:/-]*+[^\sA-Za-z0-9@._%+:/-]++[A-Za-z0-9@._%+:/-]\S*")
_LONG = re.compile(rf"(?<!\S)\S{{{CONTEXT + 1},}}")

_SPAN = StructType([StructField("start", IntegerType(), False), StructField("kind", IntegerType(), False),
                    StructField("end", IntegerType(), False)])
_SEEN = StructType([StructField("start", IntegerType(), False), StructField("end", IntegerType(), False),
                    StructField("kind", IntegerType(), False), StructField("instance", LongType(), False),
                    StructField("patterns", ArrayType(LongType(), False), False),
                    StructField("word", LongType(), False)])
_SLOT = StructType([StructField("start", IntegerType(), False), StructField("end", IntegerType(), False),
                    StructField("instance", LongType(), False), StructField("patterns", ArrayType(LongType(), False), False)])
FOUND = StructType([StructField("base", ArrayType(_SPAN, False), False),
                    StructField("seen", ArrayType(_SEEN, False), False)])


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; each has one @, so the search goes from @ to @."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base matches, by start, then kind."""
    out = [(s, EMAIL, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append((m.start(), IP, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _only_digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), CARD, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_only_digits(m[0])) <= 15:
            out.append((m.start(), PHONE, m.end()))
    return sorted(out)


def identifiers(text: str) -> list[tuple[int, int]]:
    """Tokens of six characters or more with three digits or more, without the punctuation around them."""
    out, done = [], 0
    for m in _DIGITS.finditer(text):
        if m.start() < done:
            continue
        start = m.start()
        while start > done and text[start - 1] in _TOKEN_CHARS:
            start -= 1
        done = _TOKEN.match(text, m.start()).end()
        token = text[start:done]
        a = start + len(token) - len(token.lstrip(_EDGE))
        b = start + len(token.rstrip(_EDGE))
        if b - a >= 6 and sum("0" <= c <= "9" for c in text[a:b]) >= 3 and "://" not in token:
            out.append((a, b))
    return out


def _key(text: str) -> int:
    h = xxhash.xxh3_64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


def contexts(text: str, start: int, end: int) -> list[int]:
    """Keys of a slot's lexical patterns; digits around it are alike."""
    left = text[max(0, start - CONTEXT):start]
    bare = left.rstrip(_OPEN)
    opening = left[len(bare):]
    before = ["", "", *_DIGITS.sub("0", bare.lower()).split()][-2:]
    after = _DIGITS.sub("0", text[end:end + CONTEXT].lower()).split()[:1]
    return [_key(f"{before[0]} {before[1]} {opening}_"), _key(f"{before[1]} {opening}_{' '.join(after)}")]


def left_word(text: str, start: int) -> str:
    """The word in front of a slot, as its patterns have it."""
    bare = text[max(0, start - CONTEXT):start].rstrip(_OPEN)
    return _DIGITS.sub("0", (bare.lower().split() or [""])[-1])


def find(text: str) -> tuple[list, list]:
    """Base spans, and every seed and identifier-like token with its patterns."""
    base = base_spans(text)
    seen, covered = [], []
    for start, kind, end in base:
        covered.append((start, end))
        seen.append((start, end, kind, _key(text[start:end].lower()), contexts(text, start, end),
                     _key(left_word(text, start))))
    covered.sort()
    k, reach = 0, 0
    for start, end in identifiers(text):
        while k < len(covered) and covered[k][0] < end:
            reach = max(reach, covered[k][1])
            k += 1
        if reach > start:  # a base span covers a part of it
            continue
        kind = SECRET if _HEX.fullmatch(text, start, end) else -1
        seen.append((start, end, kind, _key(text[start:end].lower()), contexts(text, start, end),
                     _key(left_word(text, start))))
    return base, seen


@F.pandas_udf(FOUND)
def _found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        # what is found takes many times its text: a group's goes out before the next one is read
        for group in groups(list(texts)):
            rows = [find(t) for t in group]
            yield pd.DataFrame({
                "base": [[dict(zip(("start", "kind", "end"), s)) for s in base] for base, _ in rows],
                "seen": [[dict(zip(("start", "end", "kind", "instance", "patterns", "word"), s)) for s in seen]
                         for _, seen in rows],
            })


class Words:
    """Which words may stand in front of a slot."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def hold(self, words: list[str]) -> list[bool]:
        at = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) & np.uint64(SLOT_BITS - 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0).tolist()


def slots(text: str, before: Words) -> list[tuple]:
    """(start, end, instance, patterns) of every token that follows one of the words, itself of whatever form."""
    words = list(_SPACED.finditer(text))
    # whole texts are lower-cased and split at once; words that do not fit in a context are cut first
    forms = [w.rstrip(_OPEN) for w in _DIGITS.sub("0", text.lower()).split()]
    for m in _LONG.finditer(text):
        k = bisect_left(words, m.start(), key=re.Match.start)
        forms[k] = _DIGITS.sub("0", m[0][-CONTEXT:].rstrip(_OPEN).lower())
    # tokens at the beginning of words, and those behind a sign within a word
    places = {m.end() - len(m[0].lstrip(_OPEN)) for m, told in zip(words, before.hold(["", *forms])) if told}
    for m in _MIXED.finditer(text):
        places.update(m.start() + t.start() for t in _RUN.finditer(m[0]) if t.start())
    tokens = []
    for at in sorted(places):
        token = _TOKEN.match(text, at)[0]
        a, b = at + len(token) - len(token.lstrip(_EDGE)), at + len(token.rstrip(_EDGE))
        if a < b and "://" not in token:
            tokens.append((a, b))
    told = before.hold([left_word(text, a) for a, _ in tokens])
    return [(a, b, _key(text[a:b].lower()), contexts(text, a, b)) for (a, b), held in zip(tokens, told) if held]


def score_graph(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(instance, kind, score by patterns alone) and (pattern, kind, held) of the patterns that passed in the last round, from
    distinct ``edges`` (instance, pattern, kind; -1: unknown)."""
    edges = written(edges, "graph")
    members = edges.groupBy("pattern").agg(F.count("*").alias("members"))
    seeds = edges.where("kind >= 0").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    scores, told, passed = seeds, None, None
    links = edges.select("instance", "pattern")
    for _ in range(rounds):
        held = links.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("held"))
        passed = written(held.join(members, "pattern").where(F.col("members") >= SUPPORT).select(
            "pattern", "kind", "held", confidence(F.col("held"), F.col("members")).alias("confidence")).where(
            F.col("confidence") >= FAINT), "confidence")
        told = written(by_patterns(links.join(passed, "pattern")), "scores")
        scores = told.join(seeds.select("instance"), "instance", "left_anti").unionByName(seeds)
    return told, passed


def confidence(held: Column, members: Column) -> Column:
    return held / (members + SMOOTHING)


def by_patterns(rows: DataFrame) -> DataFrame:
    """instance, kind, score: the noisy-or of the confidences (instance, pattern, kind, confidence)."""
    return rows.groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score"))


def slot_words(words: DataFrame) -> np.ndarray:
    """Bits of the words' keys (word); what reaches the driver is bounded by SLOT_BITS."""
    at = F.pmod("word", F.lit(SLOT_BITS)) + 1
    parts = words.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros((SLOT_BITS >> 15, 4096), np.uint8)
    for r in parts.toLocalIterator():
        out[r["part"] - 1] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.ravel()


def discovered(texts: DataFrame, passed: DataFrame, words: DataFrame) -> DataFrame:
    """row, start, end, kind, score of the tokens in slots of the ``passed`` patterns, of whatever form.

    ``texts`` has row, text; ``words`` (word) the keys of the words in front of the slots. What the patterns held was
    counted over identifiers; here every token in their slots is a member.
    """
    shared = texts.sparkSession.sparkContext.broadcast(slot_words(words))

    @F.pandas_udf(ArrayType(_SLOT))
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        before = Words(shared.value)
        for batch in batches:
            for group in groups(list(batch)):
                yield pd.Series([[dict(zip(("start", "end", "instance", "patterns"), s)) for s in slots(t, before)]
                                 for t in group], dtype=object)

    seen = texts.select("row", F.explode(look("text")).alias("s")).select("row", "s.*")
    seen = written(seen.withColumn("pattern", F.explode("patterns")).drop("patterns")
                   .join(passed.select("pattern").distinct(), "pattern", "left_semi"), "slots")
    links = seen.select("instance", "pattern").distinct()
    members = links.groupBy("pattern").agg(F.count("*").alias("members"))
    sure = passed.select("pattern", "kind", "held").join(members, "pattern").select(
        "pattern", "kind", confidence(F.col("held"), F.greatest("members", F.ceil("held"))).alias("confidence")).where(
        F.col("confidence") >= FAINT)
    best = by_patterns(links.join(sure, "pattern")).where(F.col("score") >= ACCEPT)
    # in these slots, not wherever the token occurs
    found = seen.join(best, "instance").join(sure.select("pattern", "kind"), ["pattern", "kind"], "left_semi")
    return found.select("row", "start", "end", "kind", "score")


def _spans(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(
        F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for each row."""
    # equal texts have equal spans, so a text's digest is its name in both passes
    texts = docs.select(F.col(key).alias("doc_id"), whole(text).alias("text")).withColumn(
        "row", F.unhex(F.md5(F.col("text").cast("binary"))))
    rows = written(texts.select("doc_id", "row", _found("text").alias("f")).select("doc_id", "row", "f.*"), "spans")
    seen = rows.select("row", F.inline("seen"))
    sides = seen.select("instance", "kind", "word", F.explode("patterns").alias("pattern"))
    edges = sides.groupBy("instance", "pattern").agg(F.max("kind").alias("kind"))
    scores, passed = score_graph(edges)
    words = sides.select("pattern", "word").join(passed.select("pattern").distinct(), "pattern", "left_semi").select(
        "word").distinct()
    best = scores.where(F.col("score") >= ACCEPT).groupBy("instance").agg(
        F.max(F.struct("score", (-F.col("kind")).alias("kind"))).alias("best"))
    unseen = seen.where(~F.col("kind").between(EMAIL, PHONE)).join(best, "instance").select("row", "start", "end", "best")
    more = discovered(texts.select("row", "text"), passed, words).select(
        "row", "start", "end", F.struct("score", (-F.col("kind")).alias("kind")).alias("best"))
    # each place once, with its best kind; places that a base span touches are told already
    places = unseen.unionByName(more).groupBy("row", "start", "end").agg((-F.max("best")["kind"]).cast("int").alias("kind"))
    free = places.join(rows.select("row", "base").dropDuplicates(["row"]), "row").where(~F.exists(
        "base", lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"])))
    added = written(free.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("added")), "added")
    out = rows.drop("seen").join(added, "row", "left").withColumn(
        "added", F.coalesce("added", F.array().cast(ArrayType(_SPAN))))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return out.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in (EMAIL, IP, CARD, PHONE)],
        F.sha2(_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _spans(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
