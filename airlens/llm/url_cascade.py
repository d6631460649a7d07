"""URL filters (operator 5): longest-rule matching and a Bloom filter cascade.

``judge_urls`` takes a rule list (verdict, host, path; the longest rule that fits wins) and,
for urls without a rule, exact membership of their key (host and path) in a list of keys.

Membership needs no join: level 1 of the cascade is a Bloom filter of the listed keys, level
2 one of the other keys of the corpus that pass level 1, level 3 one of the listed keys that
pass level 2, and so on until no key passes wrongly. A key's first missing level tells on
which side it is. As the levels are built against the corpus's complete set of distinct
keys, the answer is exact for every url of the corpus.

Size: a cascade of at most about ``SHARD_KEYS`` listed keys (tens of megabytes) is broadcast for one pass over the rows.
Beyond that, keys are dealt into shards of about ``TASK_KEYS`` by hash; a task builds one shard's cascade, and one pass over the
rows, dealt by shard in parts of ``PART_ROWS`` rows, meets each with its own shard's cascade: two scans and one shuffle of the
rows, whatever the number of shards.

Cases: a null url or one without ``://`` has an empty host and path and fits no rule; very
long urls are read whole; repeated rows are judged row by row; of fitting rules of
equal length the last in the list wins; an empty list gives a
cascade without levels that blocks nothing; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .common import written

SHARD_KEYS = 4_000_000
TASK_KEYS = 1_000_000
PART_ROWS = 1 << 17
BITS_PER_KEY = 12
HASHES = 6
MAX_LEVELS = 40
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def key_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Bit numbers of each key at a level of ``bits`` bits (a power of two), one row per key."""
    salt = np.uint64(((level + 1) * 0x9E3779B97F4A7C15) % 2**64)
    a, b = _mix(h1.view(np.uint64) ^ salt), _mix(h2.view(np.uint64) + salt) | np.uint64(1)
    return (a[:, None] + b[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(bits - 1)


@dataclass
class Cascade:
    """Levels as arrays of 64-bit words."""

    levels: list[np.ndarray]

    def passes(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        words = self.levels[level]
        at = positions(h1, h2, level, len(words) * 64)
        hit = (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        return hit.all(axis=1)

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.full(len(h1), len(self.levels) % 2 == 1)  # of keys that pass every level
        todo = np.arange(len(h1))
        for level in range(len(self.levels)):
            inside = self.passes(level, h1[todo], h2[todo])
            out[todo[~inside]] = level % 2 == 1
            todo = todo[inside]
        return out


def _level_bits(members: DataFrame, level: int, n: int) -> np.ndarray:
    """The filter of ``n`` keys: bit numbers in tasks, words combined by the shuffle, filter to the driver."""
    bits = 1 << max(6, int(BITS_PER_KEY * n - 1).bit_length())

    @F.pandas_udf("array<long>")
    def at(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(list(positions(h1.to_numpy(np.int64), h2.to_numpy(np.int64), level, bits).astype(np.int64)),
                         dtype=object)

    found = (
        members.select(F.explode(at("h1", "h2")).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("mask"))
        .toPandas()
    )
    words = np.zeros(bits // 64, np.uint64)
    words[found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).view(np.uint64)
    return words


def build_cascade(keys: DataFrame) -> Cascade:
    """The cascade of ``keys`` (h1, h2, listed), which hold every distinct key of the corpus once."""
    cascade = Cascade([])
    sides = [keys.where("listed").select("h1", "h2"), keys.where("not listed").select("h1", "h2")]
    n = sides[0].count()
    while n:
        level = len(cascade.levels)
        if level == MAX_LEVELS:
            raise RuntimeError("two keys share both hashes")
        cascade.levels.append(_level_bits(sides[level % 2], level, n))
        other = (level + 1) % 2
        sides[other] = written(sides[other].where(_passing(cascade, level, keys)), "cascade")
        n = sides[other].count()
    return cascade


def _passing(cascade: Cascade, level: int, df: DataFrame) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(cascade.levels[level])

    @F.pandas_udf("boolean")
    def inside(h1: pd.Series, h2: pd.Series) -> pd.Series:
        words = shared.value
        at = positions(h1.to_numpy(np.int64), h2.to_numpy(np.int64), level, len(words) * 64)
        hit = (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        return pd.Series(hit.all(axis=1))

    return inside("h1", "h2")


def _listed(cascade: Cascade, df: DataFrame) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(cascade)

    @F.pandas_udf("boolean")
    def member(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(shared.value.listed(h1.to_numpy(np.int64), h2.to_numpy(np.int64)))

    return member("h1", "h2")


def with_membership(rows: DataFrame, key: str, listed: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``rows`` with a boolean column ``listed``: is the key one of ``listed`` (key, listed), which cover all keys?

    ``listed`` has every distinct key of ``rows`` once, with a boolean column of that name.
    """
    keys = written(listed.select(*key_hashes(F.col(key)), "listed"), "url-keys")
    n = keys.agg(F.count_if("listed").alias("listed"), F.count("*").alias("all")).first()
    # level 1 holds the listed keys, level 2 about a hundredth of the others at most
    hashed = rows.select("*", *key_hashes(F.col(key)))
    if n["listed"] <= shard_keys and n["all"] <= 100 * shard_keys:
        return hashed.withColumn("listed", _listed(build_cascade(keys), rows)).drop("h1", "h2")
    return _in_shards(hashed, keys, -(-n["all"] // min(shard_keys, TASK_KEYS)))


def cascade_in_task(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> Cascade:
    """The cascade of distinct keys that one task holds."""
    cascade, sides = Cascade([]), [np.flatnonzero(listed), np.flatnonzero(~listed)]
    while len(sides[len(cascade.levels) % 2]):
        level = len(cascade.levels)
        if level == MAX_LEVELS:
            raise RuntimeError("two keys share both hashes")
        own, other = sides[level % 2], sides[(level + 1) % 2]
        bits = 1 << max(6, int(BITS_PER_KEY * len(own) - 1).bit_length())
        words, at = np.zeros(bits // 64, np.uint64), positions(h1[own], h2[own], level, bits).ravel()
        np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        cascade.levels.append(words)
        sides[(level + 1) % 2] = other[cascade.passes(level, h1[other], h2[other])]
    return cascade


def _in_shards(hashed: DataFrame, keys: DataFrame, shards: int) -> DataFrame:
    """``hashed`` rows (h1, h2) with ``listed``, each judged by its own shard's cascade."""
    shard = F.pmod("h1", F.lit(shards)).alias("shard_")

    def build(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        cascade = cascade_in_task(own["h1"].to_numpy(np.int64), own["h2"].to_numpy(np.int64), own["listed"].to_numpy(bool))
        return pd.DataFrame({"shard_": [key[0]], "levels": [[level.tobytes() for level in cascade.levels]]})

    cascades = keys.groupBy(shard).applyInPandas(build, "shard_ long, levels array<binary>")
    parts = hashed.groupBy(shard).agg(F.ceil(F.count("*") / PART_ROWS).cast("long").alias("parts"))
    dealt = written(cascades.join(parts, "shard_"), "cascades")
    # a shard that holds a common key has more parts
    left = hashed.withColumns({"shard_": shard, "at_": F.monotonically_increasing_id()}).join(
        dealt.select("shard_", "parts"), "shard_").withColumn("part_", F.pmod("at_", "parts")).drop("at_", "parts")
    right = dealt.withColumn("part_", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("shard_", "part_", "levels")
    columns = [c for c in hashed.columns if c not in ("h1", "h2")]

    def judge(rows: pa.Table, held: pa.Table) -> pa.Table:
        out = rows.select(columns)
        if not rows.num_rows:
            return out.append_column("listed", pa.array([], pa.bool_()))
        cascade = Cascade([np.frombuffer(level, np.uint64) for level in held["levels"][0].as_py()])
        told = cascade.listed(rows["h1"].to_numpy(), rows["h2"].to_numpy())
        return out.append_column("listed", pa.array(told, pa.bool_()))

    schema = StructType([*hashed.select(*columns).schema.fields, StructField("listed", BooleanType())])
    return left.groupBy("shard_", "part_").cogroup(right.groupBy("shard_", "part_")).applyInArrow(judge, schema)


def tracked_keys(urls: DataFrame) -> DataFrame:
    """Every distinct key once; listed are those that occur with a tracking parameter in a query."""
    return urls.groupBy("key").agg(
        F.max(F.coalesce(F.col("url").rlike(r"\?([^#]*&)?utm_[a-z]+="), F.lit(False))).alias("listed"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], page: str = "page_id", url: str = "url",
               shard_keys: int = SHARD_KEYS) -> DataFrame:
    """page_id, host, path, rule, verdict, listed for each page.

    Urls without a rule are blocked if their key is listed by ``tracked_keys``, else allowed.
    """
    rows = pages.select(F.col(page).alias("page_id"), F.col(url).alias("url")).select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("key", F.concat("host", "path"))
    told = with_membership(rows.drop("url"), "key", tracked_keys(rows), shard_keys)
    fit = told.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    return fit.select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


ORACLE_SQL = """
WITH u AS (
  SELECT page_id, url,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), listed AS (
  SELECT DISTINCT host || path AS key FROM u WHERE regexp_matches(url, '\\?([^#]*&)?utm_[a-z]+=')
), rules(verdict, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), hosts AS (SELECT DISTINCT host FROM u
), fits AS (
  SELECT host, h, p, verdict FROM hosts JOIN rules ON host = h OR ends_with(host, '.' || h)
), best AS (
  SELECT DISTINCT u.host, u.path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM u) u JOIN fits ON u.host = fits.host AND starts_with(u.path, fits.p)
  GROUP BY ALL
)
SELECT u.page_id, u.host, u.path, best.rule,
       coalesce(best.verdict, CASE WHEN listed.key IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       listed.key IS NOT NULL AS listed
FROM u LEFT JOIN best ON u.host = best.host AND u.path = best.path
     LEFT JOIN listed ON u.host || u.path = listed.key
"""
