"""Mixing sources to target weights (operator 2): iterative proportional fitting, then sampling.

Documents are counted in cells (source, language, topic) by their tokens (words). The cells
are raked: in turn, the weights of each source, each language and each topic are scaled to
the target share of that margin, in ``SWEEPS`` sweeps; then the last margin holds, and the others but for an
error that the tests bound (2e-15 at sf0.1; it falls slowly where cells are few and uneven). A cell's sampling
probability is proportional to its raked weight over its present weight, scaled so that the
largest is 1: the largest sample that keeps the target mix without repeating a document. A
document is drawn if a digest of the seed, its id and its text falls below its probability, so the draw
does not depend on partitions or retries.

Targets default to the present shares raised to ``temper`` (a power below 1 moves weight
from the large to the small); a table of targets (margin, value, share) replaces them.

Only DataFrame functions run. The text is read once; raking works on the cells, whose number does
not grow with the documents, and every sweep cuts its lineage by storing them.

Cases: null sources and languages are values of their own; null and empty texts have no tokens, so
they weigh nothing and are drawn with their cell's probability (a cell without any tokens is kept
whole); very long texts are read whole, by SQL functions; of several topics whose marks a text holds the first counts;
repeated rows (and rows of equal id and text) are drawn together; an empty table gives an empty result; extra columns are
kept by ``mix`` (its working columns take free names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD_PATTERN, free_name, whole, written

SWEEPS = 8
TEMPER = 0.9
SEED = 17
MARGINS = ("source", "lang", "topic")
#: (topic, substrings); the first topic of which the text holds a substring, else "prose"
TOPICS = (
    ("legal", ("Licensed under", "licensed under", "License", "All rights reserved")),
    ("contact", ("@", "+1 (")),
    ("table", (" | ",)),
)


def topic_of(text: Column) -> Column:
    out = F.lit("prose")
    for topic, marks in reversed(TOPICS):
        held = F.contains(text, F.lit(marks[0]))
        for mark in marks[1:]:
            held = held | F.contains(text, F.lit(mark))
        out = F.when(held, topic).otherwise(out)
    return out


def value_of(column: str) -> Column:
    """A margin's value as a text that is never null: a null and the text "null" stay apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("null"))


def margins(docs: DataFrame) -> list[Column]:
    return [value_of("source").alias("source"), value_of("lang").alias("lang"),
            topic_of(whole("text")).alias("topic")]


def cells_of(docs: DataFrame) -> DataFrame:
    """source, lang, topic, tokens: the present weights."""
    tokens = F.regexp_count(whole("text"), F.lit(WORD_PATTERN))
    return docs.select(*margins(docs), tokens.alias("n")).groupBy(*MARGINS).agg(
        F.sum("n").cast("double").alias("tokens"))


def tempered_targets(cells: DataFrame, temper: float = TEMPER) -> DataFrame:
    """margin, value, share: the present shares raised to ``temper``; values without tokens have no share."""
    long = cells.select(
        F.explode(F.array(*[F.struct(F.lit(m).alias("margin"), F.col(m).alias("value")) for m in MARGINS])).alias("m"),
        "tokens").groupBy("m.margin", "m.value").agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    total = long.groupBy("margin").agg(F.sum(F.pow("tokens", F.lit(temper))).alias("total"))
    return long.join(total, "margin").select("margin", "value", (F.pow("tokens", F.lit(temper)) / F.col("total")).alias("share"))


def rake(cells: DataFrame, targets: DataFrame, sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` with a column ``weight``: shares of the tokens whose margins are the targets'.

    After a sweep the last margin (topic) holds exactly, the others as nearly as the sweeps allow.
    Values without a target get no weight.
    """
    work = cells.where("tokens > 0").withColumn("weight", F.col("tokens"))
    for _ in range(sweeps):
        for m in MARGINS:
            goal = targets.where(F.col("margin") == m).select(F.col("value").alias(m), "share")
            now = work.groupBy(m).agg(F.sum("weight").alias("now")).join(goal, m).where("now > 0").select(
                m, (F.col("share") / F.col("now")).alias("scale"))
            work = work.join(now, m).select(*MARGINS, "tokens", (F.col("weight") * F.col("scale")).alias("weight"))
        work = written(work, "rake")
    return work


def probabilities(raked: DataFrame) -> DataFrame:
    """source, lang, topic, p: weight over tokens, the largest scaled to 1."""
    rate = raked.select(*MARGINS, (F.col("weight") / F.col("tokens")).alias("rate"))
    largest = rate.agg(F.max("rate").alias("largest"))
    return rate.select(*MARGINS, (F.col("rate") / F.coalesce(largest.scalar(), F.lit(1.0))).alias("p"))


def draw(key: Column, text: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the first 32 bits of a digest."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.md5(text.cast("binary")))
    return F.conv(F.substring(F.md5(told.cast("binary")), 1, 8), 16, 10).cast("double") / float(2**32)


def drawn(docs: DataFrame, targets: DataFrame | None = None, key: str = "doc_id") -> tuple[DataFrame, list[str]]:
    """``docs`` with source, lang, topic, p and the draw under free names, which are returned too."""
    cells = written(cells_of(docs), "cells")
    raked = rake(cells, written(tempered_targets(cells) if targets is None else targets, "targets"))
    names = [free_name(docs, f"mix_{m}") for m in (*MARGINS, "p", "draw")]
    # as many rows as there are cells, whatever the number of documents
    p = probabilities(raked).select(*[F.col(m).alias(n) for m, n in zip((*MARGINS, "p"), names)])
    # cells without tokens are not raked
    with_cell = docs.select("*", *[c.alias(n) for c, n in zip(margins(docs), names)])
    out = with_cell.join(p, names[:3], "left").withColumn(names[3], F.coalesce(names[3], F.lit(1.0)))
    return out.withColumn(names[4], draw(F.col(key), whole("text"))), names


def mix(docs: DataFrame, targets: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """The drawn documents, columns unchanged."""
    out, names = drawn(docs, targets, key)
    return out.where(F.col(names[4]) < F.col(names[3])).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_report(docs: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, p (6 digits), kept for every document."""
    out, names = drawn(docs.select("doc_id", "source", "lang", "text"), targets)
    return out.select(
        "doc_id", "source", "lang", F.col(names[2]).alias("topic"),
        F.regexp_count(whole("text"), F.lit(WORD_PATTERN)).cast("long").alias("n_tokens"),
        F.round(names[3], 6).alias("p"), (F.col(names[4]) < F.col(names[3])).alias("kept"))


def oracle_sql() -> str:
    topic = " ".join(
        f"WHEN {' OR '.join(f'contains(text, {chr(39)}{m}{chr(39)})' for m in marks)} THEN '{t}'" for t, marks in TOPICS)
    steps = [f"""docs AS MATERIALIZED (
  SELECT doc_id, source, lang, coalesce(text, '') AS text, coalesce('=' || source, 'null') AS s,
         coalesce('=' || lang, 'null') AS l FROM documents
), told AS MATERIALIZED (
  SELECT doc_id, source, lang, s, l, CASE {topic} ELSE 'prose' END AS t,
         len(regexp_extract_all(text, '[^ \\x09-\\x0D]+')) AS n_tokens, md5(text) AS digest FROM docs
), w0 AS MATERIALIZED (
  SELECT s, l, t, sum(n_tokens)::DOUBLE AS tokens, sum(n_tokens)::DOUBLE AS w FROM told GROUP BY ALL HAVING sum(n_tokens) > 0
)"""]
    for c in "slt":
        steps.append(f"""goal_{c} AS MATERIALIZED (
  SELECT {c}, pow(sum(tokens), {TEMPER}) / sum(pow(sum(tokens), {TEMPER})) OVER () AS share FROM w0 GROUP BY {c}
)""")
    k = 0
    for _ in range(SWEEPS):
        for c in "slt":
            steps.append(f"""w{k + 1} AS MATERIALIZED (
  SELECT w.s, w.l, w.t, w.tokens, w.w * g.share / sum(w.w) OVER (PARTITION BY w.{c}) AS w
  FROM w{k} w JOIN goal_{c} g ON w.{c} = g.{c}
)""")
            k += 1
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, source, lang, d.t AS topic, n_tokens::BIGINT AS n_tokens, round(coalesce(p, 1.0), 6) AS p,
       ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || digest), 1, 8))::BIGINT / 4294967296.0
         < coalesce(p, 1.0) AS kept
FROM told d LEFT JOIN (SELECT s, l, t, (w / tokens) / max(w / tokens) OVER () AS p FROM w{k}) x
  ON d.s = x.s AND d.l = x.l AND d.t = x.t
"""
