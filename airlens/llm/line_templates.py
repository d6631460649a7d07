"""Line dedup (operator 10): a log-template tree finds lines that recur across documents.

A line is parsed as log parsers do: split at white space, tokens that hold a digit become the variable
``<*>``, and the line goes down a tree of fixed depth, by its number of tokens and its first
``DEPTH`` tokens. In a leaf, lines whose tokens agree at ``SIMILAR`` of the positions or more share a
template; the positions at which they differ are variable, too. The lines of a leaf that holds more than
``LEAF_LINES`` distinct ones (fewer, if these have more than ``LEAF_TOKENS`` tokens) are dealt over parts of that size, and templates start in rounds: one task takes
the first ``LEAF_LINES`` lines without a template, every part compares its lines with the templates these
start, and the next round takes what is left. This gives the templates one task would find, at any ``LEAF_LINES``.

A template is boilerplate, and all its lines are dropped, if it has no variable position or ``MIN_CONSTANT`` constant tokens and
recurs in ``MIN_DOCS`` texts of which no two are copies, however many copies each has. Two texts are copies, exact or edited,
if their other lines (all but those equal to the template's line) resemble each other by ``COPIES`` or more; the resemblance
of the sets of their ``WINDOW``-byte windows is estimated from sketches of ``BUCKETS`` values. So
copies do not make each other's lines boilerplate (near-duplicate removal is there for them), while a block of several
lines goes as long as it is not most of the text; and a document of a single line keeps it.

The texts are read twice: for 64-bit keys of all leaves, then for the lines whose
leaf recurs, with their words and sketches; a fixed-size bitmap (``BITMAP`` bits, whatever the input) tells the second pass which they are,
and an exact join follows.

Cases: null and empty texts have no lines; white-space lines are never dropped; a document that loses
all its lines gets an empty text; rows with equal texts are treated alike; an empty table gives an empty result;
extra columns are kept by ``drop_boilerplate`` (working columns take free names).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import free_name, whole, written

DEPTH = 3
SIMILAR = 0.8
MIN_DOCS = 3
MIN_CONSTANT = 3
LEAF_LINES = 2048
LEAF_TOKENS = 1 << 19
BITMAP = 1 << 23
SALTS = 32
WINDOW = 24
BUCKETS = 128
COPIES = 0.6
_ODD = np.uint64(0x9E3779B97F4A7C15)
VARIABLE = "<*>"
_DIGIT = re.compile(r"[0-9]")
_LINES = "t1 long, t2 long, line_no int, leaf long, line long, masked string, sketch binary"


def parse(line: str) -> list[str]:
    """Tokens of a line, variable ones masked."""
    tokens = line.split()
    if _DIGIT.search(line):
        tokens = [VARIABLE if _DIGIT.search(t) else t for t in tokens]
    return tokens


def parsed_lines(text: str) -> list[tuple[int, int, int, str]]:
    """(line number, leaf, line key, masked line) of every line with a token; keys are unsigned."""
    out = []
    for no, line in enumerate(text.split("\n")):
        tokens = parse(line)
        if tokens:
            masked = " ".join(tokens)
            leaf = f"{len(tokens)} {' '.join(tokens[:DEPTH])}"
            out.append((no, xxhash.xxh3_64_intdigest(leaf), xxhash.xxh3_64_intdigest(masked), masked))
    return out


def window_hashes(raw: bytes) -> np.ndarray:
    """A hash of the ``WINDOW`` bytes from each byte of ``raw`` on (zeros follow its end); the largest number for the end."""
    padded = raw + bytes(WINDOW + 8)
    word = np.empty(len(padded) - 8, np.uint64)  # the eight bytes from each byte on
    for k in range(8):
        part = np.frombuffer(padded, "<u8", (len(word) - k + 7) // 8, k)
        word[k::8] = part
    n = len(raw) + 1
    h = np.full(n, _ODD)
    for k in range(0, WINDOW, 8):
        h = (h ^ word[k:k + n]) * _ODD
        h ^= h >> np.uint64(29)
    h *= _ODD
    h[-1] = np.uint64(2**64 - 1)
    return h


def sketches(text: str, lines: list[tuple[int, int, int, str]]) -> dict[int, bytes | None]:
    """For each line key a sketch of the document without the lines of that key (None: nothing is left).

    The window hashes fall into ``BUCKETS`` by their first bits; a byte tells each bucket's smallest (0: it is empty).
    """
    keys = [line[2] for line in lines]
    if len(set(keys)) < 2:
        return dict.fromkeys(keys)
    raw = text.encode("utf-8")
    starts = np.append(0, np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1)
    numbers = {k: n for n, k in enumerate(dict.fromkeys(keys))}
    owner = np.full(len(starts), -1)
    owner[[line[0] for line in lines]] = [numbers[k] for k in keys]
    h = window_hashes(raw)[:-1]
    owner = np.repeat(owner, np.diff(np.append(starts, len(raw) + 1)))[:-1]
    h, owner = h[owner >= 0], owner[owner >= 0]
    order = np.argsort(h)
    h, owner = h[order], owner[order]
    bucket = (h // np.uint64(2**64 // BUCKETS)).astype(np.int64)
    told = ((h & np.uint64(0xFFFF)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    least, whose = np.zeros(BUCKETS, np.uint8), np.full(BUCKETS, -1)
    least[bucket[first]], whose[bucket[first]] = told[first], owner[first]
    # the smallest of the bucket's other lines stands in for a line that holds its smallest
    others = np.flatnonzero(owner != whose[bucket])
    second = others[np.flatnonzero(np.diff(bucket[others], prepend=-1))]
    spare = np.zeros(BUCKETS, np.uint8)
    spare[bucket[second]] = told[second]
    return {k: np.where(whose == n, spare, least).tobytes() for k, n in numbers.items()}


def resemblance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated resemblance for each row of two matrices of sketches."""
    return ((a == b) & (a > 0)).sum(axis=1) / np.maximum(((a > 0) | (b > 0)).sum(axis=1), 1)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _leaf_keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        found = [sorted({line[1] for line in parsed_lines(text)}) for text in f["text"]]
        size = [len(x) for x in found]
        yield pd.DataFrame({
            "t1": np.repeat(f["t1"].to_numpy(np.int64), size), "t2": np.repeat(f["t2"].to_numpy(np.int64), size),
            "leaf": _signed([k for x in found for k in x])})


def bitmap_of(leaves: DataFrame) -> np.ndarray:
    """Bits of the leaves (modulo ``BITMAP``); what reaches the driver is bounded by the bitmap's words."""
    words = leaves.select(F.pmod("leaf", F.lit(BITMAP)).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("mask")).toPandas()
    out = np.zeros(BITMAP // 64, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).view(np.uint64)
    return out


def _wanted_lines(texts: DataFrame, leaves: DataFrame) -> DataFrame:
    """The lines in ``leaves`` (and a few others) with sketches; equal texts and equal lines' words once per batch."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap_of(leaves))

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.unpackbits(shared.value.view(np.uint8), bitorder="little")
        for f in frames:
            rows, said = [], set()
            for t1, t2, text in f.drop_duplicates(["t1", "t2"])[["t1", "t2", "text"]].itertuples(index=False):
                found = parsed_lines(text)
                wanted = [x for x in found if bits[x[1] % BITMAP]]
                sketch = sketches(text, found) if wanted else {}
                for no, leaf, line, masked in wanted:
                    rows.append((t1, t2, no, leaf, line, None if (leaf, line) in said else masked, sketch[line]))
                    said.add((leaf, line))
            if rows:
                t1, t2, no, leaf, line, masked, sketch = zip(*rows)
                yield pd.DataFrame({
                    "t1": np.array(t1, np.int64), "t2": np.array(t2, np.int64), "line_no": np.array(no, np.int32),
                    "leaf": _signed(leaf), "line": _signed(line), "masked": masked, "sketch": sketch})

    return texts.mapInPandas(pick, _LINES)


def _token_ids(*texts: list[str]) -> list[np.ndarray]:
    """A matrix of token numbers for each list of lines (all with as many tokens)."""
    words: dict[str, int] = {}
    return [np.array([[words.setdefault(t, len(words)) for t in line.split(" ")] for line in lines], np.int32)
            for lines in texts]


def start_templates(lines: list[str], similar: float = SIMILAR) -> list[int]:
    """For each of a leaf's masked lines (in order) the number of the line whose template takes it.

    The first line without a template starts one, and takes the lines similar to it.
    """
    rows = _token_ids(lines)[0]
    out, todo = np.zeros(len(lines), np.int64), np.arange(len(lines))
    while len(todo):
        same = (rows[todo] == rows[todo[0]]).mean(axis=1) >= similar
        same[0] = True
        out[todo[same]] = todo[0]
        todo = todo[~same]
    return out.tolist()


def grow_templates(lines: list[str], similar: float = SIMILAR) -> list[str]:
    """The template of each of a leaf's masked lines (all with as many tokens), the most common lines first."""
    rows, seeds = _token_ids(lines)[0], np.array(start_templates(lines, similar))
    out: list = [None] * len(lines)
    for seed in np.unique(seeds):
        members = np.flatnonzero(seeds == seed)
        fixed = (rows[members] == rows[seed]).all(axis=0)
        told = " ".join(t if ok else VARIABLE for t, ok in zip(lines[seed].split(" "), fixed))
        for k in members:
            out[k] = told
    return out


def _small_leaf(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["n_texts", "masked"], ascending=[False, True])
    return rows[["leaf", "line"]].assign(told=grow_templates(rows["masked"].tolist()))


def _seeds(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    first = np.unique(start_templates(rows["masked"].tolist()))
    return rows.iloc[first][["leaf", "place", "masked"]].rename(columns={"place": "seed", "masked": "said"})


def _near_seeds(lines: pd.DataFrame, seeds: pd.DataFrame) -> pd.DataFrame:
    """Lines of a part with the first seed they are similar to (-1: none) and the positions at which they differ."""
    seeds = seeds.sort_values("seed")
    rows, first = _token_ids(lines["masked"].tolist(), seeds["said"].tolist())
    seed, vary = np.full(len(rows), -1, np.int64), [[] for _ in range(len(rows))]
    todo = np.arange(len(rows))
    for number, tokens in zip(seeds["seed"], first):
        equal = rows[todo] == tokens
        same = equal.mean(axis=1) >= SIMILAR
        for k, row in zip(todo[same], equal[same]):
            seed[k], vary[k] = number, np.flatnonzero(~row).tolist()
        todo = todo[~same]
    return lines.assign(seed=seed, vary=vary)


def part_lines(tokens: Column) -> Column:
    """How many lines of so many tokens a task may hold."""
    return F.greatest(F.lit(1), F.least(F.lit(LEAF_LINES), F.expr(f"{LEAF_TOKENS}L") / tokens)).cast("long")


def _full_leaves(lines: DataFrame) -> DataFrame:
    """leaf, line, told of leaves with more than ``part_lines`` lines; no task holds more than that of a leaf."""
    # places follow the order of the leaf's lines; a part is a run of places
    left = written(lines.orderBy("leaf", F.desc("n_texts"), "masked").withColumn(
        "place", F.monotonically_increasing_id()), "places").withColumn(
        "size", part_lines(F.size(F.split("masked", " ")))).select(
        "leaf", F.expr("place div size").alias("part"), "size", "place", "line", "masked")
    schema = "leaf long, part long, size long, place long, line long, masked string, seed long, vary array<int>"
    done = None
    while not left.isEmpty():
        parts = written(left.groupBy("leaf", "part", "size").count().withColumn(
            "upto", F.sum("count").over(Window.partitionBy("leaf").orderBy("part"))), "parts")
        front = parts.where(F.col("upto") <= F.col("size")).select("leaf", "part")
        seeds = written(left.join(front, ["leaf", "part"], "left_semi").groupBy("leaf").applyInPandas(
            _seeds, "leaf long, seed long, said string"), "seeds")
        dealt = parts.select("leaf", "part").join(seeds, "leaf")
        near = written(left.groupBy("leaf", "part").cogroup(dealt.groupBy("leaf", "part")).applyInPandas(
            _near_seeds, schema), "near")
        left = near.where("seed < 0").select("leaf", "part", "size", "place", "line", "masked")
        near = near.where("seed >= 0")
        done = near if done is None else done.unionByName(near)
    vary = done.select("leaf", "seed", F.explode("vary").alias("at")).distinct().groupBy("leaf", "seed").agg(
        F.collect_set("at").alias("at"))
    told = done.where("place = seed").select("leaf", "seed", "masked").join(vary, ["leaf", "seed"], "left").select(
        "leaf", "seed", F.array_join(F.transform(F.split("masked", " "), lambda t, k: F.when(
            F.array_contains(F.coalesce("at", F.array().cast("array<int>")), k), VARIABLE).otherwise(t)), " ").alias("told"))
    told = done.select("leaf", "seed", "part").distinct().join(told, ["leaf", "seed"])
    return done.join(told, ["leaf", "seed", "part"]).select("leaf", "line", "told")


def templates_of(lines: DataFrame) -> DataFrame:
    """line, template (key), constants, varies (has a variable) for distinct lines (leaf, line, masked, n_texts)."""
    tokens = F.size(F.split("masked", " "))
    alone = (tokens - 1) / tokens < SIMILAR  # similar to equal lines only
    longer = lines.where(~alone)
    full = written(longer.groupBy("leaf").agg(F.count("*").alias("n"), F.max(tokens).alias("tokens")).where(
        F.col("n") > part_lines(F.col("tokens"))).select("leaf"), "full")
    told = lines.where(alone).select("leaf", "line", F.col("masked").alias("told"))
    if full.isEmpty():
        small = longer
    else:
        salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        salted = longer.withColumn("salt", F.pmod("line", F.lit(SALTS)).cast("int"))
        full = full.select("leaf", salt)
        small = salted.join(full, ["leaf", "salt"], "left_anti").drop("salt")
        told = told.unionByName(_full_leaves(salted.join(full, ["leaf", "salt"], "left_semi").drop("salt")))
    told = told.unionByName(small.groupBy("leaf").applyInPandas(_small_leaf, "leaf long, line long, told string"))
    return told.select(
        "line", F.xxhash64("leaf", "told").alias("template"),
        F.size(F.filter(F.split("told", " "), lambda t: t != VARIABLE)).alias("constants"),
        F.array_contains(F.split("told", " "), VARIABLE).alias("varies"))


def _least_alike(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each batch the text of a template that is least like its leaders (the likest of them counts)."""
    for f in frames:
        if len(f):
            x = np.frombuffer(b"".join(f["sketch"]), np.uint8).reshape(-1, BUCKETS)
            # the leaders of a row stand one behind the other
            leaders = np.frombuffer(b"".join(f["leaders"]), np.uint8).reshape(len(f), -1, BUCKETS)
            alike = np.max([resemblance(x, leaders[:, k]) for k in range(leaders.shape[1])], axis=0)
            found = f[["template", "sketch"]].assign(alike=alike).sort_values(["template", "alike", "sketch"])
            yield found.drop_duplicates("template")[["template", "alike", "sketch"]]


def _salted(templates: DataFrame) -> DataFrame:
    """Each row for every salt: a common template's lines are dealt over SALTS tasks."""
    return templates.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))


def _apart(votes: DataFrame, leaders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(template) where ``MIN_DOCS`` texts, each least like those before it, are all unlike; and the first after the leader.

    ``leaders`` (template, leaders) begin; of equally unlike texts the smallest sketch counts.
    """
    first = None
    for _ in range(MIN_DOCS - 1):
        dealt = votes.join(_salted(leaders), ["template", "salt"]).select("template", "sketch", "leaders")
        least = dealt.mapInPandas(_least_alike, "template long, alike double, sketch binary").groupBy("template").agg(
            F.min(F.struct("alike", "sketch")).alias("x")).join(leaders, "template")
        least = written(least.select("template", "x.*", "leaders"), "far")
        first = least.select("template", F.col("sketch").alias("leaders")) if first is None else first
        leaders = least.where(F.col("alike") < COPIES).select("template", F.concat("leaders", "sketch").alias("leaders"))
    return leaders.select("template"), first


def spread_templates(votes: DataFrame) -> DataFrame:
    """template: those with ``MIN_DOCS`` texts of which no two are copies (votes: template, sketch).

    The texts are taken farthest first, from the text of the smallest sketch; where that fails, from the one least like it. So
    what is found follows from the texts alone, in whatever order they come. All that is taken has to be unlike;
    where ``MIN_DOCS`` texts lie twice as far apart as copies may, such are found.
    """
    votes = votes.withColumn("salt", F.pmod(F.xxhash64("sketch"), F.lit(SALTS)).cast("int"))
    found, far = _apart(votes, votes.groupBy("template").agg(F.min("sketch").alias("leaders")))
    more, _ = _apart(votes, far.join(found, "template", "left_anti"))
    return found.unionAll(more)


def boilerplate(texts: DataFrame) -> DataFrame:
    """t1, t2, line_no of all lines to drop from ``texts`` (t1, t2: the text's key, text)."""
    keys = texts.mapInPandas(_leaf_keys, "t1 long, t2 long, leaf long")
    recurring = keys.groupBy("leaf", "t1", "t2").agg(F.lit(1).alias("one")).groupBy("leaf").count().where(
        F.col("count") >= MIN_DOCS)
    leaves = written(recurring.select("leaf"), "leaves")
    known = written(_wanted_lines(texts, leaves).join(leaves, "leaf", "left_semi"), "candidates")
    texts_of = known.groupBy("line", "t1", "t2").agg(F.lit(1).alias("one")).groupBy("line").agg(
        F.count("*").alias("n_texts"))
    said = known.where(F.col("masked").isNotNull()).groupBy("leaf", "line").agg(F.min("masked").alias("masked"))
    told = written(templates_of(written(said.join(texts_of, "line"), "said")), "templates")
    # a document without other lines keeps its own
    found = written(known.where(F.col("sketch").isNotNull()).join(
        told.where(~F.col("varies") | (F.col("constants") >= MIN_CONSTANT)), "line").select(
        "t1", "t2", "line_no", "template", "sketch"), "found")
    votes = written(found.groupBy("template", "t1", "t2").agg(F.min_by("sketch", "line_no").alias("sketch"))
                    .select("template", "sketch"), "votes")
    lines = found.withColumn("salt", F.pmod("t1", F.lit(SALTS)).cast("int"))
    return lines.join(_salted(spread_templates(votes)), ["template", "salt"], "left_semi").select(
        "t1", "t2", "line_no").distinct()


def text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text), F.xxhash64(F.lit("second"), text)]


def with_dropped(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with an array of the line numbers to drop (null: none) in a column whose name is returned."""
    k1, k2, dropped = (free_name(docs, n) for n in ("key_1", "key_2", "lines_to_drop"))
    keyed = docs.withColumns(dict(zip((k1, k2), text_key(whole(text)))))
    texts = docs.select(whole(text).alias("text")).select(
        *[c.alias(n) for c, n in zip(text_key(F.col("text")), ("t1", "t2"))], "text")
    lines = boilerplate(texts).groupBy(F.col("t1").alias(k1), F.col("t2").alias(k2)).agg(
        F.sort_array(F.collect_set("line_no")).alias(dropped))
    lines = written(lines, "dropped")
    return keyed.join(lines, [k1, k2], "left").drop(k1, k2), dropped


def kept_text(text: Column, dropped: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda _, k: ~F.array_contains(dropped, k))
    return F.when(dropped.isNull(), text).otherwise(F.array_join(lines, "\n"))


def drop_boilerplate(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the boilerplate lines taken out of the text column; other columns unchanged."""
    out, dropped = with_dropped(docs, text)
    return out.withColumn(text, kept_text(F.col(text), F.col(dropped))).select(*[F.col(f"`{c}`") for c in docs.columns])


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, dropped (line numbers, comma-joined), kept_sha256 (of the remaining text)."""
    out, dropped = with_dropped(docs.select("doc_id", whole("text").alias("text")))
    numbers = F.coalesce(F.col(dropped), F.array().cast("array<int>"))
    return out.select(
        "doc_id", F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.size(numbers).cast("long").alias("n_dropped"), F.array_join(numbers, ",").alias("dropped"),
        F.sha2(kept_text(F.col("text"), F.col(dropped)).cast("binary"), 256).alias("kept_sha256"))
