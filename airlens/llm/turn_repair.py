"""Conversation structure repair (operator 12): one scalar weight for cost and audit, integer minimum over a DAG.

A conversation is repaired by the cheapest edits that leave roles of the form ``(s?(ua)+)?``: Keep (0),
Rerole to user or assistant (3), Delete (4; the only edit of a blank or duplicate turn) and Insert an empty
user or assistant turn (3); a truncated turn that is not deleted adds 3. After each prefix of the
form only one of user and assistant can follow, so the initials of the edits (the audit) tell the new roles, too.

The nodes of the DAG are (turn, state), with the states start, after system, after user and after assistant;
an edge is one edit. The weight of a node is one integer, the cheapest way to the end: its high
digits are the cost, below them stand ``width`` digits, one for each letter of the audit from there
on, the first letter highest and zeros behind the last (D, I, K, R are 1 to 4, so that digits compare as
the letters do and an audit comes before its extensions). An edit in front adds its cost to the high digits, moves the
low digits one place down and sets the first. As all numbers have one width, the smaller of two integers is the
cheaper way or, at equal cost, the ASCII-least audit: ``min`` decides everything.

Turns are in order of ``turn`` (nulls first), then role, then text; the first fault of a turn counts: blank,
duplicate of an earlier turn (role and text), truncated. Texts are only sorted and streamed: the
faults come from windows, a conversation's part in the integer program is one character a turn, and the repaired
text is hashed while sorted rows pass by, so memory does not grow with the length of texts. The program
itself is sequential: a conversation is one task's work, its integers have 7 bits a turn, so that its time
grows with the square of the turns (figures in the README).

Cases: null role or text is one space, a null conv_id or turn is one space in the key of the damage;
a null conv_id is a conversation of its own; repeated rows are turns of their own (the later ones duplicates);
turns with equal number, role and text are interchangeable; roles other than system, user and assistant count by their
first letter, and can only be reroled or deleted if that is none of s, u, a; a conversation without turns needs no
edits; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

LETTERS = "DIKR"
BITS = 3
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that may be inserted or reroled to in a state, which is also the state behind it.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state behind a kept turn, by state and initial.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
SPACES = r"\x20\x09-\x0D"
DAMAGES = 20


def cheapest(turns: str) -> tuple[int, str]:
    """Cost and audit of a conversation; a turn is its initial (any other letter: ``x``), in capitals if
    truncated, or ``-`` if it has to go."""
    n = len(turns)
    width = n + DELETE * n // INSERT + 1        # deleting everything costs DELETE * n, so inserts are fewer
    high, top = BITS * width, BITS * (width - 1)
    low = (1 << high) - 1
    cost_of = lambda c: c << high               # noqa: E731
    first = {letter: k << top for k, letter in enumerate(LETTERS, 1)}

    def edit(letter: str, cost: int, rest: int) -> int:
        return (rest & ~low) + cost_of(cost) + first[letter] + ((rest & low) >> BITS)

    never = cost_of(DELETE * n + INSERT * (n + 4))   # dearer than any way that could be cheapest

    def with_inserts(after: list[int]) -> list[int]:
        # nothing is gained by more than two inserts in one place: the third state repeats the first
        for _ in range(2):
            after = [min(w, edit("I", INSERT, after[NEXT[s]])) for s, w in enumerate(after)]
        return after

    weight = with_inserts([0, never, never, 0])
    for turn in reversed(turns):
        behind, extra = weight, TRUNCATED if turn.isupper() else 0
        weight = []
        for state in range(4):
            ways = [edit("D", DELETE, behind[state])]
            if turn != "-":
                ways.append(edit("R", REROLE + extra, behind[NEXT[state]]))
                kept = KEPT.get((state, turn.lower()))
                if kept is not None:
                    ways.append(edit("K", KEEP + extra, behind[kept]))
            weight.append(min(ways))
        weight = with_inserts(weight)
    best, audit = weight[START], []
    digits = best & low
    for place in range(width):
        digit = digits >> (top - BITS * place) & 7
        if not digit:
            break
        audit.append(LETTERS[digit - 1])
    return best >> high, "".join(audit)


def damaged(conversations: DataFrame, damages: int = DAMAGES) -> DataFrame:
    """conv_id, turn, role, text after the damage; a dropped row stays as one whose ``copy`` is null."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        F.pmod(F.crc32(key.cast("binary")), F.lit(damages)).alias("damage"))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("damage") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, F.lit("")).when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode_outer(F.when(F.col("damage") == 3, F.array(F.lit(1), F.lit(2)))
                        .when(F.col("damage") != 0, F.array(F.lit(1)))).alias("copy"))


def diagnosed(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, copy) with place in the conversation, first fault and code."""
    there = F.col("copy").isNotNull()
    seen = Window.partitionBy("conv_id", "role", "text", there).orderBy(F.asc_nulls_first("turn"), "copy")
    in_order = Window.partitionBy("conv_id").orderBy(there.desc(), F.asc_nulls_first("turn"), "role", "text", "copy")
    initial = F.substring("role", 1, 1)
    # the last character that is not blank
    end = F.regexp_extract("text", rf"([^{SPACES}])[{SPACES}]*\z", 1)
    fault = (F.when(end == "", F.lit("blank")).when(F.col("nth") > 1, F.lit("duplicate"))
             .when(~end.isin(".", "!", "?"), F.lit("truncated")).otherwise(F.lit("none")))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    code = (F.when(F.col("fault").isin("blank", "duplicate"), F.lit("-")).when(F.col("fault") == "truncated", F.upper(known))
            .otherwise(known))
    pair = F.concat(F.lag(initial).over(in_order), initial)
    return (rows.withColumn("nth", F.row_number().over(seen)).withColumn("fault", F.when(there, fault))
            .withColumn("code", F.when(there, code))
            .withColumn("place", F.row_number().over(in_order))
            .withColumn("illegal", there & F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)))
            .select("conv_id", "turn", "role", "text", "place", "fault", "code", "illegal"))


def repaired_turns(turns: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """The (role, text) that the edits of ``audit`` make of ``turns``; reads them as it goes."""
    state = START
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield ROLES[state], ""
            continue
        role, text = next(turns)
        if letter == "R":
            state = NEXT[state]
            yield ROLES[state], text
        elif letter == "K":
            state = KEPT[state, role[0]]
            yield role, text


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by conversation and place, the audit first: the digest of each conversation, text by text."""
    def rows():
        for f in frames:
            yield from zip(f["conv"], f["place"], f["role"], f["text"])

    def digests():
        stream = rows()
        row = next(stream, None)
        while row is not None:
            conv, audit, following = row[0], row[3], [None]

            def turns():
                for r in stream:
                    if r[1] == 0:       # the audit of the next conversation
                        following[0] = r
                        return
                    yield r[2], r[3]

            left, digest, between = turns(), hashlib.sha256(), b""
            for role, text in repaired_turns(left, audit):
                digest.update(between + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                between = b"\n"
            for _ in left:
                pass
            yield conv, digest.hexdigest()
            row = following[0]

    batch = []
    for told in digests():
        batch.append(told)
        if len(batch) == 4096:
            yield pd.DataFrame(batch, columns=["conv", "repaired_sha256"])
            batch = []
    if batch:
        yield pd.DataFrame(batch, columns=["conv", "repaired_sha256"])


def repair(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text, copy): counts, cost, audit, digest."""
    kind = rows.schema["conv_id"].dataType
    turns = written(diagnosed(rows), "turns")
    there = F.col("code").isNotNull()
    count = lambda c: F.count_if(c).cast("long")                        # noqa: E731
    fault = lambda name: count(F.col("fault") == name).alias(name)      # noqa: E731
    turn = F.when(there, F.col("turn")).cast("long")
    told = turns.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.countDistinct(turn), F.lit(0)).cast("long").alias("gaps"),
        fault("blank"), fault("duplicate"), fault("truncated"), count(F.col("illegal")).alias("illegal"))
    # one character a turn
    codes = turns.groupBy("conv_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.when(there, F.struct("place", "code")))), lambda x: x["code"]), "").alias("codes"))

    @F.pandas_udf("cost long, audit string")
    def solve(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cheapest(c) for c in batch], columns=["cost", "audit"])

    solved = written(codes.select("conv_id", solve("codes").alias("x")).select("conv_id", "x.*"), "audits")
    # the audit is the row in front of its conversation's turns
    stream = solved.select(F.col("conv_id").alias("conv"), F.lit(0).alias("place"), F.lit("").alias("role"),
                           F.col("audit").alias("text")).unionAll(
        turns.where(there).select("conv_id", "place", "role", "text"))
    digests = stream.repartition("conv").sortWithinPartitions("conv", "place").mapInPandas(
        _digests, f"conv {kind.simpleString()}, repaired_sha256 string")
    out = told.join(solved.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    out = out.join(digests, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair_report(conversations: DataFrame) -> DataFrame:
    """The damaged ``conversations``, repaired; one row for every conv_id of the table."""
    return repair(damaged(conversations.select("conv_id", "turn", "role", "text")))
