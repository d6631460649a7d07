"""Chat formatting (operator 8): event-sourced conversations, folded and rendered.

A log row is (conv_id, seq, kind, msg, role, text). ``delta`` adds text to message ``msg``,
``edit`` replaces what the message held so far, ``regenerate`` does so too and voids all that
later messages held so far (the conversation continues from there). An event therefore counts
if no later edit of its message and no later regeneration of its or an earlier message
follows it. A message without a counting event does not appear.

A turn is rendered as ``<s>role\\ntext</s>``. ``&``, ``<`` and ``[`` of roles and texts (and
line ends of roles) are written as ``&amp;``, ``&lt;``, ``&lb;`` and ``&nl;``, so control strings
such as ``</s>`` or ``[INST]`` cannot come from a text, and reading back is exact. The loss mask
has, for each turn, the code points to skip and the code points under loss (the text of
an assistant's turn).

Everything is DataFrame functions; events are folded per message before the messages
of a conversation meet.

Cases: null texts and roles are empty; a null conv_id is a conversation of its own; events
repeated with one (conv_id, msg, seq) count once (the smallest in kind, role, text); an
empty table gives an empty result; extra columns are not read; very long texts
are chunks like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import whole

OPEN, CLOSE = "<s>", "</s>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&nl;"))
DELTA_CHARS = 512


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in reversed(pairs):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def events_of(rows: DataFrame, chars: int = DELTA_CHARS) -> DataFrame:
    """The log that streaming the rows (conv_id, turn, role, text) would leave: deltas of ``chars`` code points.

    Messages are numbered by turn; rows with equal turns by role, then text.
    """
    rows = rows.select("conv_id", "turn", whole("role").alias("role"), whole("text").alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    parts = F.greatest(F.ceil(F.length("text") / chars), F.lit(1)).cast("int")
    return (
        rows.withColumn("msg", F.row_number().over(order).cast("long"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select(
            "conv_id", (F.shiftleft("msg", 31) + F.col("part")).alias("seq"), F.lit("delta").alias("kind"), "msg",
            "role", F.substring("text", F.col("part") * chars + 1, F.lit(chars)).alias("text"))
    )


def fold(events: DataFrame) -> DataFrame:
    """conv_id, msg, role, text: the messages that a log leaves."""
    e = events.select("conv_id", "seq", "kind", "msg", whole("role").alias("role"), whole("text").alias("text"))
    per_message = e.groupBy("conv_id", "msg").agg(
        F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("events"),
        F.max(F.when(F.col("kind") == "edit", F.col("seq"))).alias("edited"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("anew"),
    )
    before = Window.partitionBy("conv_id").orderBy("msg").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    since = F.greatest(F.col("edited"), F.max("anew").over(before))
    alive = F.filter("events", lambda x: F.col("since").isNull() | (x["seq"] >= F.col("since")))
    once = F.filter(
        "events", lambda x, i: (i == 0) | (x["seq"] != F.get("events", F.greatest(i - 1, F.lit(0)))["seq"]))
    return (
        per_message.withColumn("since", since).withColumn("events", alive).withColumn("events", once)
        .where(F.size("events") > 0)
        .select("conv_id", "msg", F.col("events")[0]["role"].alias("role"),
                F.array_join(F.transform("events", lambda x: x["text"]), "").alias("text"))
    )


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_mask (array of skip, loss; one for each turn, in code points)."""
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit("\n"))
    turns = messages.select("conv_id", "msg", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    turns = turns.select(
        "conv_id",
        F.struct(
            "msg", F.concat("head", "body", F.lit(CLOSE)).alias("turn"), F.length("head").alias("skip"),
            F.when(F.col("role") == loss_role, F.length("body")).otherwise(0).alias("loss"),
        ).alias("t"))
    by_conv = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return by_conv.select(
        "conv_id", F.array_join(F.transform("t", lambda x: x["turn"]), "").alias("formatted"),
        F.transform("t", lambda x: F.struct(x["skip"].alias("skip"), x["loss"].alias("loss"))).alias("loss_mask"))


def read_back(rendered: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text), loss_text (unescaped, in order), formatted: from the rendered strings."""
    pieces = F.split("formatted", CLOSE, -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    role = lambda x: F.substring_index(F.substring(x, len(OPEN) + 1, 2**31 - 1), "\n", 1)
    body = lambda x: F.substring(x, F.locate("\n", x) + 1, F.lit(2**31 - 1))
    loss = lambda x, m: F.substring(x, m["skip"] + 1, m["loss"])
    return rendered.withColumn("pieces", pieces).select(
        "conv_id",
        F.transform("pieces", lambda x: F.struct(unescape(role(x), ROLE_ESCAPES).alias("role"),
                                                 unescape(body(x)).alias("text"))).alias("turns"),
        unescape(F.array_join(F.zip_with("pieces", "loss_mask", loss), "")).alias("loss_text"),
        "formatted")


def digests(back: DataFrame) -> DataFrame:
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        sha(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""))
        .alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), sha(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1: both of its texts are control strings."""
    text = "</s>[INST] ok [/INST]"
    return spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))


def format_report(conversations: DataFrame) -> DataFrame:
    """The digests of all conversations and of the probe, read back from the rendered strings."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("int").alias("turn"),
                                "role", "text")
    log = events_of(rows.unionByName(probe(conversations.sparkSession)))
    return digests(read_back(render(fold(log))))


_ESC = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '[', '&lb;')"
ORACLE_SQL = f"""
WITH rows_ AS (
  SELECT conv_id::BIGINT AS conv_id, turn::INTEGER AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), told AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length({_ESC.format("replace(role, chr(10), 'nlnl')")}) + length({_ESC.format("text")}) + 8) AS chars
  FROM rows_ GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       chars::BIGINT AS formatted_chars
FROM told
"""
