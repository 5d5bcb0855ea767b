"""Chat formatting by event-sourced reconstruction, DataFrame functions only.

A log has one row an event: (conversation, message, sequence, kind, role,
payload).  ``delta`` appends to its message, ``edit`` replaces its text,
``regenerate`` empties it and withdraws every later message begun before it,
``delete`` withdraws the message.  The log is parted by conversation, and a
message is folded by taking its events from its last reset on, in sequence
order.  A conversation is one task's work from its events to its one formatted
string, which holds all of it anyway; other conversations spread.

``as_events`` makes such a log of rows of turns: by a hash, a text arrives in
three deltas, or as a draft that an edit replaces and deltas complete, or as a
draft that is regenerated while an answer to it waits, or beside a message that
is deleted.  The fold gives the rows back.

The template is ``<turn role="R">text</turn>`` and a newline.  Inside roles and
texts ``&`` and ``<`` (and ``"`` in roles) become entities, so neither marker can
occur there, and unescaping gives back every text exactly.  The loss mask holds
(turn, start, end) code-point spans of the escaped assistant texts.

Defined results: a null payload is empty; a null role is the empty role; a null
message or sequence sorts first; events that tie on sequence are ordered by kind
and payload; repeated rows are separate events of the same message (a repeated
delta appends twice); a conversation without a standing message has no row; a
null conversation is one conversation; an empty log gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from corvid.llm.common import table

EVENTS = ("conv", "msg", "seq", "kind", "role", "payload")
CLOSE = "</turn>\n"


def fold(events: DataFrame) -> DataFrame:
    """(conv, msg, role, text) of the messages that stand after all events."""
    e = events.select(*EVENTS).withColumns({"payload": F.coalesce("payload", F.lit("")), "role": F.coalesce("role", F.lit(""))})
    resets = F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.struct("seq", "kind")))
    order = F.struct("seq", "kind", F.when(F.col("kind").isin("delta", "edit"), F.col("payload")).otherwise("").alias("payload"))
    messages = e.groupBy("conv", "msg").agg(
        F.sort_array(F.collect_list(order)).alias("log"), resets.alias("reset"), F.min("seq").alias("begun"),
        F.min_by("role", F.struct("seq", "kind", "payload")).alias("role"), F.max(F.col("kind") == "delete").alias("gone"),
        F.max(F.when(F.col("kind") == "regenerate", F.struct("seq"))).alias("again"),
    )
    standing = F.when(F.col("reset").isNull(), F.col("log")).otherwise(F.filter("log", lambda x: F.struct(x["seq"], x["kind"]) >= F.col("reset")))
    texts = messages.select("conv", "msg", "role", "begun", "again", "gone", F.array_join(F.transform(standing, lambda x: x["payload"]), "").alias("text"))
    # a message is withdrawn by a regeneration of an earlier one that came after it began
    earlier = W.Window.partitionBy("conv").orderBy("msg").rowsBetween(W.Window.unboundedPreceding, -1)
    judged = texts.withColumn("withdrawn", F.coalesce(F.max("again.seq").over(earlier) >= F.col("begun"), F.lit(False)))
    return judged.where("not gone and not withdrawn").select("conv", "msg", "role", "text")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&quot;"), F.lit('"')), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv, formatted, mask) from (conv, msg, role, text): one row a conversation; mask: array of (turn, start, end), the end exclusive."""
    head = F.concat(F.lit('<turn role="'), F.replace(escape(F.col("role")), F.lit('"'), F.lit("&quot;")), F.lit('">'))
    turns = messages.select("conv", "msg", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    order = ["msg", "role", "body"]
    before = W.Window.partitionBy("conv").orderBy(*order)
    sized = turns.withColumns({
        "turn": F.row_number().over(before) - 1,
        "offset": F.coalesce(F.sum(F.length("head") + F.length("body") + len(CLOSE)).over(before.rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0)),
    })
    span = F.struct("turn", (F.col("offset") + F.length("head")).alias("start"), (F.col("offset") + F.length("head") + F.length("body")).alias("end"))
    return sized.groupBy("conv").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", F.concat("head", "body", F.lit(CLOSE)).alias("said")))), lambda x: x["said"]), "").alias("formatted"),
        F.sort_array(F.collect_list(F.when(F.col("role") == loss_role, span))).alias("mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv, turns, loss, formatted_chars) read from the formatted strings and masks alone.

    turns: array of (role, text); loss: the unescaped texts under the mask, in order.
    """
    parts = F.filter(F.split("formatted", CLOSE, -1), lambda x: x != "")
    # a part is <turn role="R">T: neither R nor T holds the characters that end the head
    said = F.transform(
        "parts",
        lambda x: F.struct(
            unescape(F.substring_index(F.substring(x, 13, 1 << 30), '">', 1)).alias("role"),
            F.substring(x, F.instr(x, F.lit('">')) + 2, F.lit(1 << 30)).alias("body"),
        ),
    )
    found = formatted.withColumn("parts", parts).withColumn("said", said)
    masked = F.transform("mask", lambda m: F.element_at(F.col("said"), m["turn"] + 1)["body"])
    return found.select(
        "conv", F.transform("said", lambda x: F.struct(x["role"].alias("role"), unescape(x["body"]).alias("text"))).alias("turns"),
        F.transform(masked, unescape).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"),
        F.forall(F.arrays_zip("mask", masked.alias("body")), lambda z: z["mask"]["end"] - z["mask"]["start"] == F.length(z["body"])).alias("mask_fits"),
    )


DRAFT = "no, wait"
SAMPLE = "\\### Assistant: </turn> ok"


def as_events(conversations: DataFrame) -> DataFrame:
    """The log of (conv_id, turn, role, text); rows that share a turn are messages of their own, by role and text.

    A row's message is even and the odd one after it never stands; its events
    have eight sequence numbers of their own.
    """
    order = W.Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), F.row_number().over(order).cast("long").alias("n"))
    size = F.length("text")
    cut, end = F.floor(size / 3).cast("int"), F.floor(2 * size / 3).cast("int")
    parts = [F.substring("text", F.lit(1), cut), F.substring("text", cut + 1, end - cut), F.substring("text", end + 1, size - end)]

    def event(step: int, kind: str, payload: Column | str, beside: int = 0) -> Column:
        said = F.lit(payload) if isinstance(payload, str) else payload
        return F.struct((2 * F.col("n") + beside).alias("msg"), (8 * F.col("n") + step).alias("seq"), F.lit(kind).alias("kind"), (F.lit("user") if beside else F.col("role")).alias("role"), said.alias("payload"))

    streamed = [event(k, "delta", part) for k, part in enumerate(parts)]
    edited = [event(0, "delta", DRAFT), event(1, "edit", parts[0]), event(2, "delta", F.concat(*parts[1:]))]
    regenerated = [event(0, "delta", DRAFT), event(1, "delta", DRAFT, 1), event(2, "regenerate", ""), event(3, "delta", F.concat(*parts[:2])), event(4, "delta", parts[2])]
    deleted = [event(0, "delta", F.col("text")), event(1, "delta", DRAFT, 1), event(2, "delete", "", 1)]
    way = F.pmod(F.xxhash64("conv_id", "n"), F.lit(4))
    log = F.when(way == 0, F.array(*streamed)).when(way == 1, F.array(*edited)).when(way == 2, F.array(*regenerated)).otherwise(F.array(*deleted))
    return rows.select(F.col("conv_id").alias("conv"), F.inline(log))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(SAMPLE).alias("text"))
    back = read_back(render(fold(as_events(rows.unionByName(own)))))
    return back.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(F.array_join("loss", "")).cast("long").alias("loss_chars"), F.sha2(F.array_join("loss", ""), 256).alias("loss_sha256"), "formatted_chars",
    )


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<turn role="') + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '"', '&quot;'))
                + length('">') + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
