"""Chat formatting with Spark expressions only.

A conversation's rows are collected as turn structs and sorted; adjacent rows
of one role become one message; each message is written as

    [INST]role[/INST]text[SEP]text</s>

``[SEP]`` keeps the rows of a merged message apart, so the rows can be read
back. Inside roles and texts, backslashes are doubled and one backslash is put
after the first character of every control string, so no text can close or
open a message and the escape is reversible.

Defined cases: null text or role is the empty string; rows of one conversation
are ordered by (turn, role, text), null turns first, and repeated rows stay; a
null conv_id is one conversation; an empty table gives no rows; other columns
are not read. A conversation is one output row by definition, so its turns
meet in one task; they are reduced to that row and nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = ("[INST]", "[/INST]", "[SEP]", "</s>")
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    """Left to right: a doubled backslash is one, a single one goes."""
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"\\(\\?)", "$1")).otherwise(text)


def format_conversations(rows: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``conv_id, formatted, segments, n_messages`` for rows of (conv_id,
    turn, role, text). ``segments`` is the loss mask: consecutive pieces of
    ``formatted`` (their concatenation is ``formatted``), each with ``loss``
    true where a model should learn it (the texts of ``loss_role``)."""
    turn = F.struct(rows["turn"].alias("turn"), F.coalesce(rows["role"], F.lit("")).alias("role"),
                    F.coalesce(rows["text"], F.lit("")).alias("text"))
    convs = rows.select(rows["conv_id"].alias("conv_id"), turn.alias("t")) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    n = F.size("turns")
    # First row of each message: where the role differs from the row before.
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (
        F.get(F.col("turns"), i)["role"] != F.get(F.col("turns"), i - 1)["role"]))
    convs = convs.select("conv_id", "turns", starts.alias("starts"))
    ends = F.concat(F.slice("starts", 2, F.greatest(F.size("starts") - 1, F.lit(0))), F.array(n))
    messages = F.zip_with("starts", ends, lambda a, b: F.struct(
        F.get(F.col("turns"), a)["role"].alias("role"),
        F.transform(F.slice(F.col("turns"), a + 1, b - a), lambda t: t["text"]).alias("texts")))
    convs = convs.select("conv_id", messages.alias("messages"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def message_segments(m: Column) -> Column:
        head = segment(F.concat(F.lit("[INST]"), escape(m["role"]), F.lit("[/INST]")), F.lit(False))
        body = F.transform(m["texts"], lambda t, i: F.array(
            segment(F.when(i > 0, F.lit("[SEP]")).otherwise(F.lit("")), F.lit(False)),
            segment(escape(t), m["role"] == F.lit(loss_role))))
        return F.concat(F.array(head), F.flatten(body), F.array(segment(F.lit("</s>"), F.lit(False))))

    segments = F.flatten(F.transform("messages", message_segments))
    convs = convs.select("conv_id", F.size("messages").cast("long").alias("n_messages"), segments.alias("segments"))
    return convs.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                        "segments", "n_messages")


def read_turns(formatted: Column) -> Column:
    """The rows of a formatted conversation, in order: array of (role, text),
    parsed from the string alone."""
    def rows_of(message: Column) -> Column:
        body = F.substring(message, F.lit(len("[INST]") + 1), F.length(message))
        cut = F.locate("[/INST]", body)
        role = F.substring(body, F.lit(1), cut - 1)
        texts = F.split(F.substring(body, cut + len("[/INST]"), F.length(body)), r"\[SEP\]", -1)
        return F.transform(texts, lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    messages = F.filter(F.split(formatted, "</s>", -1), lambda m: m != "")
    return F.flatten(F.transform(messages, rows_of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
