"""Chat formatting from an event log.

A log has rows (conversation, seq, event, message, role, text). Per conversation, in the order of
``seq``, the events fold into final messages:

* ``message`` opens a message with its role and first text (again: starts the text anew);
* ``delta`` appends to the text; ``edit`` replaces it;
* ``regenerate`` empties the text and removes all messages opened between that message and the
  event, whether or not the message itself was removed before.

The fold is a few window and aggregate functions over one shuffle by conversation: the last
replacing event of a message decides which deltas count, and a running maximum of regenerations
tells which messages they removed. A message of any length has its deltas together, as it is one
value of the result; a conversation likewise, when it is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template. Texts hold neither ``#`` nor ``<`` once escaped, so both marks are unambiguous.
HEAD, END = "### ", "</turn>\n"
#: In this order for escaping, the other way round for reading. Backslash comes first.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"))
#: Characters of one streamed delta, where whole texts are turned into events.
DELTA_CHARS = 1024
PIECE_BITS = 24


def escape(text: Column, table=ESCAPES) -> Column:
    for raw, safe in table:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column, table=ESCAPES) -> Column:
    for raw, safe in reversed(table):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def as_events(turns: DataFrame) -> DataFrame:
    """An event log of (conv_id, turn, role, text) rows: each opens a message and streams its text.

    Rows go by turn, then role, then text, nulls first; each row is a message of its own, repeated
    rows included. Null role and null text: empty.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    rows = rows.withColumn("message", F.row_number().over(order).cast("long"))
    pieces = F.ceil(F.length("text") / F.lit(DELTA_CHARS)).cast("int")
    piece = F.explode(F.sequence(F.lit(0), F.greatest(pieces - 1, F.lit(0))))
    cut = rows.select("conv_id", "message", "role", "text", piece.alias("piece"))
    start = F.col("piece") * F.lit(DELTA_CHARS) + 1
    return cut.select(
        "conv_id",
        (F.col("message") * F.lit(1 << PIECE_BITS) + F.col("piece")).alias("seq"),
        F.when(F.col("piece") == 0, "message").otherwise("delta").alias("event"),
        "message",
        "role",
        F.substring(F.col("text"), start, F.lit(DELTA_CHARS)).alias("text"),
    )


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, opened, role, text) of the final messages; ``opened`` orders them.

    Ties of ``seq`` go by event name, message and text, nulls first. Events for a message that no
    event opened, or before it opened, are void, and so are unknown events. Null text: empty; null
    role: null. A null conversation or message id is an id like others. Other columns are ignored.
    """
    order = Window.partitionBy("conv_id").orderBy("seq", "event", "message", "text")
    kind = F.coalesce(F.col("event"), F.lit(""))
    log = events.select(
        "conv_id",
        F.row_number().over(order).alias("n"),
        kind.alias("event"),
        "message",
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    opens = F.col("event") == "message"
    resets = F.col("event").isin("message", "edit", "regenerate")
    carries = F.col("event").isin("message", "edit", "delta")
    messages = log.groupBy("conv_id", "message").agg(
        F.min(F.when(opens, F.col("n"))).alias("opened"),
        F.min(F.when(opens, F.struct("n", "role")))["role"].alias("role"),
        F.max(F.when(resets, F.col("n"))).alias("reset"),
        F.max(F.when(F.col("event") == "regenerate", F.col("n"))).alias("regenerated"),
        F.collect_list(F.when(carries, F.struct("n", "text"))).alias("parts"),
    )
    last = F.greatest("opened", "reset")
    parts = F.filter(F.array_sort("parts"), lambda p: p["n"] >= last)
    text = F.array_join(F.transform(parts, lambda p: p["text"]), "")
    earlier = (
        Window.partitionBy("conv_id").orderBy("opened").rowsBetween(Window.unboundedPreceding, -1)
    )
    live = messages.filter(F.col("opened").isNotNull())
    regenerated = F.when(F.col("regenerated") > F.col("opened"), F.col("regenerated"))
    final = live.select(
        "conv_id", "opened", "role", text.alias("text"), regenerated.alias("regenerated")
    ).withColumn("removed", F.max("regenerated").over(earlier) > F.col("opened"))
    return final.filter(~F.coalesce("removed", F.lit(False))).select("conv_id", "opened", "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) per conversation.

    ``loss_spans`` holds start and length, in characters of ``formatted`` and from 0, of the text
    of every assistant message: the loss mask. Marks are outside it.
    """
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(HEAD), escape(role, ROLE_ESCAPES), F.lit("\n"))
    turns = messages.select(
        "conv_id", "opened", role.alias("role"), head.alias("head"), escape(F.col("text")).alias("body")
    )
    order = Window.partitionBy("conv_id").orderBy("opened")
    size = F.length("head") + F.length("body") + F.lit(len(END))
    placed = turns.withColumn("start", F.sum(size).over(order) - F.length("body") - F.lit(len(END)))
    made = placed.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "opened",
                    F.concat("head", "body", F.lit(END)).alias("turn"),
                    F.when(
                        F.col("role") == "assistant",
                        F.struct(F.col("start"), F.length("body").cast("long").alias("length")),
                    ).alias("span"),
                )
            )
        ).alias("turns")
    )
    spans = F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull())
    text = F.array_join(F.transform("turns", lambda t: t["turn"]), "")
    return made.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def format_chats(events: DataFrame) -> DataFrame:
    """Final messages of an event log, rendered."""
    return render(fold(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` (role, text) and ``loss_texts``, both read from its output."""
    pieces = F.split("formatted", END)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(head) + 2, F.length(piece))
        role = F.substring(head, F.lit(len(HEAD) + 1), F.length(head))
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(body).alias("text"))

    def under_mask(span: Column) -> Column:
        return unescape(F.substring(F.col("formatted"), (span["start"] + 1).cast("int"), span["length"].cast("int")))

    return formatted.withColumn("turns", F.transform(pieces, turn)).withColumn(
        "loss_texts", F.transform("loss_spans", under_mask)
    )
