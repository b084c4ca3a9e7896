"""Chat formatting by event-sourced reconstruction, in DataFrame expressions only.

Events (conv_id, seq, kind, message, role, text) are partitioned by conversation, sorted
by sequence and folded: ``message`` opens a message (or replaces it), ``delta`` appends streamed text,
``edit`` and ``regenerate`` replace what was there, ``delete`` withdraws the message.  The
final messages are rendered in the order of their first event.

Template of a turn: ``### Role: text </turn>`` and a line feed.  Inside roles and texts the characters that
control strings are made of are escaped reversibly (``ESCAPES``), so a rendered text
never holds a control string.  The loss mask lists (start, length) in
code points of the assistant texts within the rendered part.

A conversation is rendered in parts of ``PART`` sequence numbers: each part is a bounded
group, and only finished strings meet when the parts of a conversation are joined.

Cases: null text or role is the empty one; null seq sorts first; equal seq sorts by
role, then text, and each row of an input without message ids is a message of its own; a null
conv_id is a conversation; deltas without an opening event open the message; empty tables
give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanflow.llm.spans import sums_before

PART = 64
#: Escape of each character that control strings need; the backslash comes first.
ESCAPES = (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
TURN_END = "</turn>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Undoes ``escape``: an escaped text is cut at its double backslashes first, so no code is read across them."""
    def piece(p: Column) -> Column:
        for plain, code in ESCAPES[1:]:
            p = F.replace(p, F.lit(code), F.lit(plain))
        return p
    return F.array_join(F.transform(F.split(text, r"\\\\"), piece), "\\")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, seq, role, text), seq that of the message's first event."""
    e = F.struct(F.col("seq"), F.coalesce("role", F.lit("")).alias("role"),
                 F.coalesce("text", F.lit("")).alias("text"), F.coalesce("kind", F.lit("message")).alias("kind"))
    log = events.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list(e)).alias("log"))
    # what counts is the last event that sets the text, and the deltas after it: found by its place, joined once
    last = F.array_max(F.transform("log", lambda x, i: F.when(x["kind"] != "delta", i + 1).otherwise(1)))
    log = log.withColumn("kept", F.slice("log", last, F.size("log")))
    named = F.filter("log", lambda x: x["role"] != "")
    texts = F.transform("kept", lambda x: F.when(x["kind"] == "delete", "").otherwise(x["text"]))
    return (log.where(F.element_at("log", -1)["kind"] != "delete").select(
        "conv_id", "message", F.col("log")[0]["seq"].alias("seq"),
        F.when(F.size(named) > 0, F.get(named, F.size(named) - 1)["role"]).otherwise("").alias("role"), F.array_join(texts, "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """Parts (conv_id, part, n_turns, formatted, loss_mask) of each conversation.

    ``loss_mask`` is an array of (start, length), code points from the start of the part's ``formatted``.
    """
    own = F.struct("seq", "role", "text", "message")
    turn = messages.withColumn("part", F.floor(F.coalesce(F.col("seq"), F.lit(-1)) / PART))
    turn = turn.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(own)).alias("turns"))
    head = lambda t: F.concat(F.lit("### "), escape(t["role"]), F.lit(": "))
    rendered = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), escape(t["text"]).alias("body"), (F.lower(t["role"]) == LOSS_ROLE).alias("loss")))
    end = f" {TURN_END}\n"
    parts = turn.select("conv_id", "part", F.size("turns").cast("long").alias("n_turns"), rendered.alias("r"))
    before = sums_before(F.transform("r", lambda t: F.length(t["head"]) + F.length(t["body"]) + len(end)))
    mask = F.zip_with("r", before, lambda t, at: F.when(t["loss"], F.struct(
        (at + F.length(t["head"])).cast("int").alias("start"), F.length(t["body"]).alias("length"))))
    return parts.select("conv_id", "part", "n_turns",
                        F.array_join(F.transform("r", lambda t: F.concat(t["head"], t["body"], F.lit(end))), "").alias("formatted"),
                        F.array_compact(mask).alias("loss_mask"))


def read_back(parts: DataFrame) -> DataFrame:
    """Parses rendered parts: adds turns (array of (role, text)) and loss_text, from ``formatted`` and ``loss_mask`` alone."""
    turn = F.filter(F.split("formatted", f" {TURN_END}\n"), lambda t: t != "")
    parsed = F.transform(turn, lambda t: F.struct(
        unescape(F.substring_index(F.substring(t, 5, 1 << 30), ": ", 1)).alias("role"),
        unescape(F.substring(t, F.instr(t, F.lit(": ")) + 2, F.lit(1 << 30))).alias("text")))
    loss = F.transform("loss_mask", lambda m: unescape(F.substring(F.col("formatted"), m["start"] + 1, m["length"])))
    return parts.withColumn("turns", parsed).withColumn("loss_text", F.array_join(loss, ""))


def join_parts(parts: DataFrame, **texts: Column) -> DataFrame:
    """One row per conversation: n_turns and, for each named expression over a part, the parts' strings joined in order."""
    rows = parts.select("conv_id", "n_turns", F.struct("part", *[c.alias(k) for k, c in texts.items()]).alias("p"))
    whole = rows.groupBy("conv_id").agg(F.sum("n_turns").alias("n_turns"), F.array_sort(F.collect_list("p")).alias("ps"))
    return whole.select("conv_id", "n_turns", *[F.array_join(F.col(f"ps.{k}"), "").alias(k) for k in texts])


def format_conversations(events: DataFrame) -> DataFrame:
    """Events to rendered parts: fold, then render."""
    return render(fold_events(events))
