"""Chat formatting from an event log.

The log of a conversation is partitioned by conversation and sorted by sequence; streamed deltas append to a message,
an edit replaces what it has so far, a regeneration discards it and starts anew. Final messages stand where their first
event stood and are rendered with a template whose control strings cannot come from a text. Main path: DataFrame
functions only.

Null roles and texts count as empty; a null conversation is a conversation of its own; equal sequence numbers are
ordered by role, then text; repeated rows are separate events; an empty log gives no conversation. The output of a
conversation is one string, as its readers need it, so one conversation has to fit in one row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from disclosa.llm.common import digest

#: The template's own control strings.
OPEN, BODY, CLOSE = "<|turn|>", "<|text|>", "<|done|>"
#: A control string's first character with what has to follow; those of other templates are broken too.
CONTROL_START = r"(<(?=\|turn\|>|\|text\|>|\|done\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>)|\[(?=/?INST\]))"

EVENT = ("conv_id", "seq", "message_id", "kind", "role", "text")


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put after the first character of every control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL_START, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def events_of(conversations: DataFrame) -> DataFrame:
    """EVENT rows of whole messages (conv_id, turn, role, text): one event for each row."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", role, text)
    return conversations.select("conv_id", "turn", "role", "text").select(
        "conv_id",
        F.col("turn").cast("long").alias("seq"),
        F.row_number().over(order).cast("long").alias("message_id"),
        F.lit("delta").alias("kind"),
        role.alias("role"),
        text.alias("text"),
    )


def fold(events: DataFrame) -> DataFrame:
    """conv_id, at, role, text: the final messages of EVENT rows; at numbers a conversation's messages from 1."""
    message = Window.partitionBy("conv_id", "message_id")
    reset = F.max(F.when(F.col("kind") != "delta", F.struct("seq", "role", "text"))).over(message)
    here = F.struct("seq", "role", "text")
    marked = events.select(
        "conv_id", "message_id", "seq", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "kind"
    ).withColumns({"reset": reset, "first": F.min("seq").over(message)})
    live = marked.where(F.col("reset").isNull() | (here >= F.col("reset")))
    parts = F.array_sort(F.collect_list(F.struct(F.coalesce("seq", F.lit(-(2**62))).alias("seq"), "role", "text")))
    done = live.groupBy("conv_id", "message_id").agg(F.min("first").alias("first"), parts.alias("parts"))
    order = Window.partitionBy("conv_id").orderBy("first", "message_id")
    return done.select(
        "conv_id",
        F.row_number().over(order).alias("at"),
        F.element_at("parts", 1)["role"].alias("role"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, loss_mask (spans of formatted in code points, end exclusive) of fold()'s messages."""
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(BODY))
    turns = messages.select("conv_id", "at", "role", head.alias("head"), escaped(F.col("text")).alias("body"))
    piece = F.concat("head", "body", F.lit(CLOSE))
    before = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length(piece).cast("long")).over(before), F.lit(0)) + F.length("head")
    placed = turns.select(
        "conv_id", "at", piece.alias("piece"), F.col("role").isin(*learned).alias("learned"), start.alias("start"), F.length("body").alias("n")
    )
    grouped = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "piece", "learned", "start", "n"))).alias("t"))
    mask = F.transform(F.filter("t", lambda x: x["learned"]), lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["n"]).alias("end")))
    return grouped.select("conv_id", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"), mask.alias("loss_mask"))


def format_chats(events: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask for every conversation of EVENT rows."""
    return render(fold(events))


def read_back(formatted: DataFrame, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """The digests of a conversation, taken from formatted and loss_mask alone; every turn is visited once."""
    opened = OPEN.replace("|", r"\|")
    pieces = formatted.select("conv_id", "formatted", "loss_mask", F.slice(F.split("formatted", opened, -1), 2, 2**31 - 2).alias("p"))

    def role(x: Column) -> Column:
        return F.substring_index(x, BODY, 1)

    def body(x: Column) -> Column:
        return F.substring(x, F.length(role(x)) + len(BODY) + 1, F.length(x) - F.length(role(x)) - len(BODY) - len(CLOSE))

    turns = F.array_join(F.transform("p", lambda x: F.concat(unescaped(role(x)), F.lit("\n"), unescaped(body(x)), F.lit("\n"))), "")
    # The k-th span lies in the k-th learned turn: it is cut there, by its length, not from the start of the string.
    cut = F.zip_with(
        F.filter("p", lambda x: unescaped(role(x)).isin(*learned)),
        F.col("loss_mask"),
        lambda x, s: F.substring(x, F.length(role(x)) + len(BODY) + 1, (s["end"] - s["start"]).cast("int")),
    )
    return pieces.select("conv_id", "formatted", F.size("p").cast("long").alias("n_turns"), digest(turns).alias("turns_sha256"), unescaped(F.array_join(cut, "")).alias("learned")).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("learned").cast("long").alias("loss_chars"),
        digest(F.col("learned")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
