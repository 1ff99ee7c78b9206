"""Chat formatting with expressions only.

A block ``<:role>text</>`` is a run of turns of one role; ``<+>`` divides the turns in it. In roles
and texts the three control characters are written as \\s (backslash), \\l (<) and \\g (>), so no
text can look like a mark, and every formatted string reads back to exactly the turns it came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The role whose text is trained on.
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\s"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescaped(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("\\g"), F.lit(">")), F.lit("\\l"), F.lit("<"))
    return F.replace(out, F.lit("\\s"), F.lit("\\"))


def format_chats(turns: DataFrame, trained: str = TRAINED) -> DataFrame:
    """``(conv_id, formatted, segments)``, a row for each conversation of ``turns(conv_id, turn, role, text, …)``.

    Turns are collected as structs and sorted by turn (ties: role, then text); neighbours of one
    role form one block. ``segments`` is an array of ``(text, loss)`` whose texts, joined, are
    ``formatted``; loss is true for the texts of the trained role only, never for marks.

    Null roles and texts count as empty, null turns come first, rows of a null conv_id are one
    conversation, repeated rows stay as turns of their own, no rows give no rows, other columns are
    ignored. A conversation becomes one row, whatever its length, since its formatted string is one
    value; the work is linear in its turns.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sorted_turns = F.sort_array(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text"))))
    chats = turns.groupBy("conv_id").agg(sorted_turns.alias("turns"))
    starts = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: (i == 1) | (F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"] != F.element_at("turns", i)["role"]),
    )
    chats = chats.withColumn("starts", starts)
    runs = F.transform(
        "starts",
        lambda s, k: F.slice("turns", s, F.coalesce(F.get("starts", k + 1), F.size("turns") + 1) - s),
    )
    chats = chats.select("conv_id", runs.alias("runs"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def block(run: Column) -> Column:
        role = run[0]["role"]
        inner = F.flatten(
            F.transform(
                run,
                lambda t, i: F.array(
                    segment(F.when(i == 0, F.concat(F.lit("<:"), escaped(role), F.lit(">"))).otherwise(F.lit("<+>")), F.lit(False)),
                    segment(escaped(t["text"]), role == trained),
                ),
            )
        )
        return F.concat(inner, F.array(segment(F.lit("</>"), F.lit(False))))

    chats = chats.select("conv_id", F.flatten(F.transform("runs", block)).alias("segments"))
    return chats.select("conv_id", F.array_join(F.col("segments")["text"], "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns ``array<struct<role, text>>`` of a formatted string."""
    blocks = F.split(formatted, "</>")
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        head = F.substring_index(block, ">", 1)
        texts = F.split(F.substr(block, F.length(head) + 2), r"<\+>")
        return F.transform(texts, lambda t: F.struct(unescaped(F.substr(head, F.lit(3))).alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped, joined."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescaped(s["text"])), "")
