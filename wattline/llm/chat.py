"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only its text is trainable.
Turns are marked by control strings; a control string inside a text is escaped, reversibly, so that a text can't
open or close a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"

#: What separates a role from its text, and turns from each other.
_BREAK = "\n"


def escape(text: Column) -> Column:
    """Put one more backslash between ``<`` and ``|``: no control string is left, and the step can be undone."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role is one line: backslashes and line breaks in it are escaped as well."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    plain = F.replace(unescape(role), F.lit("\\\\"), F.lit("\x00"))
    return F.replace(F.replace(plain, F.lit("\\n"), F.lit("\n")), F.lit("\x00"), F.lit("\\"))


def examples(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Training examples: ``conv_id, example, n_turns, text, loss_start, loss_chars``.

    Example ``k`` (from 0) ends with the conversation's ``k``-th assistant turn; ``loss_start`` (from 0) and
    ``loss_chars`` are, in characters, the one span of its text under the loss mask. If turns follow the last
    assistant turn, or there is none, a last example holds the whole conversation without a trainable span
    (``loss_chars`` null).

    Turns are ordered by turn, then role, then text, nulls first; repeated rows are turns of their own. A null text
    or role is empty; a null ``conv_id`` is one conversation. A conversation is one row, so it must fit in a task;
    the examples of one are written one at a time. An empty table has no examples.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    name = F.coalesce(F.col(role), F.lit(""))
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), name.alias("role"), body.alias("text")).alias("row"),
    )
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    heads = F.transform("rows", lambda r: F.concat(F.lit(START), escape_role(r["role"]), F.lit(_BREAK)))
    bodies = F.transform("rows", lambda r: escape(r["text"]))
    marked = whole.select(
        "conv_id",
        heads.alias("heads"),
        bodies.alias("bodies"),
        F.transform("rows", lambda r: r["role"] == ASSISTANT).alias("trained"),
    ).withColumn(
        "parts", F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b, F.lit(END + _BREAK)))
    )
    ends = F.filter(F.sequence(F.lit(1), F.size("parts")), lambda i: F.element_at("trained", i))
    last = F.size("parts")
    tail = F.when(F.element_at("trained", -1), F.array().cast("array<int>")).otherwise(F.array(last))
    cut = marked.select("*", F.posexplode(F.concat(ends, tail)).alias("example", "n_turns"))
    context = F.array_join(F.slice("parts", 1, F.col("n_turns") - 1), "")
    target = F.element_at("trained", F.col("n_turns"))
    head = F.element_at("heads", F.col("n_turns"))
    return cut.select(
        "conv_id",
        "example",
        F.col("n_turns").cast("long").alias("n_turns"),
        F.concat(context, F.element_at("parts", F.col("n_turns"))).alias("text"),
        F.when(target, F.char_length(context) + F.char_length(head)).cast("long").alias("loss_start"),
        F.when(target, F.char_length(F.element_at("bodies", F.col("n_turns")))).cast("long").alias("loss_chars"),
    )


def turns_of(text: Column) -> Column:
    """The turns of a formatted text: an array of ``role, text``."""
    parts = F.split(text, F.lit(r"<\|im_end\|>\n"))
    parts = F.slice(parts, 1, F.size(parts) - 1)
    bare = F.transform(parts, lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(
        bare,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, _BREAK, 1)).alias("role"),
            unescape(F.substr(p, F.char_length(F.substring_index(p, _BREAK, 1)) + 2)).alias("text"),
        ),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """What the examples of each conversation say, read from their texts alone.

    ``conv_id, turns`` (all, from the longest example), ``loss`` (the unescaped text under the masks, in order) and
    ``formatted_chars`` (of all the conversation's examples).
    """
    masked = unescape(F.substr("text", (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int")))
    marked = F.when(F.col("loss_chars").isNotNull(), F.struct("example", masked.alias("loss")))
    grouped = formatted.groupBy("conv_id").agg(
        F.max_by("text", "n_turns").alias("text"),
        F.array_sort(F.collect_list(marked)).alias("losses"),
        F.sum(F.char_length("text")).alias("formatted_chars"),
    )
    return grouped.select(
        "conv_id",
        turns_of(F.col("text")).alias("turns"),
        F.array_join(F.col("losses.loss"), "").alias("loss"),
        "formatted_chars",
    )
