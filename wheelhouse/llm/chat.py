"""Chat formatting by prefix-target expansion: one training example for every assistant turn.

An example holds the turns of a conversation up to one assistant turn; that reply alone is trainable, all turns before
it are context.  Turns after the last assistant turn, or a conversation without any, give one closing example with
nothing to learn, so that no turn is lost.

A turn is written as ``<|im_start|>role newline text<|im_end|> newline``.  Control strings cannot arise from what a
turn says: in roles and texts every ``<`` followed by any number of backslashes and ``|`` gets one more backslash
before the ``|``, and reading takes one away.  In a role, backslashes and line feeds are escaped as well.

Null roles and texts count as empty.  Turns are ordered by turn number (null first), then role and text, so that equal
numbers have a fixed order; repeated rows are turns of their own.  A null conv_id is a conversation like any other.
An empty table gives no examples.  Only built-in column functions are used.

A conversation is one row while it is expanded, and its examples together are as long as the method asks for: the sum
of all its prefixes, each in a row of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, TARGET_ROLE = "<|im_start|>", "<|im_end|>", "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    plain = unescape(role)
    # A backslash pair must not lend its second half to an "n": pairs are set aside first.
    held = F.replace(plain, F.lit("\\\\"), F.lit("\\0"))
    return F.replace(F.replace(held, F.lit("\\n"), F.lit("\n")), F.lit("\\0"), F.lit("\\"))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, text, loss_start, loss_end) from (conv_id, turn, role, text).

    ``n_turns`` counts the turns of the example; loss_start and loss_end are code points of ``text``, equal in a
    closing example.
    """
    role, body = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), escape_role(role), F.lit("\n"))
    written = F.struct(
        "turn",
        role.alias("role"),
        body.alias("body"),
        (role == TARGET_ROLE).alias("target"),
        F.length(head).alias("head"),
        F.concat(head, escape(body), F.lit(END + "\n")).alias("segment"),
    )
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(written)).alias("turns"))
    size = F.size("turns")
    wanted = F.filter(
        F.sequence(F.lit(1), size),
        lambda i: F.get(F.col("turns"), i - 1)["target"] | (i == size),
    )
    each = turns.select("conv_id", "turns", F.explode(wanted).alias("upto"))
    last = F.get(F.col("turns"), F.col("upto") - 1)
    context = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("upto") - 1), lambda t: t["segment"]), "")
    shown = each.select("conv_id", "upto", last.alias("last"), context.alias("context"))
    end = F.length("context") + F.length("last.segment") - len(END) - 1
    start = F.when(F.col("last.target"), F.length("context") + F.col("last.head")).otherwise(end)
    return shown.select(
        "conv_id",
        F.col("upto").cast("long").alias("n_turns"),
        F.concat("context", "last.segment").alias("text"),
        start.cast("long").alias("loss_start"),
        end.cast("long").alias("loss_end"),
    )


def turns_of(text: Column) -> Column:
    """The turns (role, text) that an example says, read back from it."""
    parts = F.array_remove(F.split(text, "<\\|im_end\\|>\n", -1), "")

    def turn(part: Column) -> Column:
        bare = F.substr(part, F.lit(len(START) + 1))
        return _let(
            F.instr(bare, "\n"),
            lambda cut: F.struct(
                unescape_role(F.substr(bare, F.lit(1), cut - 1)).alias("role"),
                unescape(F.substr(bare, cut + 1)).alias("text"),
            ),
        )

    return F.transform(parts, turn)


def masked(text: Column, start: Column, end: Column) -> Column:
    """What an example trains on, unescaped."""
    return unescape(F.substr(text, (start + 1).cast("int"), (end - start).cast("int")))
