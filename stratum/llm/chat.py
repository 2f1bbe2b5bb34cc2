"""Chat formatting and prefix-target expansion, in DataFrame functions only.

``conversations`` writes each conversation as one text; ``examples`` explodes every assistant turn
into a training example: all turns before it are context, and only that reply is trainable.
``parse`` reads turns back from a formatted text.

Template: ``[SYS]text[/SYS]``, ``[INST] text [/INST]``, ``text</s>`` for system, user and assistant
turns, ``[ROLE hex]text[/ROLE]`` for any other role (its UTF-8 bytes in hex; ``-`` for null).  A
control string inside a text loses its first character to ``~1`` (``<``) or ``~2`` (``[``), and ``~``
before 0, 1 or 2 becomes ``~0``; so escaped texts hold no control string and nothing else changes.

Turns go by (turn, role, text), null first; rows that repeat are turns of their own.  Null texts
count as empty and null roles are kept apart from empty ones; a null conv_id is a conversation.
Offsets are in code points.  Rows are shuffled once, by conversation; a conversation must fit in a
row, as its text does.  Examples hold spans into the conversation's one text, so many turns do not
multiply it; ``with_text`` writes the context out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN = ("[SYS]", "[INST] ", "[ROLE ")
CLOSE = ("[/SYS]", " [/INST]", "[/ROLE]", "</s>")
_TURN = r"(?s)(\[SYS\]|\[INST\] |\[ROLE [-0-9A-F]*\]|)(.*?)(\[/SYS\]| \[/INST\]|\[/ROLE\]|</s>)"


def escape(text: Column) -> Column:
    """``text`` without control strings; ``unescape`` undoes it."""
    out = F.regexp_replace(text, "~(?=[012])", "~0")
    out = F.regexp_replace(out, r"<(?=/?s>)", "~1")
    return F.regexp_replace(out, r"\[(?=/?INST\]|/?SYS\]|ROLE |/ROLE\])", "~2")


def unescape(text: Column) -> Column:
    """The text that ``escape`` was given."""
    out = F.replace(text, F.lit("~2"), F.lit("["))
    out = F.replace(out, F.lit("~1"), F.lit("<"))
    return F.replace(out, F.lit("~0"), F.lit("~"))


def _marked(role: Column, body: Column) -> tuple[Column, Column]:
    """(opening mark, closing mark) of a turn."""
    other = F.concat(F.lit("[ROLE "), F.coalesce(F.hex(F.encode(role, "UTF-8")), F.lit("-")), F.lit("]"))
    opening = F.when(role == "system", "[SYS]").when(role == "user", "[INST] ").when(role == "assistant", "").otherwise(other)
    closing = F.when(role == "system", "[/SYS]").when(role == "user", " [/INST]").when(role == "assistant", "</s>").otherwise("[/ROLE]")
    return opening, closing


def conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, replies array<struct<from, to>>): the spans of assistant texts in ``formatted``, in order."""
    rows = df.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    opening, closing = _marked(F.col("role"), F.col("text"))
    rows = rows.withColumns({"opening": opening, "body": escape(F.col("text")), "closing": closing})
    rows = rows.withColumn("piece", F.concat("opening", "body", "closing"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("piece").cast("long")).over(order), F.lit(0)))
    reply = F.struct((F.col("at") + F.length("opening")).alias("from"), (F.col("at") + F.length("opening") + F.length("body")).alias("to"))
    whole = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", reply))).alias("replies"),
    )
    return whole.select("conv_id", F.array_join(F.col("pieces.piece"), "").alias("formatted"), "replies")


def examples(formatted: DataFrame) -> DataFrame:
    """(conv_id, example, formatted, context_to, target_from, target_to): one row per assistant turn.

    The context is ``formatted`` up to ``context_to``; the loss mask is the target's span."""
    each = formatted.select("conv_id", "formatted", F.posexplode("replies").alias("example", "reply"))
    return each.select("conv_id", "example", "formatted", F.col("reply.from").alias("context_to"), F.col("reply.from").alias("target_from"), F.col("reply.to").alias("target_to"))


def target() -> Column:
    """The text under an example's loss mask, still escaped."""
    return F.substring(F.col("formatted"), (F.col("target_from") + 1).cast("int"), (F.col("target_to") - F.col("target_from")).cast("int"))


def with_text(expanded: DataFrame) -> DataFrame:
    """Examples with context and target written out: conv_id, example, context, target (both escaped)."""
    return expanded.select("conv_id", "example", F.substring(F.col("formatted"), F.lit(1), F.col("context_to").cast("int")).alias("context"), target().alias("target"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns of a formatted conversation, unescaped."""
    group = lambda i: F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(i))
    turns = F.arrays_zip(group(1).alias("opening"), group(2).alias("body"))
    hexed = lambda x: F.regexp_extract(x, r"\[ROLE ([-0-9A-F]*)\]", 1)
    role = lambda x: (
        F.when(x == "[SYS]", "system").when(x == "[INST] ", "user").when(x == "", "assistant").when(x != "[ROLE -]", F.decode(F.unhex(hexed(x)), "UTF-8"))
    )
    return F.transform(turns, lambda t: F.struct(role(t["opening"]).alias("role"), unescape(t["body"]).alias("text")))


def digests(df: DataFrame) -> DataFrame:
    """What the formatted output gives back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    formatted = conversations(df)
    losses = examples(formatted).select("conv_id", "example", unescape(target()).alias("reply"))
    losses = losses.groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("example", "reply")))["reply"], "").alias("loss"))
    losses = losses.select(F.col("conv_id").alias("of"), "loss")
    turns = formatted.select("conv_id", parse(F.col("formatted")).alias("turns"), F.length("formatted").cast("long").alias("formatted_chars"))
    line = lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))
    joined = turns.join(losses, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    loss = F.coalesce("loss", F.lit(""))
    return joined.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
