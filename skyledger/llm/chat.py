"""Chat formatting with Spark expressions only: one training text per conversation, and its reading back.

The template writes a block for each run of turns of one role::

    <s>role[INST]text[INST]text</s>          any other role
    <s>assistant[/INST]text</s>              the assistant: text after [/INST] is trained on

A control string inside a role or text gets a ``~`` after its first character, and one more if
it has some already, so that the template's own marks are the only ones left and each text can
be read back exactly. Control strings begin with ``<`` or ``[`` and hold neither inside, so none
can arise where a text meets a mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"([<\[])(~*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])~(~*)(/?(?:s>|INST\]))"
LEARNT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, "$1~$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def merged_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, blocks``: each conversation's turns in order, neighbours of one role merged.

    ``turns`` needs ``conv_id, turn, role, text``. ``blocks`` is an array of ``role`` and ``texts``.
    Null roles and texts count as empty. Turns of equal number follow each other by role and
    text, a null number comes first, repeated rows stay. A null ``conv_id`` is a conversation. A conversation
    becomes one text, so one task holds it; the time is proportional to its turns, and to their number times its logarithm for the order.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    starts = F.expr(
        "filter(sequence(1, size(turns)), i -> i = 1 or turns[i - 1].role <> turns[greatest(i - 2, 0)].role)"
    )
    blocks = F.expr(
        "transform(starts, (s, i) -> struct(turns[s - 1].role as role,"
        " transform(slice(turns, s, coalesce(get(starts, i + 1), size(turns) + 1) - s), t -> t.text) as texts))"
    )
    return grouped.withColumn("starts", starts).select("conv_id", blocks.alias("blocks"))


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted``: one text per conversation. For the input see :func:`merged_turns`."""

    def block(b: Column) -> Column:
        mark = F.when(b["role"] == LEARNT, F.lit("[/INST]")).otherwise(F.lit("[INST]"))
        texts = F.transform(b["texts"], lambda t: F.concat(mark, escape(t)))
        return F.concat(F.lit("<s>"), escape(b["role"]), F.array_join(texts, ""), F.lit("</s>"))

    return merged_turns(turns).select("conv_id", F.array_join(F.transform("blocks", block), "").alias("formatted"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns`` from ``conv_id, formatted``: the turns in order, each with ``role, text, learnt``."""
    blocks = F.filter(F.split("formatted", "</s>"), lambda b: b != "")
    parts = F.transform(blocks, lambda b: F.split(b, r"(?=\[/?INST\])"))  # the first is <s> and the role

    def turns_of(p: Column) -> Column:
        return F.transform(
            F.slice(p, F.lit(2), F.size(p) - 1),
            lambda t: F.struct(
                unescape(F.substr(p[0], F.lit(4))).alias("role"),
                unescape(F.regexp_replace(t, r"^\[/?INST\]", "")).alias("text"),
                t.startswith("[/INST]").alias("learnt"),
            ),
        )

    return formatted.withColumn("parts", parts).select(
        "conv_id", "formatted", F.flatten(F.transform("parts", turns_of)).alias("turns")
    )


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What can be read back of each formatted conversation: counts and SHA-256 of turns and loss text."""
    back = read_chats(formatted)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform(F.filter("turns", lambda t: t["learnt"]), lambda t: t["text"]), "")
    return back.withColumn("loss", learnt).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
