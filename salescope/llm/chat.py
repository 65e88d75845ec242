"""Prefix-target expansion of conversations, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context, and only its reply is trained on.
Turns after the last assistant turn, or of a conversation without one, make one example without a trained part, so that
the output holds every turn. A turn is written as

    <s>role[INST]text[/INST]</s>

Inside roles and texts a backslash is doubled and one is put into each control string (``<s>`` becomes ``<\\s>``), so
control strings in the output are always marks of the template, and dropping the backslashes gives the text back.

Turns are ordered by ``turn``, then role, then text; repeated rows are repeated turns. A NULL role or text is empty, NULL
turns come first, a NULL ``conv_id`` is a conversation of its own. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
OPEN, BODY, END, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
BACKSLASH = r"\\"
CONTROL = r"(<|\[)(/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, BACKSLASH, r"\\\\"), CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def expand(conversations: DataFrame) -> DataFrame:
    """(conv_id, target, is_last, formatted, loss_start, loss_length) of rows (conv_id, turn, role, text).

    ``target`` is the place of the trained turn, from 1, NULL for an example without one. The trained part is
    ``loss_length`` characters of ``formatted`` after the first ``loss_start``.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    whole = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    rendered = whole.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == TRAINED_ROLE).alias("trained"),
        F.transform("turns", lambda t: F.char_length(escape(t["text"]))).alias("sizes"),
        F.transform(
            "turns",
            lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(BODY), escape(t["text"]), F.lit(END), F.lit(CLOSE)),
        ).alias("rendered"),
    )
    places = F.sequence(F.lit(1), F.size("trained"))
    targets = rendered.select("*", F.explode(places).alias("place")).where(
        F.expr("trained[place - 1]") | (F.col("place") == F.size("trained"))
    )
    formatted = targets.select(
        "conv_id",
        F.expr("if(trained[place - 1], place, null)").alias("target"),
        (F.col("place") == F.size("trained")).alias("is_last"),
        F.expr("array_join(slice(rendered, 1, place), '')").alias("formatted"),
        F.expr("if(trained[place - 1], sizes[place - 1], 0)").alias("loss_length"),
    )
    behind = F.col("loss_length") + len(END) + len(CLOSE)
    start = F.when(F.col("target").isNotNull(), F.char_length("formatted") - behind).otherwise(F.lit(0))
    return formatted.withColumn("loss_start", start.cast("int"))


def loss_text(examples: DataFrame) -> Column:
    """The trained text of an example, as it was before it was escaped."""
    return unescape(examples["formatted"].substr(examples["loss_start"] + 1, examples["loss_length"]))


def parsed(formatted: Column) -> Column:
    """The turns in a formatted text, array<struct<role, text>>."""
    marked = F.split(formatted, CLOSE)
    turns = F.slice(marked, 1, F.size(marked) - 1)

    def one(turn: Column) -> Column:
        role = F.substring_index(turn, BODY, 1)
        body = turn.substr(F.char_length(role) + F.lit(len(BODY) + 1), F.char_length(turn))
        return F.struct(
            unescape(role.substr(F.lit(len(OPEN) + 1), F.char_length(role))).alias("role"),
            unescape(body.substr(F.lit(1), F.char_length(body) - len(END))).alias("text"),
        )

    return F.transform(turns, one)


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the examples: its turns, the trained text, and the size of the output.

    The last example holds all turns. Each example gives only its own figures and its trained text, so no long text is
    shuffled, sorted or gathered.
    """
    turns = F.when(F.col("is_last"), parsed(F.col("formatted")))
    own = examples.select(
        "conv_id",
        F.col("target"),
        F.when(F.col("target").isNotNull(), loss_text(examples)).alias("loss"),
        F.char_length("formatted").cast("long").alias("chars"),
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
    )
    gathered = own.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("target", "loss")))), lambda x: x["loss"]), ""
        ).alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    return gathered.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
