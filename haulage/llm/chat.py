"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: all turns before it as context, then
the reply, the only part under the loss mask. Turns after the last reply, or a
conversation without one, give one more example without a target, so the output
holds every turn.

A turn reads ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts each
``<``, any backslashes, ``|`` gets one backslash more, so no text can hold a
control string, and taking one backslash away gives the text back. A role's own
backslashes and line breaks are written ``\\b`` and ``\\n`` first.

Defined results: null role and null text are empty; turns are ordered by turn
(null last), then role and text, so ties and repeated rows keep all their rows;
null conv_id is a conversation of its own; an empty table gives no examples;
columns other than these four are not read.

Memory: a conversation is one row, as its turns have to stand in one example.
Examples are built one at a time from the row that holds the turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns in the example, text, loss_start (from 0), loss_length, last.

    ``last`` marks the example that holds all turns of its conversation.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    order = F.col("turn").cast("long")
    turn = F.struct(
        order.isNull().alias("unordered"),
        order.alias("turn"),
        role.alias("role"),
        text.alias("text"),
    )
    whole = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    head = lambda x: F.concat(F.lit(START), escape_role(x["role"]), F.lit("\n"))
    marked = whole.select(
        "conv_id",
        F.transform("turns", lambda x: F.concat(head(x), escape(x["text"]), F.lit(f"{END}\n"))).alias("blocks"),
        F.transform(
            "turns",
            lambda x: F.when(x["role"] == TARGET_ROLE, F.length(escape(x["text"]))).otherwise(F.lit(-1)),
        ).alias("targets"),
    )
    count = F.size("targets")
    ends = F.filter(F.sequence(F.lit(1), count), lambda i: (F.get("targets", i - 1) >= 0) | (i == count))
    each = marked.withColumn("n", F.explode(ends))
    target = F.get("targets", F.col("n") - 1)
    body = F.array_join(F.slice("blocks", 1, F.col("n")), "")
    made = each.select("conv_id", F.col("n").cast("long").alias("n_turns"), body.alias("text"), target.alias("target"), (F.col("n") == count).alias("last"))
    trained = F.col("target") >= 0
    return made.select(
        "conv_id",
        "n_turns",
        "text",
        F.when(trained, F.length("text") - len(END) - 1 - F.col("target")).alias("loss_start"),
        F.when(trained, F.col("target")).otherwise(0).alias("loss_length"),
        "last",
    )


def parsed(text: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    blocks = F.filter(F.split(text, r"<\|im_start\|>"), lambda x: x != "")
    end = F.lit(f"{END}\n")

    def one(block):
        cut = F.instr(block, F.lit("\n"))
        inner = F.substr(block, cut + 1, F.length(block) - cut - F.length(end))
        return F.struct(
            unescape_role(F.substr(block, F.lit(1), cut - 1)).alias("role"), unescape(inner).alias("text")
        )

    return F.transform(blocks, one)


def digests(made: DataFrame) -> DataFrame:
    """Per conversation, what the examples say when read back.

    Examples of a conversation already lie together, so nothing is shuffled;
    each is reduced to its own digest columns before they are gathered.
    """
    turns = F.transform(parsed(F.col("text")), lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    loss = unescape(F.substr(F.col("text"), F.col("loss_start") + 1, F.col("loss_length")))
    read = made.select(
        "conv_id",
        "n_turns",
        F.length("text").cast("long").alias("chars"),
        F.when(F.col("last"), F.sha2(F.array_join(turns, "").cast("binary"), 256)).alias("turns_sha256"),
        F.when(F.col("loss_start").isNotNull(), F.struct(F.col("n_turns").alias("at"), loss.alias("loss"))).alias("reply"),
    )
    replies = F.array_join(F.transform(F.array_sort(F.collect_list("reply")), lambda x: x["loss"]), "")
    return (
        read.groupBy("conv_id")
        .agg(
            F.max("n_turns").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            replies.alias("loss"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            "n_turns",
            "turns_sha256",
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
