"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted by (turn, role, text); adjacent turns of one role
become one block; blocks are concatenated:

    <|im_start|>role \\n text <|next|> text ... <|im_end|> \\n

``<|next|>`` stands between merged turns, so that they can be told apart again. Control strings inside a role or text
are made harmless, reversibly: every backslash is doubled, then a backslash goes in after the first character of each
control string (and before a line end in a role). Reading back drops each backslash that precedes another character.

The output holds ``segments`` (text, loss), whose texts in order are ``formatted``; loss marks the assistant's texts
and nothing else. One shuffle by conversation, with one row a conversation as its result; a conversation is one
output value, so its turns meet in one task.

Null texts and roles are empty; a null turn sorts first; equal turns are ordered by role and text; repeated rows are
turns of their own; rows with a null id form one conversation; an empty table gives an empty result; other columns are
left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, NEXT, END = "<|im_start|>", "<|next|>", "<|im_end|>\n"
#: Control strings of common chat templates.
CONTROLS = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: key, segments, formatted."""
    rows = turns.select(F.col(key).alias(key), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    chats = rows.groupBy(key).agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def pieces(t, i):
        previous = F.when(i > 0, F.get("turns", i - 1).getField("role"))
        header = F.concat(F.lit(START), F.replace(escaped(t["role"]), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
        opening = F.when(i == 0, header).when(previous == t["role"], F.lit(NEXT)).otherwise(F.concat(F.lit(END), header))
        return F.array(F.struct(opening.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escaped(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")))

    closing = F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    segments = F.concat(F.flatten(F.transform("turns", pieces)), closing)
    return (chats.select(key, segments.alias("segments"))
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    blocks = F.split(formatted, r"<\|im_end\|>\n")
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def block(b):
        inner = F.substring(b, F.lit(len(START) + 1), F.length(b))
        head = F.regexp_extract(inner, r"(?s)^((?:[^\\\n]++|\\.)*+)\n", 1)
        body = F.substring(inner, F.length(head) + 2, F.length(inner))
        return F.transform(F.split(body, r"<\|next\|>"), lambda x: F.struct(unescaped(head).alias("role"), unescaped(x).alias("text")))

    return F.flatten(F.transform(blocks, block))


def report(turns: DataFrame, key: str = "conv_id", **names) -> DataFrame:
    """One row a conversation, read back from the output: turns and loss digests."""
    out = format_chats(turns, key, **names).withColumn("read", read_turns(F.col("formatted")))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
    told = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (out.withColumn("loss", loss).select(
        key, F.size("read").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars")))
