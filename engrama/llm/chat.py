"""Chat formatting by prefix-target expansion: each assistant turn becomes a training example of its own.

A turn is written ``<|im_start|>`` role, newline, text, ``<|im_end|>``, newline.
Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so a control
string never appears in them; in roles a newline becomes ``\\n``.  ``unescape``
reverses that exactly.

The example of an assistant turn holds all turns before it as context and that
reply, of which only [loss_start, loss_end) - the escaped text - is trainable.
Turns behind the last reply are in no example; where there are such, one more row
with a null ``target`` holds the whole conversation, nothing of it trainable.

All work is DataFrame expressions.  Turns of one conversation meet in one row, as its
last example holds them all anyway; different conversations never do.

Results for odd input: null texts and roles are empty; turns are ordered by turn, then
role and text (null turns first), so ties and repeated rows keep a fixed place; rows
with a null conv_id are one conversation; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    parts = F.split(text, r"\\\\", -1)  # doubled backslashes, from the left
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\|"), F.lit("|")), F.lit("\\n"), F.lit("\n")))
    return F.when(F.contains(text, F.lit("\\")), F.array_join(plain, "\\")).otherwise(text)


def examples(turns: DataFrame, trainable: str = ASSISTANT) -> DataFrame:
    """conv_id, example (from 0), target (turn index from 0), n_turns, text, loss_start, loss_end (in code points)."""
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    talks = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    written = F.transform("turns", lambda t: F.struct(
        (t["role"] == trainable).alias("reply"),
        F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
        escape(t["text"]).alias("body"),
    ))
    talks = talks.select("conv_id", written.alias("turns"), F.size("turns").alias("n"))
    replies = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("turns", i)["reply"])
    rest = F.when(F.element_at("turns", -1)["reply"], F.array().cast("array<int>")).otherwise(F.array(F.lit(-1)))
    targets = talks.select("conv_id", "turns", "n", F.posexplode(F.concat(replies, rest)).alias("example", "at"))
    targets = targets.withColumn("target", F.nullif("at", F.lit(-1)))
    upto = F.coalesce(F.col("target") + 1, F.col("n"))
    whole = lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))
    text = F.array_join(F.transform(F.slice("turns", F.lit(1), upto), whole), "")
    body = F.length(F.get("turns", F.col("at"))["body"])
    tail = F.lit(len(END) + 1)
    return targets.select(
        "conv_id", "example", "target", upto.cast("bigint").alias("n_turns"), text.alias("text"), body.alias("_body"),
    ).select(
        "conv_id", "example", "target", "n_turns", "text",
        F.when(F.col("target").isNotNull(), F.length("text") - tail - F.col("_body")).alias("loss_start"),
        F.when(F.col("target").isNotNull(), F.length("text") - tail).alias("loss_end"),
    )


def trainable_text(row_text: str = "text") -> Column:
    """What the loss mask of an example covers, unescaped; null where nothing is trainable."""
    return unescape(F.substring(F.col(row_text), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))


def turns_of(text: Column) -> Column:
    """The turns of a formatted text: an array of (role, text), unescaped."""
    parts = F.filter(F.split(text, r"<\|im_start\|>", -1), lambda p, i: i > 0)
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.regexp_replace(p.substr(F.instr(p, "\n") + 1, F.length(p)), r"<\|im_end\|>\n$", "")).alias("text"),
    ))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, taken from the formatted examples alone."""
    read = formatted.select(
        "conv_id", "example", "n_turns", F.length("text").alias("chars"), trainable_text().alias("loss"),
        F.struct("n_turns", F.col("text")).alias("longest"),
    )
    talks = read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max("longest")["text"].alias("text"), F.sum("chars").cast("bigint").alias("formatted_chars"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: F.coalesce(x["loss"], F.lit(""))), "").alias("loss"),
        F.count("loss").alias("n_examples"),
    )
    lines = F.transform(turns_of(F.col("text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return talks.select(
        "conv_id", "n_turns", F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_examples",
    )
