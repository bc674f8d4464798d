r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one training example: all turns before it are context, and only its text is trainable (the
loss mask is one span of code points). Turns after the last reply go into one more example without a trainable span, so
that no turn is lost.

Template, a turn: <|im_start|>ROLE<|im_sep|>TEXT<|im_end|>\n. Inside roles and texts a backslash is doubled, and a control
string (of this template or of other common ones) gets a backslash after its first character; taking a backslash away
before each character that follows one restores the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: control strings that must not stand in a text, by their first characters
CONTROL = ("<|", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)\\\\(.)", "$1")


def chat_examples(turns: DataFrame) -> DataFrame:
    """A row per example: conv_id, example (from 0), last (whether it is the conversation's longest), formatted, loss_start, loss_end.

    turns needs conv_id, turn, role and text. Rows of a conversation are ordered by turn, then role and text (so that ties
    and repeated rows have one order; repeated rows are turns of their own; a null turn comes first). Null role or text is
    the empty string. Rows with null conv_id form one conversation. loss_start and loss_end are code points, end exclusive;
    both are null where an example has no reply. A conversation without replies gives one example. An empty table gives
    no rows.
    """
    blank = F.lit("")
    rows = turns.select("conv_id", F.struct(F.col("turn").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")).alias("t"))
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    shown = F.transform("ts", lambda t: F.concat(F.lit(START), escaped(t["role"]), F.lit(SEP), escaped(t["text"]), F.lit(END)))
    replies = F.filter(F.transform("ts", lambda t, i: F.when(t["role"] == "assistant", i + 1)), lambda i: i.isNotNull())
    talks = talks.select("conv_id", shown.alias("shown"), replies.alias("replies"), F.size("ts").alias("n"))
    ends = F.when((F.size("replies") == 0) | (F.element_at("replies", -1) < F.col("n")), F.concat("replies", F.array("n"))).otherwise(F.col("replies"))
    each = talks.select("conv_id", "shown", "n", F.array_contains("replies", F.col("n")).alias("ended"), F.posexplode(ends).alias("example", "upto"))
    each = each.select("conv_id", "example", (F.col("upto") == F.col("n")).alias("last"), (F.col("upto") < F.col("n")) | F.col("ended"), F.array_join(F.slice("shown", 1, F.col("upto")), "").alias("formatted"), F.length(F.element_at("shown", F.col("upto"))).alias("tail"))
    each = each.toDF("conv_id", "example", "last", "reply", "formatted", "tail")
    start = F.length("formatted") - F.col("tail") + len(START + "assistant" + SEP)
    return each.select(
        "conv_id", "example", "last", "formatted",
        F.when(F.col("reply"), start).alias("loss_start"),
        F.when(F.col("reply"), F.length("formatted") - len(END)).alias("loss_end"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """What the formatted examples hold, a row per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Turns are parsed from the conversation's longest example; the text under the loss mask is cut from each example, in
    order, and unescaped. formatted_chars counts the code points of all its examples.
    """
    pieces = F.slice(F.split("formatted", "<\\|im_start\\|>"), 2, 1 << 30)
    turn = lambda p: F.concat(unescaped(F.substring_index(p, SEP, 1)), F.lit("\n"), unescaped(F.regexp_extract(p, "(?s)<\\|im_sep\\|>(.*)<\\|im_end\\|>\n$", 1)), F.lit("\n"))
    lost = unescaped(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    read = examples.select(
        "conv_id", "example", F.length("formatted").cast("long").alias("chars"),
        F.coalesce(lost, F.lit("")).alias("loss"),
        F.when(F.col("last"), F.size(pieces).cast("long")).alias("n_turns"),
        F.when(F.col("last"), F.sha2(F.array_join(F.transform(pieces, turn), "").cast("binary"), 256)).alias("turns_sha256"),
    )
    by = read.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"), F.sum("chars").alias("formatted_chars"))
    loss = F.array_join(F.col("losses.loss"), "")
    return by.select("conv_id", "n_turns", "turns_sha256", F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
