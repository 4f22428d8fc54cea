"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are its context, and only its text is under the loss
mask. A conversation that does not end with an assistant turn gets one more example over all its turns with an empty mask, so
that nothing of it is lost. A turn is formatted as

    <|turn|>role\\ntext<|end|>\\n

where control strings inside roles and texts are escaped with a backslash code each, and the backslash itself too, so that no
text can end a turn or open another and every text comes back exactly.

A window over (conversation, order of turns) carries the preceding turns; conversations are the unit, so a task holds one
conversation's prefix at a time. The output grows with the square of a conversation's turns, as the expansion asks for.

Defined results: turns are ordered by turn, role and text, nulls first; null texts and roles are empty; repeated rows are turns
like any other; a null conv_id is a conversation; an empty table gives no examples. Extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from drawdown.llm.common import whole
from drawdown.session import materialise

TURN, END = "<|turn|>", "<|end|>\n"

#: Control strings and their escapes, the backslash first.
ESCAPES = (
    ("\\", "\\b"),
    ("<|", "<\\p"),
    ("</s>", "<\\e"),
    ("<s>", "<\\s"),
    ("[INST]", "[\\i"),
    ("[/INST]", "[\\o"),
)
LINE = ("\n", "\\n")


def escape(text: Column, line: bool = False) -> Column:
    """The text without control strings; `line` also escapes line ends."""
    for plain, coded in (*ESCAPES, *([LINE] if line else [])):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, line: bool = False) -> Column:
    for plain, coded in reversed((*ESCAPES, *([LINE] if line else []))):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example (number of turns before the target), text, loss_start, loss_end, whole of each example.

    loss_start and loss_end are code points of `text`; `whole` says that the example holds the entire conversation.
    """
    head = F.concat(F.lit(TURN), escape(whole("role"), line=True), F.lit("\n"))
    turns = conversations.select("conv_id", "turn", whole("role").alias("role"), whole("text").alias("text"))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    formatted = turns.select(
        "conv_id", "turn", "role", "text", head.alias("head"), escape(F.col("text")).alias("body")
    ).withColumn("formatted", F.concat("head", "body", F.lit(END)))
    placed = formatted.select(
        "conv_id",
        "role",
        "head",
        "body",
        "formatted",
        F.row_number().over(in_order).alias("number"),
        F.lead(F.lit(True), 1, False).over(in_order).alias("more"),
        F.collect_list("formatted").over(before).alias("prefix"),
    )
    target = F.col("role") == "assistant"
    context = F.array_join("prefix", "")
    start = F.length(context) + F.length("head")
    return placed.filter(target | ~F.col("more")).select(
        "conv_id",
        (F.col("number") - 1).alias("example"),
        F.concat(context, "formatted").alias("text"),
        F.when(target, start).otherwise(0).alias("loss_start"),
        F.when(target, start + F.length("body")).otherwise(0).alias("loss_end"),
        (~F.col("more")).alias("whole"),
    )


def turns_of(text: Column) -> Column:
    """Role and text of each turn of a formatted example, unescaped."""

    def turn(part: Column) -> Column:
        cut = F.locate("\n", part)
        role = F.substring(part, F.lit(len(TURN) + 1), cut - (len(TURN) + 1))
        body = F.substring(part, cut + 1, F.length(part))
        return F.struct(unescape(role, line=True).alias("role"), unescape(body).alias("text"))

    # A text cannot hold the end of a turn, so that every piece but the last, empty one is a turn.
    return F.transform(F.array_remove(F.split(text, r"<\|end\|>\n"), ""), turn)


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars per conversation, from its examples."""
    said = F.transform(turns_of(F.col("text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    rows = formatted.select(
        "conv_id",
        "example",
        F.when(F.col("whole"), F.size(turns_of(F.col("text")))).cast("long").alias("n_turns"),
        F.when(F.col("whole"), F.sha2(F.array_join(said, ""), 256)).alias("turns_sha256"),
        masked.alias("masked"),
        F.length("text").cast("long").alias("chars"),
    )
    in_order = F.array_sort(F.collect_list(F.struct("example", "masked")))
    loss = F.array_join(F.transform(in_order, lambda x: x["masked"]), "")
    return rows.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.sum(F.length("masked")).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.sum("chars").alias("formatted_chars"),
    )


def control_turns(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts look like control strings."""
    return spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )


def report(conversations: DataFrame) -> DataFrame:
    """The digests of all conversations and of conversation -1, from examples written and read back."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    every = rows.unionByName(control_turns(conversations.sparkSession))
    return read_back(materialise(examples(every), "chat-examples"))
