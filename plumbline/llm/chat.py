"""Chat turns as prefix-target training examples, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.storage import clear_of

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of public chat templates that a text must not spell.
_ANGLE = r"\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>"
_SQUARE = r"/?INST\]"


def escape(text: Column) -> Column:
    """Breaks every control string by a backslash after its first character; backslashes there already get one more."""
    return F.regexp_replace(F.regexp_replace(text, rf"<(\\*)({_ANGLE})", r"<\\$1$2"), rf"\[(\\*)({_SQUARE})", r"[\\$1$2")


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`."""
    return F.regexp_replace(F.regexp_replace(text, rf"\[\\(\\*)({_SQUARE})", r"[$1$2"), rf"<\\(\\*)({_ANGLE})", r"<$1$2")


def prefix_targets(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One example for every assistant turn: all turns up to it, with only that reply trainable.

    Columns: the conversation's id; ``target`` (0-based place of the trainable turn, null for a rest); ``context_turns``;
    ``formatted``; ``loss_start`` (1-based) and ``loss_length`` in characters of ``formatted``; ``last`` (holds
    every turn). Turns after the last reply, or of a conversation without one, come as a rest with nothing trainable,
    so no turn is lost. Null roles and texts are empty; a null id is one conversation; turns are ordered by (turn,
    role, text), null first, so repeated rows are turns of their own. Other columns are not read. The output is as
    long as the prefixes together, which is what the expansion asks for; one conversation must fit one row.
    """
    said = F.struct(
        F.col(turn).isNotNull().alias("numbered"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole = turns.groupBy(F.col(conversation).alias("id")).agg(F.array_sort(F.collect_list(said)).alias("turns"))
    heads = F.transform("turns", lambda t: F.concat(F.lit(START), escape(t["role"]), F.lit(SEP)))
    bodies = F.transform("turns", lambda t: escape(t["text"]))
    whole = whole.select("id", "turns", heads.alias("heads"), bodies.alias("bodies")).withColumn(
        "pieces", F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b, F.lit(END))))
    each = whole.select("id", "heads", "bodies", "pieces", F.posexplode("turns").alias("at", "said"))
    each = each.withColumn("reply", F.col("said.role") == "assistant").withColumn("last", F.col("at") + 1 == F.size("pieces"))
    formatted = F.array_join(F.slice("pieces", 1, F.col("at") + 1), "")
    body = F.char_length(F.element_at("bodies", F.col("at") + 1))
    out = each.where("reply OR last").withColumn("formatted", formatted)
    reply = F.col("reply")
    return out.select(
        F.col("id").alias(conversation), F.when(reply, F.col("at")).alias("target"),
        F.when(reply, F.col("at")).otherwise(F.col("at") + 1).alias("context_turns"), "formatted",
        F.when(reply, F.char_length("formatted") - len(END) - body + 1).alias("loss_start"),
        F.when(reply, body).otherwise(0).alias("loss_length"), "last")


def read_turns(formatted: Column) -> Column:
    """The (role, text) structs that a formatted example spells."""
    parts = F.filter(F.split(formatted, END.replace("|", r"\|"), -1), lambda p: p != "")
    halves = F.transform(parts, lambda p: F.split(F.substr(p, F.lit(len(START) + 1)), SEP.replace("|", r"\|"), -1))
    return F.transform(halves, lambda h: F.struct(unescape(h[0]).alias("role"), unescape(h[1]).alias("text")))


def digests(examples: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Per conversation what its examples say, read back from their formatted texts and loss spans."""
    reply = unescape(F.substr(F.col("formatted"), F.col("loss_start"), F.col("loss_length")))
    (said,) = clear_of(examples, "said")
    spelled = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = examples.select(
        F.col(conversation), F.char_length("formatted").cast("long").alias("chars"), "target",
        F.when(F.col("target").isNotNull(), reply).alias("reply"), F.when(F.col("last"), spelled).alias(said))
    grouped = read.groupBy(conversation).agg(
        F.first(said, ignorenulls=True).alias(said), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("target", "reply")))).alias("replies"))
    loss = F.array_join(F.transform("replies", lambda r: r["reply"]), "")
    return grouped.select(
        conversation, F.size(said).cast("long").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
