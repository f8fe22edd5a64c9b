"""Chat formatting with relational operations.

Native: turns are collected as structs per conversation, the array is sorted, adjacent
turns of one role are merged by slicing the array at the changes of role, and the
pieces are concatenated, all in Spark expressions.

A turn reads ``<s>role[INST]text</s>``; texts that were merged have ``[/INST]`` between
them, so the rows can be read back. Inside roles and texts a backslash is doubled and a
control string gets a backslash after its first character; both are undone by removing
the backslash before any character.

``mask`` has the lengths of the segments (control strings, roles, texts; none empty) in
code points, with ``loss`` true for the assistant's texts only.

A conversation is one row of the result, so its rows meet in one task; escaping, the
costly part, happens before the shuffle.

Nulls: a null text or role is empty, a null turn sorts first. Rows with the same turn
sort by role, then text; repeated rows are turns of their own. Rows with a null
conversation are one conversation. Other input columns are ignored. No rows: no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, BODY, JOIN, END = "<s>", "[INST]", "[/INST]", "</s>"
_START = r"<s>|</s>|\[INST\]|\[/INST\]"
_TO_ESCAPE = r"\\|<(?=/?s>)|\[(?=/?INST\])"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _TO_ESCAPE, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``mask``."""
    one = F.struct(F.col(turn).alias("turn"), escaped(F.col(role)).alias("role"), escaped(F.col(text)).alias("text"))
    rows = (turns.select(F.col(conv_id).alias("conv_id"), one.alias("t"))
            .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")))
    t = F.col("t")
    starts = F.filter(F.sequence(F.lit(0), F.size(t) - 1),
                      lambda i: (i == 0) | (t[i]["role"] != t[F.greatest(i - 1, F.lit(0))]["role"]))
    rows = rows.withColumn("starts", starts)
    s = F.col("starts")
    merged = F.transform(s, lambda at, k: F.struct(
        t[at]["role"].alias("role"),
        F.transform(F.slice(t, at + 1, F.coalesce(F.get(s, k + 1), F.size(t)) - at), lambda x: x["text"]).alias("texts")))
    rows = rows.select("conv_id", merged.alias("m"))
    formatted = F.array_join(F.transform("m", lambda m: F.concat(
        F.lit(BEGIN), m["role"], F.lit(BODY), F.array_join(m["texts"], JOIN), F.lit(END))), "")

    def segment(length: Column, loss: Column) -> Column:
        return F.struct(length.cast("int").alias("length"), loss.alias("loss"))

    def segments(m: Column) -> Column:
        no = F.lit(False)
        head = F.array(segment(F.lit(len(BEGIN)), no), segment(F.length(m["role"]), no), segment(F.lit(len(BODY)), no))
        body = F.transform(m["texts"], lambda x, i: F.array(
            segment(F.length(x), m["role"] == ASSISTANT),
            segment(F.when(i + 1 < F.size(m["texts"]), F.lit(len(JOIN))).otherwise(F.lit(len(END))), no)))
        return F.concat(head, F.flatten(body))

    mask = F.filter(F.flatten(F.transform("m", segments)), lambda x: x["length"] > 0)
    return rows.select("conv_id", formatted.alias("formatted"), mask.alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """From ``formatted`` and ``mask``: ``turns`` (role and text of every row, unescaped)
    and ``loss_texts`` (the segments under the mask, unescaped)."""
    blocks = F.filter(F.split("formatted", END, -1), lambda x: x != "")

    def rows(block: Column) -> Column:
        body = F.regexp_replace(block, r"(?s)^.*?\[INST\]", "")
        role = unescaped(F.substring_index(F.substring(block, len(BEGIN) + 1, 1 << 30), BODY, 1))
        return F.transform(F.split(body, r"\[/INST\]", -1),
                           lambda x: F.struct(role.alias("role"), unescaped(x).alias("text")))

    parts = F.filter(F.split("formatted", f"(?<={_START})|(?={_START})", -1), lambda x: x != "")
    marked = F.zip_with(parts, "mask", lambda x, m: F.struct(x.alias("x"), m["loss"].alias("loss"),
                                                            (F.length(x) == m["length"]).alias("same")))
    checked = F.when(F.forall(marked, lambda p: F.coalesce(p["same"], F.lit(False))), marked).otherwise(
        F.raise_error(F.lit("the mask does not fit the formatted text")).cast("array<struct<x:string,loss:boolean,same:boolean>>"))
    return formatted.select(
        "*", F.flatten(F.transform(blocks, rows)).alias("turns"),
        F.transform(F.filter(checked, lambda p: p["loss"]), lambda p: unescaped(p["x"])).alias("loss_texts"))
