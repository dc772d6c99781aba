"""Chat formatting as a relational job (DataFrame functions only).

The turns of a conversation are collected and sorted, adjacent turns of one role become one block,
and blocks are written one after another::

    <s> role [INST] text [/INST] text of the next turn </s>     (without the blanks)

Control strings inside texts and roles get one more backslash after their first character
(``</s>`` becomes ``<\\/s>``, ``<\\/s>`` becomes ``<\\\\/s>``), so no text can hold a control string and the
escape can be taken back. The loss mask is a list of code point ranges of the formatted text, one
for each assistant turn.

Defined results: null texts and roles count as empty; turns are ordered by turn (nulls first), then role,
then text, and repeated rows are turns of their own; rows of a null conversation id make one
conversation; an empty table gives an empty result; other columns are not read. One conversation is
one row of the result, so a conversation has to fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD, NEXT, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
ESCAPE = (r"([<\[])(\\*)(/?s>|/?INST\])", r"$1\\$2$3")
UNESCAPE = (r"([<\[])\\(\\*)(/?s>|/?INST\])", "$1$2$3")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, *ESCAPE)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *UNESCAPE)


def merge_turns(turns: Column) -> Column:
    """``array<struct<role, texts>>`` of sorted turns, a block for each run of one role."""
    first = F.filter(
        F.sequence(F.lit(1), F.size(turns)),
        lambda i: (i == 1) | (F.element_at(turns, i)["role"] != F.get(turns, i - 2)["role"]),
    )

    def block(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("starts"), k + 1), F.size(turns) + 1)
        texts = F.transform(F.slice(turns, start, end - start), lambda t: escape(t["text"]))
        return F.struct(escape(F.element_at(turns, start)["role"]).alias("role"), texts.alias("texts"))

    return first, F.transform("starts", block)


def loss_spans(blocks: Column, roles: tuple[str, ...]) -> Column:
    """``array<struct<start, n>>``: the code points of each text of ``roles`` in the formatted text, from 0."""
    kind = "array<struct<start:int,n:int>>"

    def body(state: Column, block: Column) -> Column:
        """Move over the texts of a block, keeping their places if the role counts."""

        def text(inner: Column, x: Column) -> Column:
            here = F.array(F.struct(inner["at"].alias("start"), F.length(x).alias("n")))
            kept = F.when(block["role"].isin(*map(plain, roles)), here).otherwise(F.array().cast(kind))
            return F.struct(
                (inner["at"] + F.length(x) + len(NEXT)).alias("at"), F.concat(inner["spans"], kept).alias("spans")
            )

        head = state["at"] + len(OPEN) + F.length(block["role"]) + len(HEAD)
        moved = F.aggregate(block["texts"], F.struct(head.alias("at"), F.array().cast(kind).alias("spans")), text)
        return F.struct(
            (moved["at"] - len(NEXT) + len(CLOSE)).alias("at"), F.concat(state["spans"], moved["spans"]).alias("spans")
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))
    return F.aggregate(blocks, start, body)["spans"]


def plain(role: str) -> str:
    if any(control in role for control in (OPEN, HEAD, NEXT, CLOSE)):
        raise ValueError("a role with a loss can't hold a control string")
    return role


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv_id, formatted, loss_spans`` of ``turns(conv_id, turn, role, text)``."""
    empty = F.lit("")
    row = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    collected = turns.select("conv_id", row.alias("row")).groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    starts, blocks = merge_turns(F.col("turns"))
    merged = collected.withColumn("starts", starts).select("conv_id", blocks.alias("blocks"))

    def written(block: Column) -> Column:
        return F.concat(F.lit(OPEN), block["role"], F.lit(HEAD), F.array_join(block["texts"], NEXT), F.lit(CLOSE))

    return merged.select(
        "conv_id",
        F.array_join(F.transform("blocks", written), "").alias("formatted"),
        loss_spans(F.col("blocks"), loss_roles).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """``array<struct<role, text>>``: the turns that were written, from the formatted text alone."""

    def block(written: Column) -> Column:
        role_and_texts = F.split(F.substr(written, F.lit(len(OPEN) + 1)), r"\[INST\]")
        texts = F.split(F.element_at(role_and_texts, 2), r"\[/INST\]")
        role = unescape(F.element_at(role_and_texts, 1))
        return F.transform(texts, lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    blocks = F.split(formatted, CLOSE)
    return F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), block))


def loss_texts(formatted: Column, spans: Column) -> Column:
    """``array<string>``: the texts under the loss mask, escapes taken back."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["n"])))
