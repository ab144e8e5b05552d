"""Conversations and preference pairs as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.render import ChatTemplate, render_template, shared_messages
from millrace.functions.text import required

TEXT_FIELDS = ("text", "input", "prompt")


def nest_turns(df: DataFrame, conv: str, order: str, role: str, text: str) -> DataFrame:
    """One row per conversation with its messages in turn order.

    A conversation is one row of the result, so its turns have to meet.
    """
    turn = F.struct(F.col(order).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"))
    return (
        df.groupBy(conv)
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
        .select(
            conv,
            F.transform(
                "turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))
            ).alias("conversations"),
        )
    )


def select_text(
    df: DataFrame, key: str, renderer: Callable[[Column], Column] | None = None, only: str | None = None
) -> DataFrame:
    """``(key, text)`` from whichever field the table has; all other columns go.

    The first present of ``conversations``, ``text``, ``input`` and ``prompt`` counts
    for the whole table. ``only`` names the one field to accept.
    """
    wanted = [only] if only else ["conversations", *TEXT_FIELDS]
    found = next((field for field in wanted if field in df.columns), None)
    if found is None:
        raise ValueError(f"the table has none of the fields {', '.join(wanted)}")
    if found == "conversations":
        if renderer is None:
            raise ValueError("conversations need a renderer")
        text = renderer(F.col(found))
    else:
        text = required(F.col(found), found)
    return df.select(key, text.alias("text"))


def preference_pairs(
    df: DataFrame, key: str, template: ChatTemplate, prompt_mode: str = "chosen"
) -> DataFrame:
    """``(key, prompt, chosen, rejected)`` as rendered text.

    ``prompt_mode="chosen"`` gives the whole chosen text as the prompt as well;
    ``"common_prefix"`` gives the leading messages that both sides share, and leaves
    only what follows them on either side.
    """
    chosen, rejected = F.col("chosen"), F.col("rejected")
    if prompt_mode == "chosen":
        return df.select(
            key,
            render_template(chosen, template).alias("prompt"),
            render_template(chosen, template).alias("chosen"),
            render_template(rejected, template).alias("rejected"),
        )
    if prompt_mode != "common_prefix":
        raise ValueError("prompt_mode must be 'chosen' or 'common_prefix'")

    def rest(messages: Column) -> Column:
        return F.slice(messages, F.col("_shared") + 1, F.size(messages))

    return df.withColumn("_shared", shared_messages(chosen, rejected)).select(
        key,
        render_template(F.slice(chosen, F.lit(1), F.col("_shared")), template).alias("prompt"),
        render_template(rest(chosen), template).alias("chosen"),
        render_template(rest(rejected), template).alias("rejected"),
    )
