"""Messages rendered as text. A null role or content reads ``None``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import required


class ChatTemplate(NamedTuple):
    """Text around each message: ``before role between content after``."""

    before: str = "<s>"
    between: str = "\n"
    after: str = "</s>\n"


def _text(field: Column) -> Column:
    return F.coalesce(field, F.lit("None"))


def _render(messages: Column, line) -> Column:
    return F.array_join(F.transform(required(messages, "message list"), line), "")


def render_role_prefix(messages: Column) -> Column:
    """``role: content`` and a newline for every message."""
    return render_template(messages, ChatTemplate("", ": ", "\n"))


def render_human_assistant(messages: Column) -> Column:
    """``Human: `` before user messages and ``Assistant: `` before all others."""
    return _render(
        messages,
        lambda m: F.concat(
            F.when(m["role"] == "user", F.lit("Human: ")).otherwise(F.lit("Assistant: ")),
            _text(m["content"]),
            F.lit("\n"),
        ),
    )


def render_template(messages: Column, template: ChatTemplate) -> Column:
    """Every message set in ``template``, with no suffix asking for an answer."""
    return _render(
        messages,
        lambda m: F.concat(
            F.lit(template.before),
            _text(m["role"]),
            F.lit(template.between),
            _text(m["content"]),
            F.lit(template.after),
        ),
    )


def shared_messages(left: Column, right: Column) -> Column:
    """How many leading messages two lists have in common."""
    same = F.zip_with(left, right, lambda a, b: a.eqNullSafe(b))
    return F.coalesce(
        F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.size(same)
    ).cast("int")
