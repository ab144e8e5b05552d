"""Queries over conversations and preference pairs as text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import fragments as q
from millrace.catalog import tables as t
from millrace.functions.render import (
    ChatTemplate,
    render_human_assistant,
    render_role_prefix,
    render_template,
)
from millrace.operators.conversations import preference_pairs
from millrace.operators.user_map import map_batches


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.transform("conversations", lambda m: F.concat(m["role"], F.lit("="), m["content"]))
    return t.conversations(spark, sf_dir).select(
        "conv_id", F.size("conversations").alias("n_turns"), F.array_join(message, "|").alias("turns")
    )


def role_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.conversations(spark, sf_dir)
    return rows.select("conv_id", render_role_prefix(F.col("conversations")).alias("text"))


def human_assistant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.conversations(spark, sf_dir)
    return rows.select("conv_id", render_human_assistant(F.col("conversations")).alias("text"))


def chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.conversations(spark, sf_dir)
    return rows.select(
        "conv_id", render_template(F.col("conversations"), ChatTemplate()).alias("text")
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_pairs(t.preferences(spark, sf_dir), "conv_id", ChatTemplate())


def pairs_common_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.preferences(spark, sf_dir)
    return preference_pairs(rows, "conv_id", ChatTemplate(), "common_prefix")


def _measure(batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "doc_id": batch["doc_id"],
            "n_spaces": batch["text"].str.count(" ").astype("int64"),
            "longest_line": batch["text"].map(lambda s: max(map(len, s.split("\n")))).astype("int64"),
        }
    )


def user_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "doc_id BIGINT, n_spaces BIGINT, longest_line BIGINT"
    return map_batches(t.documents(spark, sf_dir), _measure, schema)


_SIDES = (
    f"c AS ({q.rendered(q.CHAT, 'chosen')}), r AS ({q.rendered(q.CHAT, 'rejected')})"
)
# The sides differ in the last message only, or not at all where two answers agree.
_SHARED = """
split AS (SELECT c.conv_id, c.turn, c.role, c.text, r.text AS other,
            c.turn < a.last OR c.text = r.text AS same
          FROM chosen c JOIN rejected r ON c.conv_id = r.conv_id AND c.turn = r.turn
          JOIN answers a ON a.conv_id = c.conv_id)"""

QUERIES = {
    "c0_nest_turns": (
        nested,
        "SELECT conv_id, count(*)::INTEGER AS n_turns, "
        "string_agg(role || '=' || text, '|' ORDER BY turn) AS turns FROM conversations GROUP BY conv_id",
    ),
    "c1_render_role_prefix": (role_prefix, q.rendered(q.ROLE_PREFIX)),
    "c2_render_human_assistant": (human_assistant, q.rendered(q.HUMAN_ASSISTANT)),
    "c3_render_template": (chat_template, q.rendered(q.CHAT)),
    "d1_preference_pairs": (
        pairs,
        f"WITH {q.PREFERENCES}, {_SIDES} SELECT conv_id, c.text AS prompt, c.text AS chosen, "
        "r.text AS rejected FROM c JOIN r USING (conv_id)",
    ),
    "d1_preference_pairs_common_prefix": (
        pairs_common_prefix,
        f"WITH {q.PREFERENCES}, {_SHARED}, "
        f"lines AS (SELECT conv_id, turn, same, {q.CHAT} AS line, "
        f"{q.CHAT.replace('|| text ||', '|| other ||')} AS other_line FROM split) "
        "SELECT conv_id, coalesce(string_agg(line, '' ORDER BY turn) FILTER (same), '') AS prompt, "
        "coalesce(string_agg(line, '' ORDER BY turn) FILTER (NOT same), '') AS chosen, "
        "coalesce(string_agg(other_line, '' ORDER BY turn) FILTER (NOT same), '') AS rejected "
        "FROM lines GROUP BY conv_id",
    ),
    "u1_map_batches": (
        user_map,
        "SELECT doc_id, length(text) - length(replace(text, ' ', '')) AS n_spaces, "
        "list_max(list_transform(string_split(text, chr(10)), lambda s: length(s))) AS longest_line FROM documents",
    ),
}
