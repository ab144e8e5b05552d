import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from millrace.functions.render import (
    ChatTemplate,
    render_human_assistant,
    render_role_prefix,
    render_template,
    shared_messages,
)
from millrace.operators.conversations import nest_turns, preference_pairs, select_text

MESSAGES = "ARRAY<STRUCT<role STRING, content STRING>>"


def render(spark, fn, *conversations):
    rows = spark.createDataFrame([(c,) for c in conversations], f"m {MESSAGES}")
    return [r.t for r in rows.select(fn(F.col("m")).alias("t")).collect()]


def test_role_prefix(spark):
    got = render(spark, render_role_prefix, [("user", "hi"), ("assistant", "yo")], [("user", None)], [], [(None, "x")])
    assert got == ["user: hi\nassistant: yo\n", "user: None\n", "", "None: x\n"]


def test_human_assistant(spark):
    got = render(spark, render_human_assistant, [("system", "s"), ("user", "hi")], [("User", "a"), (None, None)])
    assert got == ["Assistant: s\nHuman: hi\n", "Assistant: a\nAssistant: None\n"]


def test_template(spark):
    got = render(spark, lambda m: render_template(m, ChatTemplate()), [("user", "hi"), ("x", None)])
    assert got == ["<s>user\nhi</s>\n<s>x\nNone</s>\n"]


def test_null_list_fails(spark):
    with pytest.raises(SparkRuntimeException, match="message list is null"):
        render(spark, render_role_prefix, None)


def test_nesting_orders_turns(spark):
    rows = [(1, 2, "user", "c"), (1, 0, "system", "a"), (2, 0, "user", "z"), (1, 1, "user", "b")]
    nested = nest_turns(spark.createDataFrame(rows, "c INT, t INT, r STRING, x STRING"), "c", "t", "r", "x")
    got = {r.c: [tuple(m) for m in r.conversations] for r in nested.collect()}
    assert got == {1: [("system", "a"), ("user", "b"), ("user", "c")], 2: [("user", "z")]}


@pytest.mark.parametrize("fields,expected", [
    (["conversations", "text", "input", "prompt"], "user: hi\n"), (["text", "input", "prompt"], "text"),
    (["input", "prompt"], "input"), (["prompt"], "prompt"),
])
def test_field_order(spark, fields, expected):
    table = spark.range(1).select(
        "id", *[
            F.expr("array(named_struct('role', 'user', 'content', 'hi'))").alias(f)
            if f == "conversations" else F.lit(f).alias(f) for f in fields
        ]
    )
    selected = select_text(table, "id", render_role_prefix)
    assert selected.columns == ["id", "text"]
    assert selected.first().text == expected


def test_missing_fields_fail_before_any_job(spark):
    with pytest.raises(ValueError, match="conversations, text, input, prompt"):
        select_text(spark.range(1), "id", render_role_prefix)
    with pytest.raises(ValueError, match="text"):
        select_text(spark.range(1).withColumn("input", F.lit("x")), "id", only="text")


def test_preference_modes(spark):
    chosen = [("user", "q"), ("assistant", "good")]
    rejected = [("user", "q"), ("assistant", "bad")]
    rows = [(1, chosen, rejected), (2, chosen, chosen), (3, [("user", "a")], [("user", "b")]), (4, [], rejected)]
    table = spark.createDataFrame(rows, f"id INT, chosen {MESSAGES}, rejected {MESSAGES}")
    template = ChatTemplate("[", ":", "]")
    whole = {r.id: tuple(r)[1:] for r in preference_pairs(table, "id", template).collect()}
    assert whole[1] == ("[user:q][assistant:good]", "[user:q][assistant:good]", "[user:q][assistant:bad]")
    shared = {r.id: tuple(r)[1:] for r in preference_pairs(table, "id", template, "common_prefix").collect()}
    assert shared == {
        1: ("[user:q]", "[assistant:good]", "[assistant:bad]"),
        2: ("[user:q][assistant:good]", "", ""),
        3: ("", "[user:a]", "[user:b]"),
        4: ("", "", "[user:q][assistant:bad]"),
    }
    with pytest.raises(ValueError):
        preference_pairs(table, "id", template, "other")


def test_shared_messages_counts_nulls_as_equal(spark):
    rows = [([("a", None)], [("a", None), ("b", "x")])]
    table = spark.createDataFrame(rows, f"l {MESSAGES}, r {MESSAGES}")
    assert table.select(shared_messages(F.col("l"), F.col("r")).alias("n")).first().n == 1
