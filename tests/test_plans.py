"""Training rows against the library, and what the plans must not hold."""

import re

import pytest
from conftest import library_tokenizer
from pyspark.sql import functions as F

from millrace.functions.render import ChatTemplate
from millrace.operators.batches import epoch_order
from millrace.operators.encode import encode
from millrace.plans.training_rows import (
    adapter_rows,
    batched_rows,
    fine_tuning_rows,
    preference_batches,
    preference_rows,
    pretrain_rows,
    train_tokenizer,
)
from millrace.sources.stages import keep_latest

TEXTS = ["the cat sat on the mat", "the cats sat", "<s>the end</s>", "", "a  b"] * 3
PAD = 2


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id INT, text STRING")


@pytest.fixture(scope="module")
def learned(corpus):
    return train_tokenizer(corpus, 60)


@pytest.fixture(scope="module")
def library():
    return library_tokenizer(TEXTS, 60)


def expected_row(library, text, n):
    ids = library.encode(text).ids[:n]
    padded = ids + [PAD] * (n - len(ids))
    return padded, [1] * len(ids) + [0] * (n - len(ids)), [-100 if i == PAD else i for i in padded]


def test_pretrain_rows(corpus, learned, library):
    rows = pretrain_rows(corpus, "id", learned, PAD, 6)
    assert rows.columns == ["id", "input_ids", "attention_mask", "labels"]
    got = {r.id: tuple(r)[1:] for r in rows.collect()}
    assert got == {i: expected_row(library, t, 6) for i, t in enumerate(TEXTS)}
    with pytest.raises(ValueError):
        pretrain_rows(corpus.withColumnRenamed("text", "prompt"), "id", learned, PAD)


def test_conversation_rows(spark, learned, library):
    messages = [("user", "the cat"), ("assistant", "sat"), ("tool", "mat")]
    table = spark.createDataFrame([(1, messages), (2, [])], "id INT, conversations ARRAY<STRUCT<role STRING, content STRING>>")
    got = {r.id: tuple(r)[1:] for r in fine_tuning_rows(table, "id", learned, PAD, 40).collect()}
    assert got[1] == expected_row(library, "user: the cat\nassistant: sat\ntool: mat\n", 40)
    assert got[2] == ([PAD] * 40, [0] * 40, [-100] * 40)
    got = {r.id: tuple(r)[1:] for r in adapter_rows(table, "id", learned, PAD, 40).collect()}
    assert got[1] == expected_row(library, "Human: the cat\nAssistant: sat\nAssistant: mat\n", 40)


@pytest.mark.parametrize("mode", ["chosen", "common_prefix"])
def test_preference_rows(spark, learned, library, mode):
    chosen, rejected = [("user", "the cat"), ("assistant", "sat")], [("user", "the cat"), ("assistant", "mat")]
    kind = "ARRAY<STRUCT<role STRING, content STRING>>"
    table = spark.createDataFrame([(1, chosen, rejected)], f"id INT, chosen {kind}, rejected {kind}")
    row = preference_rows(table, "id", learned, ChatTemplate(), mode, 5, 12).first()

    def text(messages):
        return "".join(f"<s>{r}\n{c}</s>\n" for r, c in messages)

    prompt = library.encode(text(chosen if mode == "chosen" else chosen[:1])).ids[-5:]
    tails = (chosen, rejected) if mode == "chosen" else (chosen[1:], rejected[1:])
    for side, messages in zip(("chosen", "rejected"), tails):
        ids = library.encode(text(messages)).ids[: 12 - len(prompt)]
        assert row[f"{side}_ids"] == prompt + ids
        assert row[f"{side}_labels"] == [-100] * len(prompt) + ids


def test_batches_of_preferences(spark):
    lists = "ARRAY<INT>"
    rows = [(i, list(range(i % 4)), [-100] * (i % 4), [1] * (3 - i % 4), [2] * (3 - i % 4)) for i in range(21)]
    table = spark.createDataFrame(
        rows, f"id BIGINT, chosen_ids {lists}, chosen_labels {lists}, rejected_ids {lists}, rejected_labels {lists}"
    )
    batched = batched_rows(table, "id", epochs=2, seed=3, batch=2, accum=2, world=2)
    got = preference_batches(batched, PAD).collect()
    assert sorted((r.epoch, r.id) for r in got) == [(e, i) for e in range(2) for i in range(21)]
    source = {r[0]: r[1:] for r in rows}
    for r in got:
        mates = [source[o.id] for o in got if (o.epoch, o.rank, o.micro) == (r.epoch, r.rank, r.micro)]
        assert 1 <= len(mates) <= 2
        longest = max(len(m[0]) for m in mates)
        own = source[r.id][0]
        assert r.chosen_ids == own + [PAD] * (longest - len(own))
        assert r.chosen_labels == [-100] * longest
        assert r.chosen_mask == [1] * len(own) + [0] * (longest - len(own))
        assert len(r.rejected_ids) == len(r.rejected_labels) == max(len(m[2]) for m in mates)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_encoding_does_not_shuffle(corpus, learned, spark, tmp_path):
    corpus.withColumn("other", F.lit("x")).write.parquet(str(tmp_path / "t"))
    plan = plan_of(encode(spark.read.parquet(str(tmp_path / "t")), "id", "text", learned.vocab, learned.merges))
    assert "Exchange" not in plan
    assert "other" not in re.search(r"ReadSchema: (\S+)", plan).group(1)


def test_latest_is_limited_before_the_shuffle(spark):
    plan = plan_of(keep_latest(spark.range(9).selectExpr("id % 2 AS run", "id AS step")))
    assert plan.count("WindowGroupLimit") == 2


def test_shuffling_has_no_single_task_sort(spark):
    plan = plan_of(epoch_order(spark.range(9).withColumnRenamed("id", "k"), "k", 2, 1))
    assert "SinglePartition" not in plan
