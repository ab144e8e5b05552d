import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.functions.sequences import add_special, attention_mask, causal_labels, pad, stop_at, truncate
from millrace.operators.batches import assign_batches, epoch_order, pad_to_batch_max, planned_run, run_plan, run_points
from millrace.operators.preference import preference_metrics, preference_tokens
from millrace.operators.user_map import map_batches


def lists(spark, *rows):
    return spark.createDataFrame([(list(r),) for r in rows], "ids ARRAY<INT>")


def apply(spark, fn, *rows):
    return [r.x for r in lists(spark, *rows).select(fn(F.col("ids")).alias("x")).collect()]


def test_lengths(spark):
    assert apply(spark, lambda c: truncate(c, 2), [1, 2, 3], [1], []) == [[1, 2], [1], []]
    assert apply(spark, lambda c: pad(c, 3, 9), [1], [], [1, 2, 3, 4]) == [[1, 9, 9], [9, 9, 9], [1, 2, 3, 4]]
    assert apply(spark, lambda c: attention_mask(c, 3), [1], [], [1, 2, 3]) == [[1, 0, 0], [0, 0, 0], [1, 1, 1]]


def test_labels_mask_every_pad_id(spark):
    """With pad = end of text, real ends are masked as well."""
    assert apply(spark, lambda c: causal_labels(pad(c, 4, 1), 1), [5, 1], []) == [[5, -100, -100, -100], [-100] * 4]


def test_special_ids_and_stops(spark):
    assert apply(spark, lambda c: add_special(c, 1, None), [5], []) == [[1, 5], [1]]
    assert apply(spark, lambda c: add_special(c, 1, 2), [5]) == [[1, 5, 2]]
    assert apply(spark, lambda c: stop_at(c, 2, 3), [5, 2, 6], [5, 6, 7, 2], [2], []) == [[5, 2], [5, 6, 7], [2], []]


@pytest.mark.parametrize("partitions", [1, 7])
def test_epoch_order_is_the_hash_order(spark, partitions):
    keys = spark.range(0, 3000, 1, partitions).withColumnRenamed("id", "k")
    got = {(r.epoch, r.key): r.pos for r in epoch_order(keys, "k", 2, 5).collect()}
    for epoch in range(2):
        ranked = sorted(range(3000), key=lambda k: (hashlib.md5(f"5:{epoch}:{k}".encode()).hexdigest(), k))
        assert [got[epoch, k] for k in ranked] == list(range(3000))


def test_batches_cover_every_row_once(spark):
    ordered = epoch_order(spark.range(101).withColumnRenamed("id", "k"), "k", 2, 1)
    rows = assign_batches(ordered, batch=4, accum=3, world=2).collect()
    assert len({(r.epoch, r.key) for r in rows}) == len(rows) == 202
    for r in rows:
        group = r.pos // 4
        assert (r.rank, r.micro, r.step) == (group % 2, group // 2, group // 6)
    plan = run_plan(assign_batches(ordered, 4, 3, 2))
    assert [tuple(r) for r in plan.orderBy("epoch").collect()] == [(0, 101, 13, 5, 1, 5), (1, 101, 13, 5, 6, 10)]
    points = {(r.kind, r.step) for r in run_points(plan, 4, 6).collect()}
    assert points == {("log", 4), ("log", 8), ("save", 6)}
    assert {(r.kind, r.step) for r in run_points(plan, 100).collect()} == {("save", 5), ("save", 10)}


@pytest.mark.parametrize("n", [0, 1, 23, 24, 25, 101])
def test_a_plan_needs_the_number_of_rows_alone(spark, n):
    keys = spark.range(n).withColumnRenamed("id", "k")
    expected = run_plan(assign_batches(epoch_order(keys, "k", 3, 1), 4, 3, 2))
    got = planned_run(keys, 3, 4, 3, 2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect())) and got.columns == expected.columns


def test_empty_tables(spark):
    ordered = epoch_order(spark.range(0).withColumnRenamed("id", "k"), "k", 2, 1)
    plan = run_plan(assign_batches(ordered, 4))
    assert plan.count() == 0 and run_points(plan, 1).count() == 0


def test_pad_to_longest_of_batch(spark):
    rows = [(0, [1]), (0, [1, 2, 3]), (1, []), (1, [4])]
    table = spark.createDataFrame(rows, "b INT, ids ARRAY<INT>")
    got = sorted((r.b, r.ids, r.attention_mask) for r in pad_to_batch_max(table, ["b"], "ids", 9).collect())
    assert got == [(0, [1, 2, 3], [1, 1, 1]), (0, [1, 9, 9], [1, 0, 0]), (1, [4], [1]), (1, [9], [0])]


def test_preference_limits(spark):
    rows = [(1, [1, 2, 3], [7, 8, 9], [6]), (2, [1], [], [5, 5, 5, 5, 5, 5])]
    table = spark.createDataFrame(rows, "k INT, prompt ARRAY<INT>, chosen ARRAY<INT>, rejected ARRAY<INT>")
    got = {r.k: tuple(r)[1:] for r in preference_tokens(table, "k", 2, 4).collect()}
    assert got[1] == ([2, 3, 7, 8], [-100, -100, 7, 8], [2, 3, 6], [-100, -100, 6])
    assert got[2] == ([1], [-100], [1, 5, 5, 5], [-100, 5, 5, 5])


@pytest.mark.parametrize(("prompt", "total", "expected"), [(0, 3, [4, 5, 6]), (4, 2, [2, 3]), (2, 0, [])])
def test_preference_limits_hold_at_their_ends(spark, prompt, total, expected):
    pair = spark.createDataFrame([(1, [1, 2, 3], [4, 5, 6, 7], [8])], "k INT, prompt ARRAY<INT>, chosen ARRAY<INT>, rejected ARRAY<INT>")
    assert preference_tokens(pair, "k", prompt, total).first().chosen_ids == expected


def test_epochs_and_far_steps(spark):
    with pytest.raises(ValueError):
        epoch_order(spark.range(3), "id", 0, 1)
    plan = spark.createDataFrame([(5_000_000_000,)], "last_step LONG")
    assert run_points(plan, 2, 10).filter("kind = 'log'").count() == 2_500_000_000


def test_preference_metrics(spark):
    rows = [(-1.0, -2.0, -1.0, -1.0), (-5.0, -4.0, -1.0, -1.0), (-1e5, -1.0, -1.0, -1.0)]
    names = "policy_chosen DOUBLE, policy_rejected DOUBLE, reference_chosen DOUBLE, reference_rejected DOUBLE"
    row = preference_metrics(spark.createDataFrame(rows, names)).first()
    import math

    losses = [math.log1p(math.exp(-0.1)), math.log1p(math.exp(0.1)), 9999.9]
    assert row.n_pairs == 3 and row.loss == pytest.approx(sum(losses) / 3)
    assert row.accuracy == pytest.approx(1 / 3)


def test_user_map_sees_small_batches_and_drops_inputs(spark):
    table = spark.range(0, 25, 1, 1).withColumn("text", F.lit("x"))
    out = map_batches(table, lambda b: b[["id"]].assign(n=len(b)), "id BIGINT, n BIGINT", batch_size=10)
    rows = out.collect()
    assert out.columns == ["id", "n"] and len(rows) == 25
    assert sorted(r.n for r in rows) == [5] * 5 + [10] * 20


def test_a_batch_with_a_third_of_all_rows(spark):
    table = spark.range(3000).selectExpr(
        "id", "if(id % 3 = 0, 0, id) AS b", "sequence(0, cast(id % 5 AS INT)) AS ids"
    )
    sizes = {r.id: len(r.ids) for r in pad_to_batch_max(table, ["b"], "ids", 9).collect()}
    assert sizes == {i: 5 if i % 3 == 0 else i % 5 + 1 for i in range(3000)}
