import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.catalog import CATALOG
from millrace.operators import bigrams
from millrace.operators.bigrams import bigram_model, score_lists, score_sequences
from millrace.operators.candidates import ban_repeat_bigrams, renormalize, sample, softmax, top_k, top_p
from millrace.plans.training_rows import next_tokens

SCORES = "context_id BIGINT, token_id INT, score DOUBLE"


def table(spark, rows):
    return spark.createDataFrame(rows, SCORES)


def test_softmax_and_rank_filters(spark):
    scores = table(spark, [(1, 5, 1.0), (1, 4, 1.0), (1, 6, 3.0), (2, 9, -700.0)])
    probs = {(r.context_id, r.token_id): r.prob for r in softmax(scores, 0.5).collect()}
    total = 2 * math.exp(2) + math.exp(6)
    assert probs[1, 6] == pytest.approx(math.exp(6) / total) and probs[2, 9] == 1.0
    assert {(r.context_id, r.token_id) for r in top_k(scores, 2).collect()} == {(1, 6), (1, 4), (2, 9)}
    kept = {(r.context_id, r.token_id) for r in top_p(softmax(scores, 0.5), 0.97).collect()}
    assert kept == {(1, 6), (1, 4), (2, 9)}
    with pytest.raises(ValueError):
        softmax(scores, 0)


def test_top_p_keeps_one(spark):
    probs = softmax(table(spark, [(1, 1, 0.0), (1, 2, 5.0)]), 1.0)
    assert [r.token_id for r in top_p(probs, 0.0).collect()] == [2]


def test_repeated_bigrams_are_banned(spark):
    scores = table(spark, [(1, 7, 0.0), (1, 8, 0.0), (1, 9, 0.0), (2, 7, 0.0), (3, 7, 0.0)])
    contexts = spark.createDataFrame([(1, [5, 7, 5, 8, 5]), (2, [7]), (3, [])], "context_id BIGINT, ids ARRAY<INT>")
    kept = {(r.context_id, r.token_id) for r in ban_repeat_bigrams(scores, contexts).collect()}
    assert kept == {(1, 9), (2, 7), (3, 7)}


def test_draws_follow_the_probabilities(spark):
    rows = [(c, t, math.log(p)) for c in range(4000) for t, p in ((0, 0.5), (1, 0.3), (2, 0.2))]
    drawn = sample(softmax(table(spark, rows), 1.0), 3)
    counts = {r["token_id"]: r["count"] / 4000 for r in drawn.groupBy("token_id").count().collect()}
    assert counts[0] == pytest.approx(0.5, abs=0.03) and counts[2] == pytest.approx(0.2, abs=0.03)
    again = sample(softmax(table(spark, rows).repartition(5), 1.0), 3)
    assert sorted(again.collect()) == sorted(drawn.collect())


def test_chain_only_draws_what_every_filter_keeps(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.gauss(0, 2)) for c in range(50) for t in range(30)]
    contexts = spark.createDataFrame(
        [(c, [rng.randrange(30) for _ in range(40)]) for c in range(50)], "context_id BIGINT, ids ARRAY<INT>"
    )
    scores = table(spark, rows)
    kept = top_p(renormalize(top_k(softmax(ban_repeat_bigrams(scores, contexts), 0.7), 5)), 0.8)
    allowed = {(r.context_id, r.token_id) for r in kept.collect()}
    drawn = {(r.context_id, r.token_id) for r in next_tokens(scores, contexts, 1, 0.7, 5, 0.8).collect()}
    assert len(drawn) == 50 and drawn <= allowed


def test_draws_do_not_depend_on_partitions(spark):
    """Many near ties, so that a sum in another order would draw or keep other tokens."""
    rng = random.Random(9)
    rows = [(c, t, rng.choice((0.1, 0.2, 0.3, 1 / 3)) + rng.random() * 1e-15) for c in range(200) for t in range(90)]
    contexts = spark.createDataFrame([(c, [c % 90, 1, c % 90]) for c in range(200)], "context_id BIGINT, ids ARRAY<INT>")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in (1, 7, 200):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            scores = table(spark, rng.sample(rows, len(rows))).repartition(n)
            kept = top_p(softmax(scores, 0.7), 0.5)
            results.append((sorted(kept.collect()), sorted(next_tokens(scores, contexts, 3, 0.7, 60, 0.5).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_contexts_without_candidates_have_a_null(spark):
    contexts = spark.createDataFrame([(1, [5, 7, 5]), (2, [4]), (3, [5])], "context_id BIGINT, ids ARRAY<INT>")
    drawn = next_tokens(table(spark, [(1, 7, 0.0), (3, 7, 0.0)]), contexts, 1)
    assert {tuple(r) for r in drawn.collect()} == {(1, None), (2, None), (3, 7)}


def test_small_shares_keep_their_digits(spark):
    probs = spark.createDataFrame([(1, t, 1e-9 * (t + 1)) for t in range(4)], "context_id BIGINT, token_id INT, prob DOUBLE")
    scaled = {r.token_id: r.prob for r in renormalize(probs).collect()}
    assert all(abs(scaled[t] - (t + 1) / 10) < 1e-11 for t in range(4))


def test_bigram_likelihood(spark):
    model = bigram_model(spark.createDataFrame([([1, 2, 1, 2],), ([2],), ([],)], "ids ARRAY<INT>"))
    assert {tuple(r) for r in model.collect()} == {(1, 2, 2, 2), (2, 1, 1, 1)}
    rows = spark.createDataFrame([(1, [1, 2, 3, 1, 2]), (2, [9])], "k INT, ids ARRAY<INT>")
    scored = {r.k: r for r in score_sequences(rows, "k", model, vocab_size=4, alpha=0.5).collect()}
    expected = 2 * math.log(2.5 / 4) + math.log(0.5 / 3) + math.log(0.5 / 2)
    assert set(scored) == {1, 2} and scored[1].n_pairs == 4
    assert tuple(scored[2]) == (2, 0, 0.0, None)
    assert scored[1].log_prob == pytest.approx(expected)
    assert scored[1].perplexity == pytest.approx(math.exp(-expected / 4))


@pytest.mark.parametrize("shared", [0, 3, 1000])
def test_lists_are_scored_side_by_side(spark, monkeypatch, shared):
    """One pair stands in a third of all sequences, another such pair in no model; few, some or all rows travel."""
    monkeypatch.setattr(bigrams, "SHARED_ROWS", shared)
    rng = random.Random(3)
    rows = [(k, [7, 7] if k % 3 == 0 else [rng.randrange(9) for _ in range(k % 6)], [8, 9] if k % 3 == 1 else [rng.randrange(9), 1, 2]) for k in range(600)]
    table = spark.createDataFrame(rows, "k INT, a ARRAY<INT>, b ARRAY<INT>")
    models = {
        "one": bigram_model(table.select(F.col("a").alias("ids"))),
        "two": bigram_model(spark.createDataFrame([([1, 2, 1, 7, 7, 3],), ([5],)], "ids ARRAY<INT>")),
    }
    got = {r.k: r for r in score_lists(table, "k", {"a": "a", "b": "b"}, models, 10, 0.5).collect()}
    assert len(got) == 600
    for model in models:
        for side in ("a", "b"):
            for r in score_sequences(table, "k", models[model], 10, 0.5, side).collect():
                assert got[r.k][f"{model}_{side}"] == pytest.approx(r.log_prob, abs=1e-9)


def test_preference_metrics_take_few_exchanges(spark):
    plan = CATALOG["d2_preference_metrics"][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    exchanges = [line for line in plan.toString().splitlines() if "Exchange " in line and "Broadcast" not in line and "Reused" not in line]
    assert len(exchanges) <= 6
