"""Queries over scored candidates, sequence likelihoods and preference metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import fragments as q
from millrace.catalog import tables as t
from millrace.functions.render import ChatTemplate
from millrace.operators.bigrams import bigram_model, score_lists, score_sequences
from millrace.operators.candidates import (
    ban_repeat_bigrams,
    renormalize,
    sample,
    softmax,
    top_k,
    top_p,
)
from millrace.operators.conversations import preference_pairs
from millrace.operators.preference import preference_metrics
from millrace.plans.training_rows import next_tokens
from millrace.session import cut_lineage

BYTES = 256


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.withColumn(column, F.round(column, 9))
    return df


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = softmax(t.scores(spark, sf_dir), 0.7)
    return _rounded(rows, "prob").select("context_id", "token_id", "prob")


def best_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(t.scores(spark, sf_dir), 10).select("context_id", "token_id")


def nucleus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_p(softmax(t.scores(spark, sf_dir), 0.7), 0.95).select("context_id", "token_id")


def allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ban_repeat_bigrams(t.scores(spark, sf_dir), t.contexts(spark, sf_dir))
    return kept.select("context_id", "token_id")


def draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample(softmax(t.scores(spark, sf_dir), 1.0), 5)


def chosen_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_tokens(t.scores(spark, sf_dir), t.contexts(spark, sf_dir), 5, 0.7, 10, 0.9)


def model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bigram_model(t.document_bytes(spark, sf_dir))


def held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.benchmark(spark, sf_dir).select("item_id", t.byte_ids(F.col("text")).alias("ids"))
    scored = score_sequences(rows, "item_id", cut_lineage(model(spark, sf_dir)), BYTES)
    return scored.select(
        "item_id", "n_pairs", F.round("log_prob", 6).alias("log_prob"), F.round("perplexity", 6).alias("perplexity")
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte pairs of the conversations as policy, those of the benchmark as reference.

    Every answer stands once on either side, so margins cancel out: adding 0.0 makes
    a mean of either sign of zero the same zero.
    """
    pairs = preference_pairs(t.preferences(spark, sf_dir), "conv_id", ChatTemplate())
    texts = {
        "policy": t.table(spark, sf_dir, "conversations", ["text"]),
        "reference": t.benchmark(spark, sf_dir),
    }
    models = {
        name: bigram_model(source.select(t.byte_ids(F.col("text")).alias("ids"))) for name, source in texts.items()
    }
    sides = {side: side for side in ("chosen", "rejected")}
    ids = pairs.select("conv_id", *[t.byte_ids(F.col(side)).alias(side) for side in sides])
    logged = score_lists(ids, "conv_id", sides, models, BYTES)
    return preference_metrics(logged).select(
        "n_pairs",
        F.round("loss", 6).alias("loss"),
        (F.round("margin", 6) + 0.0).alias("margin"),
        F.round("accuracy", 9).alias("accuracy"),
    )


def _model(name: str, source: str) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT prev, next, n, sum(n) OVER (PARTITION BY prev) AS prev_n FROM "
        f"(SELECT prev, next, count(*) AS n FROM ({q.byte_pairs(f'SELECT text FROM {source}')}) GROUP BY 1, 2))"
    )


_SCORES = f"WITH {q.SCORES}"
_DELTA = "((pc.log_prob - pr.log_prob) - (rc.log_prob - rr.log_prob)) * 0.1"

QUERIES = {
    "g1_softmax": (
        probabilities,
        f"{_SCORES} SELECT context_id, token_id, round(prob, 9) AS prob FROM ({q.softmax('scores', 0.7)})",
    ),
    "g2_top_k": (best_ten, f"{_SCORES} SELECT context_id, token_id FROM ({q.best('scores', 10)})"),
    "g3_top_p": (
        nucleus,
        f"{_SCORES}, probs AS ({q.softmax('scores', 0.7)}) SELECT context_id, token_id FROM ({q.nucleus('probs', 0.95)})",
    ),
    "g4_ban_repeat_bigrams": (allowed, f"{_SCORES}, {q.ALLOWED} SELECT context_id, token_id FROM allowed"),
    "g5_sample": (draws, f"{_SCORES}, probs AS ({q.softmax('scores', 1.0)}) {q.drawn('probs', 5)}"),
    "g4_to_g5_next_tokens": (
        chosen_tokens,
        f"{_SCORES}, {q.ALLOWED}, probs AS ({q.softmax('allowed', 0.7)}), best AS ({q.best('probs', 10)}), "
        f"scaled AS ({q.rescaled('best')}), likely AS ({q.nucleus('scaled', 0.9)}), "
        f"final AS ({q.rescaled('likely')}), chosen AS ({q.drawn('final', 5)}) "
        "SELECT context_id, token_id FROM contexts LEFT JOIN chosen USING (context_id)",
    ),
    "g7_bigram_model": (model, f"WITH {q.DOCUMENT_PAIRS} SELECT prev, next, n, prev_n FROM model"),
    "g7_score_sequences": (
        held_out,
        f"WITH {q.DOCUMENT_PAIRS}, {q.scored('s', 'SELECT item_id, text FROM benchmark', 'item_id', 'model', 1.0, BYTES)} "
        "SELECT item_id, n_pairs, round(log_prob, 6) AS log_prob, round(exp(-log_prob / n_pairs), 6) AS perplexity FROM s",
    ),
    "d2_preference_metrics": (
        metrics,
        f"WITH {q.PREFERENCES}, c AS ({q.rendered(q.CHAT, 'chosen')}), r AS ({q.rendered(q.CHAT, 'rejected')}), "
        f"{_model('policy', 'conversations')}, {_model('reference', 'benchmark')}, "
        f"{q.scored('pc', 'SELECT * FROM c', 'conv_id', 'policy', 1.0, BYTES)}, "
        f"{q.scored('pr', 'SELECT * FROM r', 'conv_id', 'policy', 1.0, BYTES)}, "
        f"{q.scored('rc', 'SELECT * FROM c', 'conv_id', 'reference', 1.0, BYTES)}, "
        f"{q.scored('rr', 'SELECT * FROM r', 'conv_id', 'reference', 1.0, BYTES)}, "
        f"d AS (SELECT {_DELTA} AS m FROM pc JOIN pr USING (conv_id) JOIN rc USING (conv_id) JOIN rr USING (conv_id)) "
        "SELECT count(*) AS n_pairs, round(avg(ln(1 + exp(-m))), 6) AS loss, round(avg(m), 6) + 0.0::DOUBLE AS margin, "
        "round(avg(CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM d",
    ),
}
