"""Token limits and metrics of preference pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.sequences import IGNORED_LABEL


def preference_tokens(
    pairs: DataFrame, key: str, max_prompt_length: int = 256, max_length: int = 512
) -> DataFrame:
    """``(key, chosen_ids, chosen_labels, rejected_ids, rejected_labels)``.

    Takes ``prompt``, ``chosen`` and ``rejected`` id lists. The prompt keeps its
    tail, the completions keep their heads, and prompt positions carry no label. No
    list is longer than ``max_length``, which limits the prompt too.
    """
    tail = max(0, min(max_prompt_length, max_length))
    cut = F.slice("prompt", -tail, tail) if tail else F.slice("prompt", 1, 0)
    prompt = F.when(F.size("prompt") > tail, cut).otherwise(F.col("prompt"))
    limited = pairs.withColumn("_prompt", prompt)
    room = F.lit(max_length) - F.size("_prompt")

    def completion(side: str) -> Column:
        return F.slice(side, F.lit(1), F.greatest(room, F.lit(0)))

    def ids(side: str) -> Column:
        return F.concat("_prompt", completion(side))

    def labels(side: str) -> Column:
        return F.concat(F.array_repeat(F.lit(IGNORED_LABEL), F.size("_prompt")), completion(side))

    return limited.select(
        key,
        ids("chosen").alias("chosen_ids"), labels("chosen").alias("chosen_labels"),
        ids("rejected").alias("rejected_ids"), labels("rejected").alias("rejected_labels"),
    )


def preference_metrics(df: DataFrame, beta: float = 0.1) -> DataFrame:
    """Mean loss, margin and accuracy over logged log-probabilities.

    Takes ``policy_chosen``, ``policy_rejected``, ``reference_chosen`` and
    ``reference_rejected``; the margin is the scaled gain of chosen over rejected.
    """
    gain = (F.col("policy_chosen") - F.col("policy_rejected")) - (
        F.col("reference_chosen") - F.col("reference_rejected")
    )
    margin = gain * beta
    # -log(sigmoid(margin)), written so that neither sign overflows.
    loss = F.greatest(-margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))
    return df.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.avg(loss).alias("loss"),
        F.avg(margin).alias("margin"),
        F.avg((margin > 0).cast("double")).alias("accuracy"),
    )
