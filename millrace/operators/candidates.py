"""Choosing a next token from scored candidates.

Tables are ``(context_id, token_id, score)`` with each token once per context, so
the largest group of a window is one vocabulary. Probabilities are summed as whole
numbers of small units: sums of numbers with fractions depend on the order of rows,
and that on how the table is dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


# Units that make up 1; a vocabulary's sum stays within 63 bits.
UNITS = 1 << 40


def _units(share: Column) -> Column:
    return F.round(share * float(UNITS)).cast("long")


def _context() -> WindowSpec:
    return Window.partitionBy("context_id")


def ban_repeat_bigrams(candidates: DataFrame, contexts: DataFrame) -> DataFrame:
    """Candidates without those that would repeat two tokens in a row of ``contexts(context_id, ids)``."""
    last = F.element_at("ids", -1)
    pairs = F.zip_with(
        F.slice("ids", F.lit(1), F.greatest(F.size("ids") - 1, F.lit(0))),
        F.slice("ids", F.lit(2), F.size("ids")),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    following = F.transform(F.filter(pairs, lambda p: p["a"] == F.col("_last")), lambda p: p["b"])
    banned = (
        contexts.filter(F.size("ids") > 1)
        .withColumn("_last", last)
        .select("context_id", F.explode(F.array_distinct(following)).alias("token_id"))
    )
    return candidates.join(banned, ["context_id", "token_id"], "left_anti")


def softmax(scores: DataFrame, temperature: float = 0.7) -> DataFrame:
    """``prob`` from ``score``, summing to 1 in every context."""
    if temperature <= 0:
        raise ValueError("temperature must be above 0")
    top = F.max("score").over(_context())
    return renormalize(scores.withColumn("prob", F.exp((F.col("score") - top) / temperature)))


def renormalize(probs: DataFrame) -> DataFrame:
    """``prob`` scaled to sum to 1 in every context, in units of its greatest."""
    top = F.max("prob").over(_context())
    units = F.sum(_units(F.col("prob") / F.col("_top"))).over(_context())
    scaled = F.col("prob") / (F.col("_top") * units / float(UNITS))
    return probs.withColumn("_top", top).withColumn("prob", scaled).drop("_top")


def top_k(candidates: DataFrame, k: int = 50, by: str = "score") -> DataFrame:
    """The ``k`` best of every context; ties go to the smaller token id."""
    best = _context().orderBy(F.desc(by), "token_id")
    return candidates.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= k).drop("_place")


def top_p(probs: DataFrame, p: float = 0.95) -> DataFrame:
    """The most likely tokens up to and with the one that brings their sum to ``p``."""
    earlier = _context().orderBy(F.desc("prob"), "token_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(_units(F.col("prob"))).over(earlier), F.lit(0))
    return (
        probs.withColumn("_before", before)
        .filter((F.col("_before") < round(p * UNITS)) | (F.col("_before") == 0))
        .drop("_before")
    )


def uniform(seed: int, context_id: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the context only."""
    digits = F.md5(F.concat_ws(":", F.lit(str(seed)), context_id.cast("string")).cast("binary"))
    return F.conv(F.substring(digits, 1, 8), 16, 10).cast("double") / float(1 << 32)


def sample(probs: DataFrame, seed: int) -> DataFrame:
    """``(context_id, token_id)``: one seeded draw per context."""
    running = _context().orderBy(F.desc("prob"), "token_id").rowsBetween(Window.unboundedPreceding, 0)
    drawn = probs.withColumn("_upto", F.sum(_units(F.col("prob"))).over(running)).withColumn(
        "_all", F.max("_upto").over(_context())
    )
    return (
        drawn.filter(F.col("_upto") > uniform(seed, F.col("context_id")) * F.col("_all"))
        .groupBy("context_id")
        .agg(F.min_by("token_id", F.struct("_upto", "token_id")).alias("token_id"))
    )
