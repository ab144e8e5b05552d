"""Next-token counts, and the likelihood of sequences under them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage

# Most model rows that travel to all tasks.
SHARED_ROWS = 200_000


def bigram_pairs(df: DataFrame, ids: str, *keep: str, outer: bool = False) -> DataFrame:
    """``(…, prev, next, n)``: neighbouring ids, counted per kept columns.

    With ``outer``, a sequence without a pair has one row, of nulls.
    """
    neighbours = F.arrays_zip(
        F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0))).alias("prev"),
        F.slice(ids, F.lit(2), F.size(ids)).alias("next"),
    )
    return (
        df.select(*keep, (F.inline_outer if outer else F.inline)(neighbours).alias("prev", "next"))
        .groupBy(*keep, "prev", "next")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def bigram_model(df: DataFrame, ids: str = "ids") -> DataFrame:
    """``(prev, next, n, prev_n)``; at most the vocabulary squared rows.

    Pairs are counted before they are shuffled. The totals come from the counted
    pairs, of which one ``prev`` has no more than the vocabulary has tokens.
    """
    same = Window.partitionBy("prev")
    return bigram_pairs(df, ids).withColumn("prev_n", F.sum("n").over(same))


def score_sequences(
    df: DataFrame, key: str, model: DataFrame, vocab_size: int, alpha: float = 1.0, ids: str = "ids"
) -> DataFrame:
    """``(key, n_pairs, log_prob, perplexity)`` with ``alpha`` added to every count.

    Pairs are counted per sequence first, so each joins once however often it
    repeats; pairs shared by many sequences are left to the skew join of Spark. The
    model is read twice, so hand in a written one if it is costly to count. A sequence
    of fewer than two ids has no pairs, the log-likelihood 0 and no perplexity.
    """
    times = F.when(F.col("prev").isNotNull(), F.col("n")).otherwise(0).cast("long")
    pairs = bigram_pairs(df, ids, key, outer=True).withColumn("_times", times).drop("n")
    seen = model.select("prev", "next", "n")
    totals = model.groupBy("prev").agg(F.max("prev_n").alias("prev_n"))
    count = F.coalesce("n", F.lit(0)) + F.lit(alpha)
    total = F.coalesce("prev_n", F.lit(0)) + F.lit(alpha * vocab_size)
    return (
        pairs.join(seen, ["prev", "next"], "left")
        .join(totals, "prev", "left")
        .groupBy(key)
        .agg(
            F.sum("_times").alias("n_pairs"),
            F.sum(F.col("_times") * F.log(count / total)).alias("log_prob"),
        )
        .withColumn("perplexity", F.exp(-F.try_divide("log_prob", "n_pairs")))
    )


def score_lists(
    df: DataFrame, key: str, lists: Mapping[str, str], models: Mapping[str, DataFrame], vocab_size: int, alpha: float = 1.0
) -> DataFrame:
    """``(key, {model}_{name}, …)``: the log-likelihood of every list of a row under every model.

    ``lists`` names the id columns. Pairs of all lists are counted once and meet all
    models at once. The most frequent model rows, at most ``SHARED_ROWS``, travel to
    the tasks, so a pair that very many sequences hold is looked up where it is; only
    pairs that these lack are shuffled to the others. Totals are one row a token.
    """
    table, totals = _side_by_side(models)
    frequent, rare = _by_frequency(table, models)
    entries = F.explode(F.array(*[F.struct(F.lit(name).alias("list"), F.col(c).alias("ids")) for name, c in lists.items()]))
    rows = df.select(F.col(key), entries.alias("_list")).select(key, "_list.*")
    times = F.when(F.col("prev").isNotNull(), F.col("n")).otherwise(0).cast("long")
    pairs = bigram_pairs(rows, "ids", key, "list", outer=True).withColumn("_times", times).drop("n")
    looked = pairs.join(F.broadcast(frequent.withColumn("_met", F.lit(True))), ["prev", "next"], "left")
    met = looked.filter(F.col("_met") | F.col("prev").isNull())
    left = looked.filter(F.col("_met").isNull() & F.col("prev").isNotNull()).select(*pairs.columns).join(rare, ["prev", "next"], "left")
    scored = met.drop("_met").unionByName(left).join(F.broadcast(totals), "prev", "left")

    def log_likelihood(model: str, name: str) -> Column:
        count = F.coalesce(f"n_{model}", F.lit(0)) + F.lit(alpha)
        total = F.coalesce(f"total_{model}", F.lit(0)) + F.lit(alpha * vocab_size)
        return F.sum(F.when(F.col("list") == name, F.col("_times") * F.log(count / total))).alias(f"{model}_{name}")

    return scored.groupBy(key).agg(*[log_likelihood(m, name) for m in models for name in lists])


def _side_by_side(models: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``(prev, next, n_{model}, …)`` and ``(prev, total_{model}, …)`` of all models, both written."""
    rows = None
    for name, model in models.items():
        mine = lambda c, other: F.col(c) if other == name else F.lit(None).cast("long")  # noqa: B023, E731
        part = model.select("prev", "next", *[mine("n", m).alias(f"n_{m}") for m in models], *[mine("prev_n", m).alias(f"total_{m}") for m in models])
        rows = part if rows is None else rows.unionByName(part)
    rows = cut_lineage(rows.groupBy("prev", "next").agg(*[F.max(c).alias(c) for c in rows.columns[2:]]))
    totals = cut_lineage(rows.groupBy("prev").agg(*[F.max(f"total_{m}").alias(f"total_{m}") for m in models]))
    return rows.select("prev", "next", *[f"n_{m}" for m in models]), totals


def _by_frequency(table: DataFrame, models: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The rows with the greatest counts, at most SHARED_ROWS, and the others."""
    counts = [F.coalesce(f"n_{m}", F.lit(0)) for m in models]
    most = F.greatest(*counts) if len(counts) > 1 else counts[0]
    top = table.select(most.alias("n")).orderBy(F.desc("n")).limit(SHARED_ROWS + 1)
    n_rows, least = top.agg(F.count("*"), F.min("n")).first()
    bound = least if n_rows > SHARED_ROWS else -1
    return table.filter(most > bound), table.filter(most <= bound)
