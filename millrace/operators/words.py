"""Words of a corpus, their counts, symbols and neighbouring pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import byte_symbols, required, split_words


def pretokenize(df: DataFrame, key: str, text: str, prefix_space: bool = True) -> DataFrame:
    """One row ``(key, pos, word)`` per word of every text."""
    return df.select(
        F.col(key).alias("key"),
        F.posexplode(split_words(required(F.col(text), text), prefix_space)).alias("pos", "word"),
    )


def corpus_words(df: DataFrame, text: str, prefix_space: bool = True) -> DataFrame:
    """The words of every text without their place: all that counting needs."""
    return df.select(F.explode(split_words(required(F.col(text), text), prefix_space)).alias("word"))


def word_counts(words: DataFrame) -> DataFrame:
    """``(word, n)``. Counts are combined before the shuffle, so a frequent word costs one row per task."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def alphabet(counts: DataFrame) -> DataFrame:
    """The byte symbols that occur in the words; never more than 256 rows."""
    return counts.select(
        F.explode(F.array_distinct(F.split(byte_symbols(F.col("word")), ""))).alias("symbol")
    ).distinct()


def word_symbols(counts: DataFrame) -> DataFrame:
    """Every word as a list of byte symbols: ``(word, symbols, n)``."""
    return counts.select("word", F.split(byte_symbols(F.col("word")), "").alias("symbols"), "n")


def pair_counts(words: DataFrame) -> DataFrame:
    """``(left, right, n)`` over neighbouring entries of ``symbols``, weighted by ``n``."""
    neighbours = F.arrays_zip(
        F.slice("symbols", F.lit(1), F.greatest(F.size("symbols") - 1, F.lit(0))).alias("left"),
        F.slice("symbols", F.lit(2), F.size("symbols")).alias("right"),
    )
    return (
        words.select(F.inline(neighbours).alias("left", "right"), "n")
        .groupBy("left", "right")
        .agg(F.sum("n").alias("n"))
    )
