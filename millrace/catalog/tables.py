"""The given tables, and inputs that Spark derives from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import utf8_as_latin1
from millrace.operators.batches import epoch_order
from millrace.operators.bigrams import bigram_model
from millrace.operators.conversations import nest_turns
from millrace.session import cut_lineage, spread


def table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents", ["doc_id", "text"]))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark", ["item_id", "text"])


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, conversations)``."""
    turns = table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return nest_turns(turns, "conv_id", "turn", "role", "text")


def preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, chosen, rejected)`` message lists.

    Chosen is a conversation up to its last assistant message. Rejected is the same
    with that message's content taken from the conversation that follows in a
    seeded order, the first one following the last.
    """
    answered = conversations(spark, sf_dir).select(
        "conv_id", F.transform("conversations", lambda m: m["role"]).alias("roles"), "conversations"
    )
    last = F.size("roles") - F.array_position(F.reverse("roles"), "assistant").cast("int") + 1
    chosen = answered.filter(F.array_contains("roles", "assistant")).select(
        "conv_id", F.slice("conversations", F.lit(1), last).alias("chosen")
    )
    chosen = cut_lineage(chosen)
    places = epoch_order(chosen, "conv_id", 1, 7).select(F.col("key").alias("conv_id"), "pos")
    placed = chosen.join(places, "conv_id")
    n_rows = chosen.count()
    answers = placed.select(
        ((F.col("pos") + n_rows - 1) % n_rows).alias("pos"),
        F.element_at("chosen", -1)["content"].alias("answer"),
    )
    other = F.struct(
        F.element_at("chosen", -1)["role"].alias("role"), F.col("answer").alias("content")
    )
    rejected = F.concat(F.slice("chosen", F.lit(1), F.size("chosen") - 1), F.array(other))
    return cut_lineage(
        placed.join(answers, "pos").select("conv_id", "chosen", rejected.alias("rejected"))
    )


def byte_ids(text: Column) -> Column:
    """The UTF-8 bytes of a text as ids: the encoding of a vocabulary without merges."""
    characters = F.filter(F.split(utf8_as_latin1(text), ""), lambda c: c != "")
    return F.transform(characters, lambda c: F.ascii(c))


def document_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", byte_ids(F.col("text")).alias("ids"))


def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(context_id, ids)``: the bytes of every space-separated word of the benchmark."""
    return benchmark(spark, sf_dir).select(
        "item_id", F.posexplode(F.split("text", " ")).alias("pos", "word")
    ).filter(F.col("word") != "").select(
        (F.col("item_id") * 1_000_000 + F.col("pos")).alias("context_id"),
        byte_ids(F.col("word")).alias("ids"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(context_id, token_id, score)`` from the byte pairs of the documents."""
    model = bigram_model(document_bytes(spark, sf_dir))
    last = contexts(spark, sf_dir).select("context_id", F.element_at("ids", -1).alias("prev"))
    return last.join(model, "prev").select(
        "context_id", F.col("next").alias("token_id"), F.log("n").alias("score")
    )


def joined(ids: str) -> Column:
    """A list as text, so that both engines hash it alike."""
    return F.array_join(F.col(ids), " ").alias(ids)
