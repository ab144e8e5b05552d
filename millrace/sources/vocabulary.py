"""Vocabulary tables and special-token settings on disk."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.bpe import MERGES_SCHEMA, VOCAB_SCHEMA, Vocabulary

_FLAGS = "lstrip BOOLEAN, normalized BOOLEAN, rstrip BOOLEAN, single_word BOOLEAN"
CONFIG_SCHEMA = (
    f"added_tokens_decoder MAP<STRING, STRUCT<content STRING, {_FLAGS}, special BOOLEAN>>, "
    "add_bos_token BOOLEAN, add_eos_token BOOLEAN, "
    "bos_token STRING, eos_token STRING, pad_token STRING, unk_token STRING"
)
_ADDED = f"id INT, content STRING, {_FLAGS}, special BOOLEAN"
# The fields of a tokenizer document.
DOCUMENT_SCHEMA = (
    f"added_tokens ARRAY<STRUCT<{_ADDED}>>, pre_tokenizer STRUCT<type STRING, add_prefix_space BOOLEAN>, "
    "model STRUCT<type STRING, vocab MAP<STRING, INT>, merges STRING>"
)
_ROLES = {"bos": "bos_token", "eos": "eos_token", "pad": "pad_token", "unk": "unk_token"}


def write_vocab(vocab: DataFrame, merges: DataFrame, path: str) -> None:
    """Write both tables below ``path``."""
    vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    merges.write.mode("overwrite").parquet(f"{path}/merges")


def read_vocab(spark: SparkSession, path: str) -> Vocabulary:
    """The tables that :func:`write_vocab` wrote."""
    return Vocabulary(
        spark.read.schema(VOCAB_SCHEMA).parquet(f"{path}/vocab"),
        spark.read.schema(MERGES_SCHEMA).parquet(f"{path}/merges"),
    )


class Tokenizer(NamedTuple):
    """``vocab(id, token, special)``, ``merges(rank, left, right)``, and whether texts get a space in front."""

    vocab: DataFrame
    merges: DataFrame
    prefix_space: bool


def write_tokenizer(vocab: DataFrame, merges: DataFrame, path: str, prefix_space: bool = True) -> None:
    """Write one JSON document, as the public ``tokenizers`` package reads it, below ``path``.

    The document is one value, and the model fixes its size.
    """
    tokens = vocab.select("id", "token", "special", F.lit(None).cast("int").alias("rank"), *[F.lit(None).cast("string").alias(c) for c in ("left", "right")])
    pairs = merges.select(*[F.lit(None).cast(t).alias(c) for c, t in (("id", "int"), ("token", "string"), ("special", "boolean"))], "rank", "left", "right")

    def listed(condition: str, *columns: str):
        return F.array_sort(F.collect_list(F.when(F.expr(condition), F.struct(*columns))))

    rows = tokens.unionByName(pairs).agg(
        listed("id is not null", "id", "token").alias("tokens"),
        listed("special", "id", "token").alias("specials"),
        listed("rank is not null", "rank", "left", "right").alias("pairs"),
    )
    nothing, no, yes = F.lit(None).cast("string"), F.lit(False), F.lit(True)
    added = F.transform("specials", lambda t: F.struct(
        t["id"].alias("id"), t["token"].alias("content"), no.alias("single_word"), no.alias("lstrip"),
        no.alias("rstrip"), no.alias("normalized"), yes.alias("special"),
    ))
    level = [F.lit("ByteLevel").alias("type"), F.lit(prefix_space).alias("add_prefix_space"), yes.alias("trim_offsets"), yes.alias("use_regex")]
    model = F.struct(
        F.lit("BPE").alias("type"), nothing.alias("dropout"), nothing.alias("unk_token"),
        nothing.alias("continuing_subword_prefix"), nothing.alias("end_of_word_suffix"),
        no.alias("fuse_unk"), no.alias("byte_fallback"), no.alias("ignore_merges"),
        F.map_from_entries(F.transform("tokens", lambda t: F.struct(t["token"], t["id"]))).alias("vocab"),
        F.transform("pairs", lambda m: F.array(m["left"], m["right"])).alias("merges"),
    )
    document = F.struct(
        F.lit("1.0").alias("version"), nothing.alias("truncation"), nothing.alias("padding"), added.alias("added_tokens"),
        nothing.alias("normalizer"), F.struct(*level).alias("pre_tokenizer"), nothing.alias("post_processor"),
        F.struct(*level).alias("decoder"), model.alias("model"),
    )
    text = rows.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("value"))
    text.coalesce(1).write.mode("overwrite").option("compression", "none").text(path)


def read_tokenizer(spark: SparkSession, path: str) -> Tokenizer:
    """The tables of a tokenizer document, a file or a folder with one.

    Merges may be spelled as lists of two or as two tokens with a space between; a
    document has one spelling. Added tokens join the vocabulary, and say which tokens
    are special. A document that isn't one fails when it is read.
    """
    parsed = F.from_json("value", DOCUMENT_SCHEMA)
    read = spark.read.text(path, wholetext=True).select(parsed.alias("d")).select("d.*")
    model = F.when(F.col("model.vocab").isNull(), F.raise_error(F.lit("no vocabulary in the tokenizer document"))).otherwise(F.col("model"))
    read = read.withColumn("model", model)
    listed = read.select(F.explode("model.vocab").alias("token", "id"), F.lit(False).alias("special"))
    added = read.select(F.inline("added_tokens")).select(F.col("content").alias("token"), "id", F.coalesce("special", F.lit(False)).alias("special"))
    vocab = listed.union(added).groupBy("id", "token").agg(F.max("special").alias("special"))
    raw = F.col("model.merges")
    apart = F.transform(F.from_json(raw, "array<string>"), lambda m: F.split(m, " ", 2))
    pairs = F.when(raw.rlike(r"^\[\s*\["), F.from_json(raw, "array<array<string>>")).otherwise(apart)
    merges = read.select(F.posexplode(pairs).alias("rank", "pair"))
    prefix_space = read.select(F.coalesce("pre_tokenizer.add_prefix_space", F.lit(False))).first()[0]
    return Tokenizer(vocab, merges.select("rank", F.col("pair")[0].alias("left"), F.col("pair")[1].alias("right")), prefix_space)


def read_special_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per token that a tokenizer config adds: ``(id, token, flags…, role)``.

    ``role`` says which of bos, eos, pad and unk the token serves as, if any.
    """
    config = _config(spark, path)
    return config.select(
        F.explode("added_tokens_decoder").alias("id", "added"), *_ROLES.values()
    ).select(
        F.col("id").cast("int").alias("id"),
        F.col("added.content").alias("token"),
        "added.lstrip", "added.normalized", "added.rstrip", "added.single_word", "added.special",
        F.coalesce(
            *[F.when(F.col("added.content") == F.col(c), role) for role, c in _ROLES.items()]
        ).alias("role"),
    )


def read_token_roles(spark: SparkSession, path: str) -> DataFrame:
    """``(bos, eos, pad, unk, add_bos, add_eos)`` of a tokenizer config, as one row."""
    return _config(spark, path).select(
        *[F.col(column).alias(role) for role, column in _ROLES.items()],
        F.col("add_bos_token").alias("add_bos"),
        F.col("add_eos_token").alias("add_eos"),
    )


def read_special_tokens_map(spark: SparkSession, path: str) -> DataFrame:
    """``(role, token, flags…)`` of a special-token map."""
    table = spark.read.option("multiLine", True).schema(
        ", ".join(f"{column} STRUCT<content STRING, {_FLAGS}>" for column in _ROLES.values())
    ).json(path)
    entries = F.array(
        *[F.struct(F.lit(role).alias("role"), F.col(c).alias("t")) for role, c in _ROLES.items()]
    )
    return (
        table.select(F.inline(entries))
        .filter(F.col("t").isNotNull())
        .select("role", F.col("t.content").alias("token"), "t.lstrip", "t.normalized", "t.rstrip", "t.single_word")
    )


def _config(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(CONFIG_SCHEMA).json(path)
