"""From raw documents to packed sequences, in five stages.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next one's documents; all but the last return the columns of documents.
Rows with a null or a repeated doc_id are judged each by itself: quality and mixing carry
a row's columns through the operator. Near duplicates give every row a number of its own
and decide by it, so one row of each group stays whatever their ids are. Further columns
of the documents are dropped unread.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table, written
from millrace.llm.mixing import mixed_rates
from millrace.llm.near_duplicates import Banding, near_duplicates
from millrace.llm.packing import packed
from millrace.llm.pii import found_spans, redacted
from millrace.llm.quality import quality_rules
from millrace.llm.queries import DOMAIN

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Shares of tokens asked for by domain, of slightly more tokens than there are.
TARGETS = {"clean": 0.97, "junk": 0.03, "toxic": 0.0}
VOLUME = 1.1


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the rules and their language's band of perplexity."""
    read = docs.select(*COLUMNS, F.col("lang").alias("own_lang"))
    judged = quality_rules(read, carried=["text", "own_lang", "source", "n_chars"])
    return judged.filter("kept").withColumn("lang", F.col("own_lang")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that with the least doc_id: five words a shingle, similarity of 0.8 or more."""
    keyed = written(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")))
    nodes = keyed.select(F.col("row").alias("doc_id"), "text")
    found = near_duplicates(nodes, Banding(words=5, percent=80)).select(F.col("doc_id").alias("row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    kept = keyed.select("row", "doc_id").join(found, "row").groupBy("component_id").agg(first.alias("first")).select("first.row")
    return keyed.join(kept, "row", "left_semi").select(COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    text = redacted(F.col("text"), found_spans(F.col("text")))
    return docs.select(COLUMNS).withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the rates that bring their domains to the target weights.

    No rate is above one, so a document stays at most once. Where a rate is below one,
    a hash of the doc_id and the text decides; rows equal in both share their fate.
    """
    rates = mixed_rates(docs, table(spark, sf_dir, "labels"), F.expr(DOMAIN), TARGETS, VOLUME, highest=1.0, carried=COLUMNS[1:])
    drawn = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.coalesce("text", F.lit("")), F.lit("mix")), F.lit(1 << 30)) / (1 << 30)
    return rates.filter(drawn < F.col("rate")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their places in sequences."""
    return packed(docs.select(COLUMNS), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_domains),
    ("packing", pack),
]

#: Language models, hashed signatures and fitted rates have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
