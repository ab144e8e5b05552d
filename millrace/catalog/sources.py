"""Queries over sources, sinks, limits and projections."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import fragments as q
from millrace.catalog import tables as t
from millrace.catalog.vocabulary import MERGES, small_vocabulary
from millrace.functions.render import render_role_prefix
from millrace.operators.conversations import select_text
from millrace.operators.encode import check_ids, resolve_specials
from millrace.session import checkpoint_dir
from millrace.sources.jsonl import count_examples, limit_examples, read_jsonl, read_jsonl_quarantine
from millrace.sources.stages import input_version, keep_latest, latest_version, materialize_stage, materialize_version
from millrace.sources.vocabulary import read_tokenizer, read_vocab, write_tokenizer, write_vocab


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid4().hex}"


def jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "jsonl")
    source = t.table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "n_chars"])
    source.write.json(path)
    return read_jsonl(spark, path, source.schema)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some break off and some have no text: how many of each, and how many are good."""
    path = _folder(spark, "lines")
    source = t.table(spark, sf_dir, "documents", ["doc_id", "text", "n_chars"])
    line = F.to_json(F.struct("doc_id", F.expr("case when doc_id % 10 <> 7 then text end").alias("text"), "n_chars"))
    cut = F.when(F.col("doc_id") % 10 == 3, F.substring(line, 1, 12)).otherwise(line)
    source.select(cut.alias("value")).write.text(path)
    good, rejected = read_jsonl_quarantine(spark, path, "doc_id BIGINT, text STRING, n_chars BIGINT", ["text"])
    reasons = rejected.groupBy("reason").agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("chars"))
    return reasons.union(good.agg(F.lit("good").alias("reason"), F.count("*").alias("n"), F.sum("n_chars").alias("chars")))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])


def limit_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limit_examples(_orders(spark, sf_dir), 1000, ["o_orderkey"], "strict")


def limit_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows than the table has, which stays as it is."""
    return limit_examples(_orders(spark, sf_dir), 10_000_000, ["o_orderkey"], "clamp")


def limit_clamp_zero_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limit_examples(_orders(spark, sf_dir), 0, ["o_orderkey"], "clamp_zero_all")


def limit_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limit_examples(_orders(spark, sf_dir), 1234, ["o_orderdate", "o_orderkey"], "strict")


def limit_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fifths of the orders have no price to order by, and stand first."""
    priced = _orders(spark, sf_dir).withColumn("price", F.expr("case when o_orderkey % 5 > 1 then o_totalprice end"))
    return limit_examples(priced, 1400, ["price", "o_orderkey"], "clamp").select("o_orderkey")


def limit_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are alike but for their number, of which a limit takes as many from each day."""
    days = _orders(spark, sf_dir).select("o_orderdate", F.lit("order").alias("kind"))
    return limit_examples(days, 1100, ["o_orderdate"])


def count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_examples(t.table(spark, sf_dir, "documents", ["doc_id"]))


def vocab_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "vocab")
    learned = small_vocabulary(t.documents(spark, sf_dir))
    write_vocab(learned.vocab, learned.merges, path)
    return read_vocab(spark, path).vocab


def tokenizer_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of the document that was written, with the merge that makes it (rank -1: none)."""
    path = _folder(spark, "tokenizer")
    learned = small_vocabulary(t.documents(spark, sf_dir))
    write_tokenizer(learned.vocab, learned.merges, path)
    again = read_tokenizer(spark, path)
    made = again.merges.withColumn("token", F.concat("left", "right"))
    return again.vocab.join(made, "token", "left").select(
        "id", "token", "special", F.coalesce("rank", F.lit(-1)).alias("rank"),
        F.coalesce("left", F.lit("")).alias("left"), F.coalesce("right", F.lit("")).alias("right"),
    )


def stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second call finds the first one's rows."""
    path = _folder(spark, "stage")
    lines = t.table(
        spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    )
    materialize_stage(lines, path, sf_dir)
    return materialize_stage(lines, path, sf_dir)


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a stage, the first asked for again, and the newest read."""
    path = _folder(spark, "versions")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    columns = ["l_orderkey", "l_linenumber", "l_quantity"]
    small = lines.filter("l_linenumber = 1").select(columns)
    for rows, code in ((small, "first lines"), (lines.select(columns), "all lines"), (small, "first lines")):
        materialize_version(rows, path, input_version(lines, code=code))
    return latest_version(spark, path)


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = t.table(spark, sf_dir, "events", ["user_id", "event_id", "event_type", "value"])
    return keep_latest(runs, 3, ["user_id"], ["event_id"])


def latest_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = t.table(spark, sf_dir, "events", ["event_type", "event_id", "user_id", "value"])
    return keep_latest(runs, 1_500, ["event_type"], ["event_id"])


def text_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_text(t.conversations(spark, sf_dir), "conv_id", render_role_prefix)


def text_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.documents(spark, sf_dir).withColumn("input", F.lit("ignored"))
    return select_text(rows, "doc_id")


def text_from_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    return select_text(rows.withColumnRenamed("text", "input").withColumnRenamed("lang", "prompt"), "doc_id")


def text_from_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_text(t.benchmark(spark, sf_dir).withColumnRenamed("text", "prompt"), "item_id")


def plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_text(t.documents(spark, sf_dir), "doc_id", only="text")


def foreign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document bytes that no benchmark text has."""
    vocab = (
        t.benchmark(spark, sf_dir)
        .select(F.explode(t.byte_ids(F.col("text"))).alias("id"))
        .distinct()
    )
    return check_ids(t.document_bytes(spark, sf_dir), "ids", vocab)


def _special_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers stand in for tokenizers that lack this or that special token."""
    customers = t.table(
        spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey"]
    )
    return customers.select(
        F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment")).alias("bos"),
        F.when(F.col("c_acctbal") > 2000, F.col("c_mktsegment")).alias("eos"),
        F.when(F.col("c_nationkey") < 12, F.col("c_name")).alias("pad"),
        F.col("c_name").alias("unk"),
    )


def special_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_specials(_special_tokens(spark, sf_dir))


def pad_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_specials(_special_tokens(spark, sf_dir), pad_only=True)


_SPECIAL_TOKENS = (
    "named AS (SELECT CASE WHEN c_nationkey > 5 THEN c_mktsegment END AS bos, "
    "CASE WHEN c_acctbal > 2000 THEN c_mktsegment END AS eos, "
    "CASE WHEN c_nationkey < 12 THEN c_name END AS pad, c_name AS unk FROM customer)"
)
_ORDERS = "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders"

QUERIES = {
    "s1_read_jsonl": (jsonl, "SELECT doc_id, text, lang, n_chars FROM documents"),
    "s1_read_jsonl_quarantine": (
        quarantine,
        "SELECT CASE doc_id % 10 WHEN 3 THEN 'not JSON of the schema' WHEN 7 THEN 'text is null' ELSE 'good' END AS reason, "
        "count(*) AS n, (sum(CASE WHEN doc_id % 10 IN (3, 7) THEN 0 ELSE n_chars END))::BIGINT AS chars FROM documents GROUP BY 1",
    ),
    "s2_limit_strict": (limit_strict, f"{_ORDERS} ORDER BY o_orderkey LIMIT 1000"),
    "s2_limit_clamp": (limit_clamp, f"{_ORDERS} ORDER BY o_orderkey LIMIT 10000000"),
    "s2_limit_clamp_zero_all": (limit_clamp_zero_all, _ORDERS),
    "s2_limit_cut": (limit_cut, f"{_ORDERS} ORDER BY o_orderdate, o_orderkey LIMIT 1234"),
    "s2_limit_null_keys": (
        limit_null_keys,
        "SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 1 THEN o_totalprice END AS price FROM orders) "
        "ORDER BY price NULLS FIRST, o_orderkey LIMIT 1400",
    ),
    "s2_limit_ties": (
        limit_ties, "SELECT o_orderdate, 'order' AS kind FROM orders ORDER BY o_orderdate LIMIT 1100",
    ),
    "s3_count_examples": (count, "SELECT count(*) AS examples FROM documents"),
    "s5_vocab_round_trip": (
        vocab_round_trip,
        f"WITH {q.bpe('SELECT text FROM documents', MERGES)} SELECT id, token, FALSE AS special FROM tokens "
        "UNION ALL SELECT * FROM (VALUES (0, '<s>', TRUE), (1, '</s>', TRUE), (2, '<pad>', TRUE), (3, '<unk>', TRUE))",
    ),
    "s5_tokenizer_json_round_trip": (
        tokenizer_round_trip,
        f"WITH {q.bpe('SELECT text FROM documents', MERGES)} "
        "SELECT id, token, FALSE AS special, coalesce(rank, -1) AS rank, coalesce(l, '') AS \"left\", coalesce(r, '') AS \"right\" FROM tokens "
        "UNION ALL SELECT *, -1, '', '' FROM (VALUES (0, '<s>', TRUE), (1, '</s>', TRUE), (2, '<pad>', TRUE), (3, '<unk>', TRUE))",
    ),
    "s6_materialize_stage": (
        stage, "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem",
    ),
    "s6_stage_versions": (versions, "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem"),
    "s7_keep_latest": (
        latest,
        "SELECT user_id, event_id, event_type, value FROM events "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 3",
    ),
    "s7_keep_latest_many": (
        latest_many,
        "SELECT event_type, event_id, user_id, value FROM events "
        "QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 1500",
    ),
    "p1_select_text_conversations": (text_from_conversations, q.rendered(q.ROLE_PREFIX)),
    "p1_select_text_text": (text_from_text, "SELECT doc_id, text FROM documents"),
    "p1_select_text_input": (text_from_input, "SELECT doc_id, text FROM documents"),
    "p1_select_text_prompt": (text_from_prompt, "SELECT item_id, text FROM benchmark"),
    "p2_plain_text": (plain_text, "SELECT doc_id, text FROM documents"),
    "p5_check_ids": (
        foreign_ids,
        f"SELECT token_id, count(*) AS n FROM (SELECT unnest({q.byte_list('text')}) AS token_id FROM documents) "
        f"WHERE token_id NOT IN (SELECT unnest({q.byte_list('text')}) FROM benchmark) GROUP BY token_id",
    ),
    "e5_resolve_specials": (
        special_fallbacks,
        f"WITH {_SPECIAL_TOKENS} "
        "SELECT coalesce(bos, '<s>') AS bos, "
        "CASE WHEN pad IS NULL AND eos IS NULL THEN '</s>' ELSE eos END AS eos, "
        "coalesce(pad, eos, '</s>') AS pad, unk FROM named",
    ),
    "e5_resolve_specials_pad_only": (
        pad_fallback, f"WITH {_SPECIAL_TOKENS} SELECT bos, eos, coalesce(pad, eos) AS pad, unk FROM named",
    ),
}
