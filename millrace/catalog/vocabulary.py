"""Queries over words, merges and encodings."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import fragments as q
from millrace.catalog import tables as t
from millrace.functions.text import SPECIAL_TOKENS
from millrace.operators.bpe import Vocabulary, build_vocab, train_bpe, vocab_size
from millrace.operators.encode import decode, encode
from millrace.operators.words import (
    alphabet,
    corpus_words,
    pair_counts,
    pretokenize,
    word_counts,
    word_symbols,
)
from millrace.plans.training_rows import train_tokenizer
from millrace.session import checkpoint_dir, cut_lineage
from millrace.sources.vocabulary import Tokenizer, read_tokenizer, write_tokenizer

# As many merges as the oracle queries spell out step by step.
MERGES = 48


def small_vocabulary(texts: DataFrame) -> Vocabulary:
    counts = cut_lineage(word_counts(corpus_words(texts, "text")))
    return train_bpe(counts, len(SPECIAL_TOKENS) + alphabet(counts).count() + MERGES)


_TRAINED: dict[tuple[str, str], str] = {}


def full_vocabulary(spark: SparkSession, sf_dir: str) -> Tokenizer:
    """The vocabulary of the reference settings, learned from the documents.

    It is trained once in a session and kept as a tokenizer document.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        path = f"{checkpoint_dir(spark)}/tokenizer-{uuid4().hex}"
        learned = train_tokenizer(t.documents(spark, sf_dir), 6400, 2)
        write_tokenizer(learned.vocab, learned.merges, path)
        _TRAINED[key] = path
    return read_tokenizer(spark, _TRAINED[key])


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pretokenize(t.documents(spark, sf_dir), "doc_id", "text")


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_counts(corpus_words(t.documents(spark, sf_dir), "text"))


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alphabet(counts(spark, sf_dir))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_counts(word_symbols(counts(spark, sf_dir)))


def merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_vocabulary(t.documents(spark, sf_dir)).merges


def full_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary size and least count of the reference settings."""
    return train_tokenizer(t.documents(spark, sf_dir), 6400, 2).merges


def vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built again from symbols and merges, not taken from the training run."""
    texts = t.documents(spark, sf_dir)
    learned = small_vocabulary(texts)
    return build_vocab(
        SPECIAL_TOKENS, alphabet(word_counts(corpus_words(texts, "text"))), learned.merges
    )


def size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab_size(small_vocabulary(t.documents(spark, sf_dir)).vocab)


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = t.documents(spark, sf_dir)
    learned = small_vocabulary(texts)
    encoded = encode(texts, "doc_id", "text", learned.vocab, learned.merges)
    return encoded.select(F.col("key").alias("doc_id"), t.joined("ids"))


def texts_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded and decoded: the text with the space that splitting puts before it."""
    texts = t.documents(spark, sf_dir)
    learned = small_vocabulary(texts)
    encoded = encode(texts, "doc_id", "text", learned.vocab, learned.merges)
    return decode(encoded, "ids", learned.vocab).select(F.col("key").alias("doc_id"), "text")


def full_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned = full_vocabulary(spark, sf_dir)
    encoded = encode(t.documents(spark, sf_dir), "doc_id", "text", learned.vocab, learned.merges)
    return encoded.select(F.col("key").alias("doc_id"), t.joined("ids"))


def full_texts_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned = full_vocabulary(spark, sf_dir)
    encoded = encode(t.documents(spark, sf_dir), "doc_id", "text", learned.vocab, learned.merges)
    return decode(encoded, "ids", learned.vocab).select(F.col("key").alias("doc_id"), "text")


_BPE = f"WITH {q.bpe('SELECT text FROM documents', MERGES)}"
_SPECIALS = "(VALUES (0, '<s>', TRUE), (1, '</s>', TRUE), (2, '<pad>', TRUE), (3, '<unk>', TRUE))"
# A text may get the space before it as a symbol of its own.
_LETTERS = (
    f"SELECT DISTINCT {q.symbol_of('b')} AS symbol FROM "
    f"(SELECT unnest({q.byte_list('text')}) AS b FROM documents UNION ALL SELECT 32)"
)

QUERIES = {
    "t1_pretokenize": (
        words,
        "SELECT doc_id AS key, unnest(range(len(w)))::INTEGER AS pos, unnest(w) AS word FROM "
        f"(SELECT doc_id, {q.word_list('text')} AS w FROM documents)",
    ),
    "t2_word_counts": (
        counts,
        f"SELECT word, count(*) AS n FROM (SELECT unnest({q.word_list('text')}) AS word FROM documents) GROUP BY word",
    ),
    "t3_alphabet": (letters, _LETTERS),
    "t4_pair_counts": (
        pairs,
        f"WITH spelled AS (SELECT {q.symbols('word')} AS s, count(*) AS n FROM "
        f"(SELECT unnest({q.word_list('text')}) AS word FROM documents) GROUP BY word) "
        'SELECT substr(s, p, 1) AS "left", substr(s, p + 1, 1) AS "right", sum(n)::BIGINT AS n '
        "FROM (SELECT s, n, unnest(range(1, length(s))) AS p FROM spelled) GROUP BY 1, 2",
    ),
    "t5_train_bpe": (
        merges, f'{_BPE} SELECT rank, l AS "left", r AS "right" FROM tokens WHERE rank IS NOT NULL',
    ),
    "t5_train_bpe_6400": (full_merges, None),
    "t6_build_vocab": (
        vocab, f"{_BPE} SELECT id, token, FALSE AS special FROM tokens UNION ALL SELECT * FROM {_SPECIALS}",
    ),
    "t7_vocab_size": (
        size, f"SELECT count(*) + 4 + {MERGES} AS vocab_size FROM ({_LETTERS})",
    ),
    "e1_encode": (
        ids,
        f"{_BPE}, {q.encoded('e', 'SELECT doc_id, text FROM documents', 'doc_id')} "
        f"SELECT doc_id, {q.numbers('ids')} AS ids FROM e",
    ),
    "e4_decode": (texts_again, f"SELECT doc_id, {q.prefixed('text')} AS text FROM documents"),
    "e1_encode_6400": (full_ids, None),
    "e4_decode_6400": (full_texts_again, f"SELECT doc_id, {q.prefixed('text')} AS text FROM documents"),
}
