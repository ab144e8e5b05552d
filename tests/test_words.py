import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from millrace.functions.text import (
    BYTE_SYMBOLS,
    SPECIAL_TOKENS,
    byte_symbols,
    latin1_as_utf8,
    split_words_and_specials,
    utf8_as_latin1,
)
from millrace.operators.words import alphabet, pair_counts, pretokenize, word_counts, word_symbols

EDGES = [
    "", " ", "\tabc", "a  b", "a\n\nb", "a \n", "it's we'll I'M", "x'd'sx", "12ab34 ½²", "é中文 テスト",
    " a b\u0085c", "a​b", "👍🏽 ok", " lead", "tab\tand\x0bvt\x1fus", "!!!  ???", "ſ'S", "  \n  x",
]


def test_matches_library_on_edges(spark):
    rows = spark.createDataFrame(list(enumerate(EDGES)), "key BIGINT, text STRING")
    words = pretokenize(rows, "key", "text").withColumn("word", byte_symbols(F.col("word")))
    got = {i: [] for i in range(len(EDGES))}
    for row in words.orderBy("key", "pos").collect():
        got[row.key].append(row.word)
    library = pre_tokenizers.ByteLevel(add_prefix_space=True)
    assert got == {i: [w for w, _ in library.pre_tokenize_str(t)] for i, t in enumerate(EDGES)}


def test_byte_symbols_cover_every_byte(spark):
    assert sorted(BYTE_SYMBOLS) == sorted(pre_tokenizers.ByteLevel.alphabet())
    text = "".join(chr(c) for c in range(0x500)) + "中👍"
    row = spark.createDataFrame([(text,)], "t STRING").select(
        byte_symbols(F.col("t")).alias("s"), latin1_as_utf8(utf8_as_latin1(F.col("t"))).alias("back")
    ).first()
    assert row.s == "".join(BYTE_SYMBOLS[b] for b in text.encode())
    assert row.back == text


def test_special_tokens_split_texts(spark):
    texts = ["hello<s>", "a<s>hello</s>", "<s><s>", "<pad>x <unk>", "<s", "", "x</s> y"]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = [r.w for r in rows.select(split_words_and_specials(F.col("t"), SPECIAL_TOKENS).alias("w")).collect()]
    assert got == [
        [" hello", "<s>"], [" a", "<s>", " hello", "</s>"], ["<s>", "<s>"],
        ["<pad>", " x", " ", "<unk>"], [" <", "s"], [], [" x", "</s>", " y"],
    ]


def test_null_text_fails(spark):
    rows = spark.createDataFrame([(1, None)], "key BIGINT, text STRING")
    with pytest.raises(SparkRuntimeException, match="text is null"):
        pretokenize(rows, "key", "text").collect()


def test_pairs_are_weighted_by_word_counts(spark):
    words = spark.createDataFrame([(" ab",), (" ab",), ("aaa",), ("a",)], "word STRING")
    counts = word_counts(words)
    assert {r.symbol for r in alphabet(counts).collect()} == {"Ġ", "a", "b"}
    pairs = {(r.left, r.right): r.n for r in pair_counts(word_symbols(counts)).collect()}
    assert pairs == {("Ġ", "a"): 2, ("a", "b"): 2, ("a", "a"): 2}
