import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import library_tokenizer

from millrace.functions.merge import Merges
from millrace.functions.text import BYTE_SYMBOLS
from millrace.operators import encode as module
from millrace.operators.encode import check_ids, decode, encode, resolve_specials
from millrace.operators.words import corpus_words, word_counts
from millrace.operators.bpe import train_bpe

CORPUS = ["hello world hello"]


@pytest.fixture(scope="module")
def learned(spark):
    rows = spark.createDataFrame([(t,) for t in CORPUS], "text STRING")
    return train_bpe(word_counts(corpus_words(rows, "text")), 300)


def ids_of(spark, learned, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "key BIGINT, text STRING")
    encoded = encode(rows, "key", "text", learned.vocab, learned.merges)
    return [r.ids for r in encoded.orderBy("key").collect()]


def test_fixture_rows(spark, learned):
    texts = ["hello", "hello é中 zz", "hello<s>", "", "a<s>hello</s>", "é"]
    assert ids_of(spark, learned, texts) == [[16], [16, 11, 11], [16, 0], [], [11, 0, 16, 1], [11]]


def test_like_library(spark, learned):
    library = library_tokenizer(CORPUS, 300)
    texts = ["hello hello", "low  hold\nworld", "hello<s>world</s> <pad>", "<s>", "held<unk>", "中hello", "oooo lll"]
    assert ids_of(spark, learned, texts) == [e.ids for e in library.encode_batch(texts)]


def test_several_columns_and_other_keys(spark, learned):
    rows = spark.createDataFrame([("k", "hello", "world")], "id STRING, a STRING, b STRING")
    encoded = encode(rows, "id", ["a", "b"], learned.vocab, learned.merges)
    assert encoded.columns == ["key", "a", "b"]
    row = encoded.first()
    assert (row.key, row.a) == ("k", [16])
    assert decode(encoded, "b", learned.vocab).first().text == " world"


def test_words_are_forgotten_in_time(spark, learned, monkeypatch):
    monkeypatch.setattr(module, "MAX_REMEMBERED_WORDS", 0)
    assert ids_of(spark, learned, ["hello world"] * 3) == [ids_of(spark, learned, ["hello world"])[0]] * 3


def test_empty_table(spark, learned):
    rows = spark.createDataFrame([], "key BIGINT, text STRING")
    assert encode(rows, "key", "text", learned.vocab, learned.merges).count() == 0


def test_decode_like_library(spark):
    texts = ["é中文 👍 naïve", "plain <s>text</s>"]
    rows = spark.createDataFrame([(t,) for t in texts], "text STRING")
    learned = train_bpe(word_counts(corpus_words(rows, "text")), 60)
    library = library_tokenizer(texts, 60)
    cases = [e.ids for e in library.encode_batch(texts)]
    cases += [ids[:n] for ids in cases for n in range(len(ids))] + [[9999, 5], [-100, -1, 6], []]
    table = spark.createDataFrame(list(enumerate(cases)), "key BIGINT, ids ARRAY<INT>")
    for skip in (True, False):
        got = [r.text for r in decode(table, "ids", learned.vocab, skip).orderBy("key").collect()]
        expected = [library.decode([i for i in ids if i >= 0], skip_special_tokens=skip) for ids in cases]
        assert got == expected


def test_big_vocabularies_and_other_characters(spark):
    """Ids far apart, more tokens than any plan could list, specials beyond the byte symbols, nulls."""
    tokens = [(3 * i, f"t{i}", False) for i in range(140_000)]
    vocab = spark.createDataFrame([*tokens, (1, "<｜s｜>", True), (4, "hé", False)], "id INT, token STRING, special BOOLEAN")
    cases = [[1, 4, 3], [3 * 139_999, 2, -3], [], None, [0, None, 6], [3 * 140_000]]
    table = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "key INT, ids ARRAY<INT>")
    got = {skip: [r.text for r in decode(table, "ids", vocab, skip).orderBy("key").collect()] for skip in (True, False)}
    assert got[False] == ["<｜s｜>h\ufffdt1", "t139999", "", None, "t0t2", ""]
    assert got[True] == ["h\ufffdt1", "t139999", "", None, "t0t2", ""]
    assert decode(table, "ids", vocab.limit(0)).orderBy("key").first().text == ""


LONG = ["hello world " * 90, "hello é中 zz " * 200, "é" * 3000 + " hello", "a<s>hello</s>" * 120, "   hello\n\n  world" * 150, "</s" * 700, "hello's " * 300, "", "w"]


@pytest.mark.parametrize("n", [0, 1, 7, 64])
@pytest.mark.parametrize("width", [1, 8])
def test_the_first_ids_are_those_of_the_whole_text(spark, learned, monkeypatch, n, width):
    """Also where bytes are unknown, special tokens are cut, or the head has too few words."""
    monkeypatch.setattr(module, "CHARACTERS_PER_WORD", width)
    rows = spark.createDataFrame(list(enumerate(LONG)), "key BIGINT, text STRING")
    head = encode(rows, "key", "text", learned.vocab, learned.merges, max_length=n)
    whole = encode(rows, "key", "text", learned.vocab, learned.merges)
    assert [r.ids for r in head.orderBy("key").collect()] == [r.ids[:n] for r in whole.orderBy("key").collect()]


def test_heads_are_all_that_tasks_see(spark, learned):
    """With every byte in the vocabulary, words beyond the limit never reach Python."""
    letters = [(100 + k, s, False) for k, s in enumerate(BYTE_SYMBOLS) if s not in "dehlorwĠ"]
    vocab = learned.vocab.union(spark.createDataFrame(letters, learned.vocab.schema))
    rows = spark.createDataFrame([(0, "held low " * 100_000)], "key BIGINT, text STRING")
    ids, _, specials = module._collect_vocabulary(vocab, learned.merges)
    words = module._leading_words(rows, ["text"], ids, specials, 16, True)
    assert words.selectExpr("size(text)").first()[0] == 16
    assert len(encode(rows, "key", "text", vocab, learned.merges, 16).first().ids) == 16


def test_check_ids(spark, learned):
    table = spark.createDataFrame([([0, 16, 17],), ([17, -5],)], "ids ARRAY<INT>")
    assert {(r.token_id, r.n) for r in check_ids(table, "ids", learned.vocab).collect()} == {(17, 2), (-5, 1)}


def test_special_fallbacks(spark):
    rows = [("b", "e", "p", "u"), (None, "e", None, "u"), (None, None, None, None), ("b", None, "p", None)]
    table = spark.createDataFrame(rows, "bos STRING, eos STRING, pad STRING, unk STRING")
    assert [tuple(r) for r in resolve_specials(table).collect()] == [
        ("b", "e", "p", "u"), ("<s>", "e", "e", "u"), ("<s>", "</s>", "</s>", None), ("b", None, "p", None),
    ]
    assert [tuple(r) for r in resolve_specials(table, pad_only=True).collect()] == [
        ("b", "e", "p", "u"), (None, "e", "e", "u"), (None, None, None, None), ("b", None, "p", None),
    ]


def test_many_words_at_once_merge_like_one_by_one():
    """Odd merges too: repeated letters, ranks that tie, a pair ranked before the token that it needs, bytes not in the vocabulary."""
    draw = random.Random(3)
    letters = "abcd"
    ids = {letter: k for k, letter in enumerate(letters)}
    pairs, tokens = {}, list(letters)
    for rank in range(40):
        left, right = draw.choice(tokens), draw.choice(tokens)
        pairs.setdefault((left, right), (draw.randrange(-20, 20), left + right))
        ids.setdefault(left + right, 100 + rank)
        tokens.append(left + right)
    words = ["".join(draw.choices("abcdx", k=draw.randrange(20))) for _ in range(3000)] + ["a" * 30, "", "xx"]
    for ranks in (pairs, {}):
        got = Merges(ids, ranks, BYTE_SYMBOLS).encode([w.encode() for w in words])
        assert [np.frombuffer(x, np.int32).tolist() for x in got] == [module._encode_word(w, ids, ranks) for w in words]
    assert Merges(ids, pairs, BYTE_SYMBOLS).encode([]) == []


@pytest.mark.parametrize("together", [1, 5, 10**9])
def test_batches_are_looked_at_in_parts(spark, learned, monkeypatch, together):
    """Parts of few words and ids give the same lists and texts as whole batches."""
    monkeypatch.setattr(module, "TOGETHER", together)
    texts = ["hello world", "", "hello", "w", "hello " * 40, ""]
    library = library_tokenizer(CORPUS, 300)
    assert ids_of(spark, learned, texts) == [library.encode(t).ids for t in texts]
    lists = pa.array([[16, 11], None, [], [10, 8, 16], [16] * 9, None], pa.list_(pa.int32()))
    parts = list(module._parts([lists, lists]))
    assert [start for start, _ in parts] == [0, *[end for _, end in parts][:-1]] and parts[-1][1] == len(lists)
    assert len(parts) > 2 if together < 10 else len(parts) == 1
    table = spark.createDataFrame([(k, x) for k, x in enumerate(lists.to_pylist())], "key INT, ids ARRAY<INT>").coalesce(1)
    got = [r.text for r in decode(table, "ids", learned.vocab).orderBy("key").collect()]
    assert got == [None if x is None else library.decode(x) for x in lists.to_pylist()]
