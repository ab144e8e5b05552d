import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import library_merges, library_tokenizer

from millrace.functions.text import SPECIAL_TOKENS
from millrace.operators import bpe
from millrace.operators.bpe import build_vocab, token_character, train_bpe, vocab_size
from millrace.operators.encode import encode
from millrace.operators.words import alphabet, corpus_words, word_counts
from millrace.sources.vocabulary import read_vocab, write_vocab


def train(spark, texts, size, least=2, width=1024):
    rows = spark.createDataFrame([(t,) for t in texts], "text STRING")
    return train_bpe(word_counts(corpus_words(rows, "text")), size, least, width=width)


def listed(learned):
    merges = [(r.left, r.right) for r in learned.merges.orderBy("rank").collect()]
    return merges, {r.token: r.id for r in learned.vocab.collect()}


def assert_like_library(spark, texts, size, least=2, width=1024, probes=()):
    learned = train(spark, texts, size, least, width)
    library = library_tokenizer(texts, size, least)
    merges, vocab = listed(learned)
    assert merges == library_merges(library)
    assert vocab == library.get_vocab()
    probes = [*texts, *probes]
    rows = spark.createDataFrame(list(enumerate(probes)), "key BIGINT, text STRING")
    ids = {r.key: r.ids for r in encode(rows, "key", "text", learned.vocab, learned.merges).collect()}
    assert [ids[i] for i in range(len(probes))] == [e.ids for e in library.encode_batch(probes)]


def test_tiny_corpus(spark):
    learned = train(spark, ["hello world hello"], 300)
    merges, vocab = listed(learned)
    assert len(vocab) == 17 and vocab["Ġhello"] == 16 and len(merges) == 5
    assert sorted(t for t, i in vocab.items() if 4 <= i <= 11) == ["d", "e", "h", "l", "o", "r", "w", "Ġ"]
    assert vocab_size(learned.vocab).first().vocab_size == 17


def words_of(letters, seed, n=60, longest=9):
    rng = random.Random(seed)
    return [
        " ".join("".join(rng.choices(letters, k=rng.randint(1, longest))) for _ in range(8)) for _ in range(n)
    ]


@pytest.mark.parametrize("letters,size,width", [("ab", 120, 1024), ("ab", 120, 3), ("aé中", 150, 8)])
def test_runs_and_ties(spark, letters, size, width):
    """Few letters make long runs and many pairs of one count."""
    probes = words_of(letters, 2, n=20, longest=20)
    assert_like_library(spark, words_of(letters, 1), size, width=width, probes=probes)


def test_early_stop(spark):
    assert_like_library(spark, ["aaaa aaaaa aa aaaaaaaa", "aaaa"], 400)
    assert_like_library(spark, ["only once each"], 400, least=2)
    assert_like_library(spark, ["only once each"], 400, least=1)


def test_vocabulary_smaller_than_alphabet(spark):
    assert_like_library(spark, ["abcdef abcdef"], 6)


def test_bounds_only_change_the_rounds(spark, monkeypatch):
    texts = words_of("abcde", 3, n=30)
    expected = listed(train(spark, texts, 80))
    monkeypatch.setattr(bpe, "MAX_PIECES", 5)
    monkeypatch.setattr(bpe, "MAX_PIECE_LENGTH", 4)
    monkeypatch.setattr(bpe, "ROUNDS_PER_CHECKPOINT", 2)
    assert listed(train(spark, texts, 80)) == expected


def test_build_vocab_and_round_trip(spark, tmp_path):
    texts = words_of("ab", 1)
    rows = spark.createDataFrame([(t,) for t in texts], "text STRING")
    counts = word_counts(corpus_words(rows, "text"))
    learned = train_bpe(counts, 90)
    built = build_vocab(SPECIAL_TOKENS, alphabet(counts), learned.merges)
    assert sorted(built.collect()) == sorted(learned.vocab.collect())
    write_vocab(learned.vocab, learned.merges, str(tmp_path))
    again = read_vocab(spark, str(tmp_path))
    assert listed(again) == listed(learned)


def test_token_characters_keep_id_order():
    characters = [token_character(i) for i in range(0, bpe.MAX_VOCABULARY, 997)]
    assert characters == sorted(characters)
    assert all(c.encode() for c in characters)
    assert token_character(bpe.MAX_VOCABULARY - 1) == chr(0x10FFFF)


def test_size_is_checked(spark):
    with pytest.raises(ValueError):
        train(spark, ["a"], bpe.MAX_VOCABULARY + 1)


def test_rounds_count_and_cut_in_arrays(monkeypatch):
    """A task hands on each pair once however its words come in batches, and pieces make up their words."""
    words, n = ["aab", "éa中b", "aaaa", "zé", "𝒳a𝒳a"], [2, 3, 5, 7, 11]
    batches = [pa.RecordBatch.from_arrays([pa.array(words[i : i + 2]), pa.array(n[i : i + 2])], ["symbols", "n"]) for i in (0, 2, 4)]
    expected = Counter()
    for word, times in zip(words, n):
        for pair in zip(word, word[1:]):
            expected["".join(pair)] += times
    for held in (1, 10**6):
        monkeypatch.setattr(bpe, "HELD_PAIRS", held)
        rows = [(bpe._pair_text(r["pair"]), r["n"]) for b in bpe._count_pairs(iter([*batches, batches[0].slice(0, 0)])) for r in b.to_pylist()]
        got = Counter()
        for pair, times in rows:
            got[pair] += times
        assert got == expected and (held == 1 or len(rows) == len(expected))
    known = np.array(sorted(map(bpe._pair_key, ["aa", "éa", "a𝒳"])))
    pieces, sizes, firsts = bpe._cut(pa.array(words), known)
    assert pieces.to_pylist() == ["aa", "b", "éa", "中", "b", "aaaa", "z", "é", "𝒳", "a𝒳", "a"]
    assert sizes.tolist() == [len(p) for p in pieces.to_pylist()] and firsts.tolist() == [0, 2, 5, 6, 8]
