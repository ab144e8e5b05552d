"""Tokenizer documents against the public package."""

import json

import pytest
from conftest import library_tokenizer
from tokenizers import Tokenizer

from millrace.operators.bpe import train_bpe
from millrace.operators.encode import encode
from millrace.operators.words import corpus_words, word_counts
from millrace.sources.vocabulary import read_tokenizer, write_tokenizer

CORPUS = ['the "cat" sat\\on the mat [ [ ["a", "b"] ]', "é中文 \x00\x7f\t\n 👍 the cats sat", "{} [x] [y] [x] // \\n"] * 3
PROBES = [*CORPUS, "the<s>cat</s> sat", "  the", "", "unseen: ß <pad>"]


def ids_of(spark, tokenizer, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "key BIGINT, text STRING")
    encoded = encode(rows, "key", "text", tokenizer.vocab, tokenizer.merges, prefix_space=tokenizer.prefix_space)
    return [r.ids for r in encoded.orderBy("key").collect()]


def tables(tokenizer):
    return sorted(tokenizer.vocab.select("id", "token", "special").collect()), sorted(tokenizer.merges.collect())


@pytest.mark.parametrize("prefix_space", [True, False])
def test_the_package_loads_what_is_written(spark, tmp_path, prefix_space):
    rows = spark.createDataFrame([(t,) for t in CORPUS], "text STRING")
    learned = train_bpe(word_counts(corpus_words(rows, "text", prefix_space)), 130)
    write_tokenizer(learned.vocab, learned.merges, str(tmp_path / "t"), prefix_space)
    (part,) = (tmp_path / "t").glob("part-*")
    library = Tokenizer.from_file(str(part))
    again = read_tokenizer(spark, str(tmp_path / "t"))
    assert tables(again) == (sorted(learned.vocab.collect()), sorted(learned.merges.collect()))
    assert again.prefix_space is prefix_space
    expected = [e.ids for e in library.encode_batch(PROBES)]
    assert ids_of(spark, again, PROBES) == expected
    assert [library.decode(ids) for ids in expected[:2]] == [" " * prefix_space + t for t in CORPUS[:2]]


@pytest.mark.parametrize("legacy", [False, True])
def test_documents_of_the_package_are_read(spark, tmp_path, legacy):
    """Both spellings of merges; some look like lists themselves."""
    library = library_tokenizer(CORPUS, 130)
    document = json.loads(library.to_str())
    if legacy:
        document["model"]["merges"] = [m if isinstance(m, str) else " ".join(m) for m in document["model"]["merges"]]
    document["added_tokens"].append({**document["added_tokens"][0], "id": 777, "content": "<｜new｜>", "special": True})
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(document, ensure_ascii=legacy, indent=None if legacy else 1))
    read = read_tokenizer(spark, str(path))
    assert {r.token: r.id for r in read.vocab.collect()} == {**library.get_vocab(), "<｜new｜>": 777}
    assert ids_of(spark, read, PROBES) == [e.ids for e in library.encode_batch(PROBES)]
    assert ids_of(spark, read, ["a<｜new｜>"])[0][-1] == 777


def test_other_documents_fail(spark, tmp_path):
    path = tmp_path / "tokenizer.json"
    path.write_text('{"model": {"type": "BPE"}}')
    with pytest.raises(Exception, match="no vocabulary"):
        read_tokenizer(spark, str(path)).vocab.collect()
