"""The vocabulary of 6,400 tokens, and rows made with it, against the public package."""

import pytest
from conftest import library_merges, library_tokenizer
from pyspark.sql import functions as F

from millrace.catalog import CATALOG
from millrace.catalog import tables as t
from millrace.functions.render import ChatTemplate, render_human_assistant, render_role_prefix
from millrace.operators.conversations import preference_pairs, select_text

SF_DIR = "/root/testdata/sf0.001"
N, PAD = 512, 2


@pytest.fixture(scope="module")
def library(spark):
    texts = [r.text for r in t.documents(spark, SF_DIR).orderBy("doc_id").collect()]
    return library_tokenizer(texts, 6400)


def rows_of(spark, name):
    return {r[0]: [[int(x) for x in text.split()] for text in r[1:]] for r in CATALOG[name][0](spark, SF_DIR).collect()}


def test_all_merges_equal_the_library_at_a_larger_size(spark):
    """Every one of the 6,294 merges of the thousand documents."""
    sf_dir = "/root/testdata/sf0.01"
    learned = CATALOG["t5_train_bpe_6400"][0](spark, sf_dir)
    library = library_tokenizer([r.text for r in t.documents(spark, sf_dir).collect()], 6400)
    merges = [(r.left, r.right) for r in learned.orderBy("rank").collect()]
    assert merges == library_merges(library) and len(merges) == 6294


def test_ids(spark, library):
    got = rows_of(spark, "e1_encode_6400")
    texts = {r.doc_id: r.text for r in t.documents(spark, SF_DIR).collect()}
    assert got == {k: [library.encode(text).ids] for k, text in texts.items()}


def causal(ids):
    ids = ids[:N]
    padded = ids + [PAD] * (N - len(ids))
    return [padded, [1] * len(ids) + [0] * (N - len(ids)), [-100 if i == PAD else i for i in padded]]


@pytest.mark.parametrize(("name", "renderer"), [
    ("pretrain_rows_6400", None), ("sft_rows_6400", render_role_prefix), ("lora_rows_6400", render_human_assistant),
])
def test_causal_rows(spark, library, name, renderer):
    source = t.documents(spark, SF_DIR) if renderer is None else t.conversations(spark, SF_DIR)
    key = source.columns[0]
    texts = {r[0]: r.text for r in select_text(source, key, renderer).collect()}
    got = rows_of(spark, name)
    assert got == {k: causal(library.encode(text).ids) for k, text in texts.items()} and len(got) >= 20


def test_preference_rows(spark, library):
    pairs = preference_pairs(t.preferences(spark, SF_DIR), "conv_id", ChatTemplate()).collect()
    expected = {}
    for r in pairs:
        chosen, rejected = (library.encode(x).ids for x in (r.chosen, r.rejected))
        prompt = chosen[-256:]
        sides = []
        for side in (chosen, rejected):
            head = side[: N - len(prompt)]
            sides += [prompt + head, [-100] * len(prompt) + head]
        expected[r.conv_id] = sides
    assert rows_of(spark, "dpo_rows_6400") == expected
