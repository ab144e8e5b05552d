"""Phrase collocations against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import phrases
from millrace.llm.phrases import Mining, mined

SF_DIR = "/root/testdata/sf0.001"


def brute_force(rows, mining):
    """Every phrase counted and every cut tried."""
    total, counts = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, mining.longest + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    result = []
    for lang, f in counts.items():
        candidates = {q: a for q, a in f.items() if len(q) > 1 and a >= mining.least}
        taken = set()
        for q, a in candidates.items():
            for m in range(2, len(q)):
                inner = {q[i : i + m] for i in range(len(q) - m + 1)}
                taken |= {p for p in inner if 100 * a >= mining.absorb * f[p]}
        scored = []
        for q, a in candidates.items():
            if q not in taken:
                score, k = min((1000 * a * total[lang] // (f[q[:k]] * f[q[k:]]), k) for k in range(1, len(q)))
                scored.append((-score, -a, " ".join(q).encode(), f[q[:k]], f[q[k:]]))
        for place, (score, a, q, l, r) in enumerate(sorted(scored)[: mining.best], 1):
            result.append((lang, place, q.decode(), -a, l, r, total[lang], -score))
    return sorted(result)


def result(df):
    return sorted(tuple(r) for r in df.drop("cut").collect())


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("mining", [Mining(4, 5, 40), Mining(3, 3, 25, 60)])
def test_phrases_equal_brute_force(documents, mining):
    rows = [(r.lang, r.text) for r in documents.select("lang", "text").collect()]
    expected = brute_force(rows, mining)
    assert result(mined(documents, mining)) == expected and len(expected) > 20


def test_a_small_frontier_settles_without_the_frequent_words(documents, monkeypatch):
    """The search stops early, and yet nothing that it left closed belongs to the result."""
    opened = []
    inner = phrases._opened

    def noted(*args):
        limits = inner(*args)
        opened.append(limits)
        return limits

    monkeypatch.setattr(phrases, "_opened", noted)
    mining = Mining(3, 5, 5)
    rows = [(r.lang, r.text) for r in documents.select("lang", "text").collect()]
    assert result(mined(documents, mining)) == brute_force(rows, mining)
    most = {r.lang: r.upto for r in opened[-1].collect()}
    commonest = Counter(w for lang, text in rows if lang == "en" for w in text.lower().split()).most_common(1)[0][1]
    assert most["en"] < commonest / 10


def test_false_hits_of_bit_tables_change_nothing(documents, monkeypatch):
    """Every position counts as a hit."""
    monkeypatch.setattr(phrases, "_bits", lambda counted: None)
    monkeypatch.setattr(phrases, "_among", lambda keys, table: np.ones(len(keys), bool))
    mining = Mining(5, 4, 30)
    rows = [(r.lang, r.text) for r in documents.select("lang", "text").collect()]
    assert result(mined(documents, mining)) == brute_force(rows, mining)


def test_ties_are_cut_in_byte_order(spark):
    """Forty phrases with one score, of which seven are wanted; a hot language; pieces end phrases."""
    texts = [f"x{k} y{k}. z{k}" for k in range(40)] * 3
    rows = [("en", t) for t in texts] + [(None, "É é. É é; tab\tTAB, tab\ttab"), ("", "a b a b a b"), ("en", None), ("en", ""), ("de", " .\n; ")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    mining = Mining(2, 5, 7)
    got = result(mined(docs, mining))
    assert got == brute_force(rows, mining)
    assert [r[2] for r in got if r[0] == "en"] == sorted(f"x{k} y{k}" for k in range(40))[:7]


def test_phrases_of_edge_documents(spark, edge_documents, no_documents):
    mining = Mining(20, 5, 50)
    rows = [(r.lang, r.text) for r in edge_documents.collect()]
    assert result(mined(edge_documents, mining)) == brute_force(rows, mining)
    assert result(mined(no_documents, mining)) == []
    assert result(mined(edge_documents.filter("text is null"), mining)) == []
