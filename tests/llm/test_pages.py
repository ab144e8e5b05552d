"""Extraction on pages made by hand, and on markup that isn't well formed."""

import pytest

from millrace.llm.html_content import extracted, main_text, train
from millrace.llm.html_tree import read

FIRST = "The ferry left the harbour at seven, an hour late, and nobody on the pier seemed to mind the rain."
SECOND = "By noon the wind had turned; the crew tied down what was loose, and the captain asked for more coffee."
PAGE = """<!DOCTYPE html><html><head><title>Ferries</title><script>var a = "<p>no</p>";</script></head><body>
<header><a href="/">Home</a> <a href="/news">News</a></header><nav><ul><li><a href="/a">Boats</a></li><li><a href="/b">Ports</a></li></ul></nav>
<article><h1>A late ferry</h1><p>{first}</p>{between}<p>{second}</p></article>
<aside class="sidebar"><h3>Popular</h3><ul><li><a href="/1">Ten harbours</a></li><li><a href="/2">Tides</a></li></ul></aside>
<div class="{comments}"><p>Great read, thanks for posting this one!</p></div>
<footer><p>Copyright 2020. <a href="/terms">Terms</a></p></footer></body></html>"""


@pytest.fixture(scope="module")
def model(spark):
    return train(spark)


def text_of(model, between="", comments="comments"):
    return main_text(PAGE.format(first=FIRST, second=SECOND, between=between, comments=comments), model)


def test_article_without_its_surroundings(model):
    assert text_of(model) == f"A late ferry {FIRST} {SECOND}"


def test_names_are_read_whole(model):
    assert text_of(model, comments=" ".join(f"c{k}-x" for k in range(200)) + " comments") == text_of(model)


@pytest.mark.parametrize("between", ["<svg width=1 />", "<svg/>", '<svg viewBox="0 0 1 1"><title>No</title><text>No</text></svg>', "<noscript><p>Please turn on scripts.</p></noscript>", "<p><img src=a/></p>", "<p><a href=http://x/></a></p>"])
def test_marks_between_paragraphs_lose_nothing(model, between):
    assert text_of(model, between) == text_of(model)


@pytest.mark.parametrize("tag", ["svg", "iframe", "script", "noscript", "template"])
def test_an_unclosed_tag_ends_with_its_parent(model, tag):
    assert text_of(model, f"<div><{tag}>hidden words</div>") == text_of(model)


def test_formulas_and_plain_listings_stay(model):
    text = text_of(model, "<p>The speed was <math><mi>v</mi><mo>=</mo><mn>3</mn></math> knots, as the log of the day says.</p>")
    assert f"{FIRST} The speed was v=3 knots, as the log of the day says. {SECOND}" in text
    blocks = ["".join(t for _, t in block) for block in read("<p>one</p><xmp>a <b>&amp; b</xmp><p>two").blocks]
    assert blocks == ["one", "a <b>&amp; b", "two"]


def test_many_unclosed_and_deeply_nested_tags(model):
    assert main_text("<svg>" * 20_000 + "x", model) == ""
    assert FIRST in main_text("<div>" * 3_000 + f"<article><p>{FIRST}</p><p>{SECOND}</p></article>" + "</div>" * 3_000, model)


def test_null_empty_and_repeated_pages(spark, model):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (3, "u", "<p>", "x"), (3, "u", "<p>", "x"), (None, "u", "text", "x")]
    got = extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), model)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect())[1:] == [(1, "", 0), (2, "", 0), (3, "", 0), (3, "", 0)]
    assert extracted(spark.createDataFrame([], "page_id long, url string, html string"), model).count() == 0
