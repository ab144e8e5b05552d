"""Main text of web pages: a graphical model on the tree of elements.

Every element is content or not. An element's own evidence (its tag, the words of its
class, id and role, its text and links) gives it a potential; each parent and child
share another that says how labels go together, by the kind of the child. Sum-product
messages go upward from the leaves and downward from the root, and give each element
the marginal probability that it is content. The potentials come from labelled pages
(``html_examples``): the first by logistic regression on the evidence, the second from
the labels of parents and children. The number of pages is a parameter, the bound of
the sample.

Text stays in page order. White space inside a block becomes one space, blocks are
joined by one space, character references are decoded.

Nulls and edges: a null or empty page, and one without content, gives an empty text.
Every input row gives one row, repeated or not; columns other than those named are
not read. Pages may be of any length and nested to any depth.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.html_examples import labelled_pages
from millrace.llm.html_tree import BLOCK, Page, read

#: Labelled pages to train on: the bound of the sample.
EXAMPLES = 2_000
STEPS = 150
SMOOTHING = 1.0
#: The evidence of an element without any text. It says nothing about the elements around it.
EMPTY = "links -1"
PENALTY = 2.0

_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TEXTS = frozenset("p blockquote pre figcaption dd dt td th li caption".split())


def _kind(tag: str) -> str:
    return "heading" if tag in _HEADINGS else tag if tag in ("li", "p") else "text" if tag in _TEXTS else "box" if tag in BLOCK else "inline"


@lru_cache(maxsize=4096)
def _name_words(names: str) -> tuple[str, ...]:
    return tuple(sorted({w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower()) if w}))


def _size(n: int) -> int:
    return n.bit_length() // 2


def features(page: Page) -> list[list[str]]:
    """The evidence of each element."""
    nodes = page.nodes
    text, links, stops = ([getattr(n, k) for n in nodes] for k in ("text", "links", "stops"))
    for k in range(len(nodes) - 1, 0, -1):
        up = nodes[k].parent
        text[up] += text[k]
        links[up] += links[k]
        stops[up] += stops[k]
    found = []
    for k, node in enumerate(nodes):
        share = 4 * links[k] // text[k] if text[k] else -1
        own = [f"tag {node.tag}", f"all {_size(text[k])}", f"own {_kind(node.tag)} {_size(node.text)}", f"links {share}", f"stops {_size(stops[k])} {share > 0}"]
        names = " ".join(node.attributes[a] for a in ("class", "id", "role", "aria-label", "itemprop") if a in node.attributes)
        own += [f"name {w}" for w in _name_words(names)]
        if "hidden" in node.attributes or "none" in node.attributes.get("style", ""):
            own.append("hidden")
        found.append(own)
    return found


# --- training -------------------------------------------------------------------


def labels(page: Page) -> list[int]:
    """Labels of the elements of a labelled page: their own, or their parent's."""
    found = [0]
    for node in page.nodes[1:]:
        found.append(int(node.attributes.get("data-y", found[node.parent])))
    return found


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        evidence, kinds, above, y = [], [], [], []
        for source in batch.column("html").to_pylist():
            page = read(source)
            label = labels(page)
            for node, own, of in zip(page.nodes[1:], features(page)[1:], label[1:], strict=True):
                if EMPTY in own:
                    continue
                evidence.append(own)
                kinds.append(_kind(node.tag))
                above.append(label[node.parent])
                y.append(of)
        columns = [pa.array(evidence, pa.list_(pa.string())), pa.array(kinds, pa.string()), pa.array(above, pa.int32()), pa.array(y, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["evidence", "kind", "above", "y"])


def _logistic(evidence: list[list[str]], y: np.ndarray) -> dict[str, float]:
    """Weights of all features, by gradient steps on the penalised likelihood."""
    numbers: dict[str, int] = {}
    columns = np.array([numbers.setdefault(x, len(numbers)) for own in evidence for x in own])
    rows = np.repeat(np.arange(len(evidence)), [len(own) for own in evidence])
    weights, speed, scale = (np.zeros(len(numbers)) for _ in range(3))
    for step in range(1, STEPS + 1):
        margin = np.bincount(rows, weights[columns], len(y))
        slope = np.bincount(columns, (1 / (1 + np.exp(-margin)) - y)[rows], len(numbers)) + PENALTY * weights
        speed = 0.9 * speed + 0.1 * slope
        scale = 0.99 * scale + 0.01 * slope**2
        weights -= 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-9)
    return {name: float(weights[k]) for name, k in numbers.items()}


class TreeModel:
    """Potentials: an element's probability by its own evidence, and how much likelier a
    label is under each label of the parent than among all elements of that kind."""

    def __init__(self, examples: pa.Table) -> None:
        y = examples.column("y").to_numpy()
        kinds, above = examples.column("kind").to_numpy(zero_copy_only=False), examples.column("above").to_numpy()
        self.weights = _logistic(examples.column("evidence").to_pylist(), y)
        self.pairs = {}
        for kind in sorted(set(kinds)):
            both = np.array([[np.count_nonzero((kinds == kind) & (above == a) & (y == of)) for of in (0, 1)] for a in (0, 1)]) + SMOOTHING
            self.pairs[kind] = (both / both.sum(axis=1, keepdims=True) / (both.sum(axis=0) / both.sum())).tolist()

    def marginals(self, page: Page) -> list[float]:
        """The probability of each element to be content."""
        nodes, even = page.nodes, [[1.0, 1.0], [1.0, 1.0]]
        own, ties = [], []
        for node, found in zip(nodes, features(page), strict=True):
            if EMPTY in found:
                own.append([0.5, 0.5])
                ties.append(even)
                continue
            ties.append(self.pairs.get(_kind(node.tag), even))
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(self.weights.get(x, 0.0) for x in found)))))
            own.append([1 - p, p])
        own[0] = [0.5, 0.5]
        ties[0] = even
        upward: list[list[float]] = [[1.0, 1.0]] * len(nodes)
        for k in range(len(nodes) - 1, 0, -1):  # children come after their parents
            (a, b), tie = own[k], ties[k]
            m0, m1 = tie[0][0] * a + tie[0][1] * b, tie[1][0] * a + tie[1][1] * b
            upward[k] = [m0 / (m0 + m1), m1 / (m0 + m1)]
            up = own[nodes[k].parent]
            x, y = up[0] * upward[k][0], up[1] * upward[k][1]
            up[0], up[1] = x / (x + y), y / (x + y)
        # From here on ``own`` holds the product of evidence and all messages so far.
        for k in range(1, len(nodes)):
            up, tie = own[nodes[k].parent], ties[k]
            x, y = up[0] / max(upward[k][0], 1e-300), up[1] / max(upward[k][1], 1e-300)
            m0, m1 = x * tie[0][0] + y * tie[1][0], x * tie[0][1] + y * tie[1][1]
            a, b = own[k][0] * m0, own[k][1] * m1
            own[k][0], own[k][1] = a / (a + b), b / (a + b)
        return [p for _, p in own]


def train(spark: SparkSession, examples: int = EXAMPLES, seed: int = 1) -> TreeModel:
    """The model of so many labelled pages, read by Spark and fitted here."""
    pages = spark.createDataFrame([(x,) for x in labelled_pages(examples, seed)], "html string")
    rows = pages.mapInArrow(_examples, "evidence array<string>, kind string, above int, y int").toArrow()
    return TreeModel(rows)


# --- extraction -----------------------------------------------------------------


def main_text(source: str | None, model: TreeModel) -> str:
    page = read(source or "")
    content = [p > 0.5 for p in model.marginals(page)]
    blocks = (" ".join("".join(text for node, text in block if content[node]).split()) for block in page.blocks)
    return " ".join(b for b in blocks if b)


def _extract(model):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source, model.value) for source in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return extract


def extracted(pages: DataFrame, model: TreeModel) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page (columns page_id, url, html)."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    return pages.select("page_id", "url", "html").mapInArrow(_extract(shared), "page_id long, url string, text string, n_chars long")
