"""Features of documents and a softmax classifier on them.

Words are hashed into buckets, of which a document has each once; shape is a handful
of counts about layout and characters; tags are the hashed values of other columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from millrace.llm.common import slices

WORD_BUCKETS = 1 << 16
TAG_BUCKETS = 1 << 9
SHAPE = 11
STEPS = 60
PENALTY = 1.0
#: Fewer documents than this tell nothing about a feature; its weight stays zero.
LEAST_SEEN = 8

#: Words whose buckets a task remembers before it starts anew; workers keep them from one stage to the next.
REMEMBERED_WORDS = 50_000

_SPACES = b" \t\n\x0b\x0c\r"
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word) % WORD_BUCKETS
        return value


_WORDS = _Buckets()


def buckets_of(words: list[bytes]) -> np.ndarray:
    """The distinct buckets of a document's words."""
    if len(_WORDS) > REMEMBERED_WORDS:
        _WORDS.clear()
    return np.unique(np.fromiter(map(_WORDS.__getitem__, words), np.int64, len(words)))


def shape_of(text: bytes, words: list[bytes]) -> list[float]:
    """Logarithm of the length, mean length of words, and shares of kinds of characters."""
    n, letters = max(1, len(words)), max(1, sum(map(len, words)))
    share = lambda some: (len(text) - len(text.translate(None, some))) / letters
    return [
        float(np.log1p(len(words))),
        letters / n,
        share(b"#*$%&"),
        words.count(b"|") / n,
        share(b"!"),
        share(_UPPER),
        share(_DIGITS),
        text.count(b"\n") / n,
        1 - len(set(words)) / n,
        share(bytes(range(128, 256))),
        share(b".,;:?"),
    ]


def tags_of(values: Iterable[object]) -> list[int]:
    """A bucket for each of a row's other values, by its place."""
    return [xxhash.xxh3_64_intdigest(f"{k}={v}") % TAG_BUCKETS for k, v in enumerate(values)]


def features(rows: DataFrame, metadata: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, label, buckets, tags, shape`` of rows with columns doc_id, label, text and ``metadata``."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                values = zip(*(part.column(c).to_pylist() for c in metadata), strict=True) if metadata else [()] * len(texts)
                words = [pa.array(buckets_of(text.lower().split()), pa.int32()) for text in texts]
                shapes = [shape_of(text, text.split()) for text in texts]
                columns = [pa.array(words, pa.list_(pa.int32())), pa.array(map(tags_of, values), pa.list_(pa.int32())), pa.array(shapes, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), *columns], ["doc_id", "label", "buckets", "tags", "shape"])

    label = rows.schema["label"].dataType.simpleString()
    schema = f"doc_id long, label {label}, buckets array<int>, tags array<int>, shape array<double>"
    return rows.select("doc_id", "label", "text", *metadata).mapInArrow(found, schema)


@dataclass
class Design:
    """Sparse features (row and column of each) and dense ones of a number of documents."""

    rows: np.ndarray
    columns: np.ndarray
    dense: np.ndarray

    @classmethod
    def of(cls, sparse: list[np.ndarray], dense: list[list[float]], width: int) -> Design:
        columns = np.concatenate(sparse).astype(np.int64) if sparse else np.zeros(0, np.int64)
        return cls(np.repeat(np.arange(len(sparse)), [len(x) for x in sparse]), columns, np.array(dense, np.float64).reshape(len(sparse), width))

    @classmethod
    def gathered(cls, sparse: pa.ChunkedArray, dense: pa.ChunkedArray | None) -> Design:
        """From columns of lists, as ``features`` returns them."""
        lists = sparse.combine_chunks()
        rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        shape = np.zeros((len(lists), 0)) if dense is None else dense.combine_chunks().flatten().to_numpy().reshape(len(lists), -1 if len(lists) else SHAPE)
        return cls(rows, lists.flatten().to_numpy().astype(np.int64), shape)

    def __len__(self) -> int:
        return len(self.dense)

    def take(self, at: np.ndarray) -> Design:
        """The documents ``at``, which are distinct, in that order."""
        new = np.full(len(self), -1)
        new[at] = np.arange(len(at))
        rows = new[self.rows]
        return Design(rows[rows >= 0], self.columns[rows >= 0], self.dense[at])


class Softmax:
    """Penalised multinomial regression, fitted by gradient steps with momentum."""

    def __init__(self, design: Design, y: np.ndarray, classes: int, size: int, steps: int = STEPS, penalty: float = PENALTY) -> None:
        self.mean, self.spread = design.dense.mean(axis=0), design.dense.std(axis=0) + 1e-9
        self.sparse, self.dense = np.zeros((size, classes)), np.zeros((design.dense.shape[1] + 1, classes))
        target = np.eye(classes)[y]
        common = np.bincount(design.columns, minlength=size)[:, None] >= LEAST_SEEN
        moving = [[np.zeros_like(w), np.zeros_like(w)] for w in (self.sparse, self.dense)]
        for step in range(1, steps + 1):
            wrong = self.probabilities(design) - target
            slopes = [
                np.stack([np.bincount(design.columns, wrong[design.rows, k], size) for k in range(classes)], axis=1) * common + penalty * self.sparse,
                self._with_one(design.dense).T @ wrong + 0.1 * penalty * self.dense,
            ]
            for weights, slope, (speed, scale) in zip((self.sparse, self.dense), slopes, moving, strict=True):
                speed *= 0.9
                speed += 0.1 * slope
                scale *= 0.99
                scale += 0.01 * slope**2
                weights -= 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-9)

    def _with_one(self, dense: np.ndarray) -> np.ndarray:
        return np.column_stack([(dense - self.mean) / self.spread, np.ones(len(dense))])

    def scores(self, design: Design) -> np.ndarray:
        sparse = np.stack([np.bincount(design.rows, w[design.columns], len(design)) for w in self.sparse.T], axis=1)
        return sparse + self._with_one(design.dense) @ self.dense

    def probabilities(self, design: Design) -> np.ndarray:
        scores = self.scores(design)
        raised = np.exp(scores - scores.max(axis=1, keepdims=True))
        return raised / raised.sum(axis=1, keepdims=True)
