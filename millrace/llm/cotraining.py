"""Quality by co-training: what a text says and what its record looks like teach each other.

One view is the text: its words and its layout. The other is its metadata: language,
source, and length as recorded. Each view's classifier starts from labelled rows. In each
round both label all documents outside the labelled sample, and those that a view is
sure of teach the other, unless the other holds against it (metadata can't see an
insult). Teaching is a few gradient steps whose sums run over every such document, in
Spark; however many there are, those of a class weigh as much together as the labelled
rows of that class. Both views are then calibrated on labelled rows held out, and their
log odds combined by a regression on those rows. All documents are scored.

Features are written once and read by every step. What travels are the two models, the
ids of the sample, and sums as long as the models. Only the labelled rows are a sample:
at most SAMPLE, those with the smallest hashes of their ids.

Nulls and edges: a null text is empty; null metadata is a value of its own. Labels with
a null in either column say nothing; of several labels of a document the least counts.
If the labelled rows are of one class only, or none, every score is that class's, or one
half. Every input row gives one row. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written
from millrace.llm.mixing import label_sample
from millrace.llm.text_classifier import LEAST_SEEN, TAG_BUCKETS, WORD_BUCKETS, Design, Softmax, features

SAMPLE = 8_000
ROUNDS = 3
#: Gradient steps of a round, and how far one moves a weight at most.
STEPS = 5
RATE = 0.05
#: How sure a view has to be of a document to teach it.
SURE = 0.95
#: The share of labelled rows held out for calibration.
HELD = 0.3
PENALTY = 1.0
METADATA = ("lang", "source", "size")
#: Sums travel in pieces of so many numbers, packed, as most are zero in a small task.
PIECE = 1 << 14
#: Rows of features that a task looks at together.
ROWS = 2_000


def record_features(docs: DataFrame) -> DataFrame:
    """``doc_id, buckets, tags, shape`` of each document (columns doc_id, text, lang, source, n_chars)."""
    size = F.floor(4 * F.log2(F.greatest("n_chars", F.lit(0)) + 1))
    read = docs.select("doc_id", F.lit(None).cast("int").alias("label"), "text", "lang", "source", size.alias("size"))
    return features(read, METADATA).drop("label")


def designs(rows: pa.Table | pa.RecordBatch) -> tuple[Design, Design]:
    """Both views of rows of features: the text, and the record."""
    gathered = rows if isinstance(rows, pa.Table) else pa.Table.from_batches([rows])
    text, record = Design.gathered(gathered["buckets"], gathered["shape"]), Design.gathered(gathered["tags"], None)
    return text, record


def _chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


@dataclass(frozen=True)
class View:
    """Log odds of the good class, linear in sparse features and in dense ones on a common scale."""

    sparse: np.ndarray
    dense: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    @classmethod
    def fitted(cls, design: Design, y: np.ndarray, size: int) -> View:
        model = Softmax(design, y, 2, size, penalty=PENALTY)
        return cls(model.sparse[:, 1] - model.sparse[:, 0], model.dense[:, 1] - model.dense[:, 0], model.mean, model.spread)

    def _scaled(self, design: Design) -> np.ndarray:
        return np.column_stack([(design.dense - self.mean) / self.spread, np.ones(len(design))])

    def odds(self, design: Design) -> np.ndarray:
        return np.bincount(design.rows, self.sparse[design.columns], len(design)) + self._scaled(design) @ self.dense

    def slopes(self, design: Design, wrong: np.ndarray) -> np.ndarray:
        """Sums of errors by feature, the sparse ones first."""
        return np.concatenate([np.bincount(design.columns, wrong[design.rows], len(self.sparse)), self._scaled(design).T @ wrong])

    def weights(self) -> np.ndarray:
        return np.concatenate([self.sparse, self.dense])

    def with_weights(self, weights: np.ndarray) -> View:
        return replace(self, sparse=weights[: len(self.sparse)], dense=weights[len(self.sparse) :])


# --- lessons --------------------------------------------------------------------


def lesson(views: list[View], teachers: list[View], data: tuple[Design, Design]) -> np.ndarray:
    """For each view and class: how many documents teach it, their slopes, and how many have each feature.

    All follow each other in one list of numbers.
    """
    sure = [_chance(t.odds(d)) for t, d in zip(teachers, data, strict=True)]
    sums = []
    for k, (view, design) in enumerate(zip(views, data, strict=True)):
        now = _chance(view.odds(design))
        for good in (0, 1):
            other, own = (p if good else 1 - p for p in (sure[1 - k], sure[k]))
            taught = ((other >= SURE) & (own >= 0.5)).astype(np.float64)
            seen = np.bincount(design.columns, taught[design.rows], len(view.sparse))
            sums += [[taught.sum()], view.slopes(design, (now - good) * taught), seen]
    return np.concatenate(sums)


def _lessons(shared, sample: pa.Array):
    def lessons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            free = batch.filter(pc.invert(pc.is_in(batch.column("doc_id"), sample)))
            for start in range(0, free.num_rows, ROWS):
                sums = lesson(*shared.value, designs(free.slice(start, ROWS)))
                total = sums if total is None else total + sums
        if total is not None:
            pieces = [total[k : k + PIECE].astype(np.float32).tobytes() for k in range(0, len(total), PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), pa.array([zlib.compress(x, 1) for x in pieces], pa.binary())], ["piece", "sums"])

    return lessons


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each piece; a task holds one sum of each, however many come in."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, sums in zip(batch.column("piece").to_pylist(), batch.column("sums"), strict=True):
            values = np.frombuffer(zlib.decompress(sums.as_py()), np.float32)
            total[piece] = total[piece] + values if piece in total else values.astype(np.float64)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["piece", "sums"])


def lessons_of_all(rows: DataFrame, views: list[View], teachers: list[View], sample: pa.Array) -> np.ndarray | None:
    """The lesson of all rows of features outside the sample; None if there are none."""
    shared = rows.sparkSession.sparkContext.broadcast((views, teachers))
    schema = "piece int, sums binary"
    partial = rows.mapInArrow(_lessons(shared, sample), schema)
    pieces = partial.repartition("piece").mapInArrow(_added, schema).toArrow().sort_by("piece")
    shared.unpersist()
    return np.frombuffer(b"".join(pieces["sums"].to_pylist())) if pieces.num_rows else None


class Taught:
    """A view on its way: what it was labelled with, and the state of its descent."""

    def __init__(self, view: View, design: Design, y: np.ndarray) -> None:
        self.view, self.design, self.y = view, design, y
        self.known = np.bincount(design.columns, minlength=len(view.sparse))

    def start(self) -> None:
        self.speed = np.zeros(len(self.view.weights()))
        self.scale = np.zeros_like(self.speed)
        self.step = 0

    def move(self, sums: list[tuple[float, np.ndarray, np.ndarray]]) -> None:
        """One step along the labelled rows' slopes and those of the documents taught, by class."""
        weights = self.view.weights()
        slope = self.view.slopes(self.design, _chance(self.view.odds(self.design)) - self.y)
        seen = self.known.astype(np.float64)
        for good, (n, slopes, having) in enumerate(sums):
            if n:
                slope += slopes * min(1.0, np.count_nonzero(self.y == good) / n)
                seen += having
        size = len(self.view.sparse)
        slope += 0.5 * PENALTY * weights * np.r_[np.ones(size), np.full(len(weights) - size, 0.1)]
        slope[:size] *= seen >= LEAST_SEEN
        self.step += 1
        self.speed += 0.1 * (slope - self.speed)
        self.scale += 0.01 * (slope**2 - self.scale)
        moved = RATE * (self.speed / (1 - 0.9**self.step)) / (np.sqrt(self.scale / (1 - 0.99**self.step)) + 1e-9)
        self.view = self.view.with_weights(weights - moved)


def _split(sums: np.ndarray, views: list[View]) -> list[list[tuple[float, np.ndarray, np.ndarray]]]:
    out, at = [], 0
    for view in views:
        own = []
        for _ in (0, 1):
            width = len(view.weights())
            own.append((sums[at], sums[at + 1 : at + 1 + width], sums[at + 1 + width : at + 1 + width + len(view.sparse)]))
            at += 1 + width + len(view.sparse)
        out.append(own)
    return out


# --- scores ---------------------------------------------------------------------


def _together(odds: np.ndarray) -> np.ndarray:
    """Both views' log odds and the lower of them: one good reason to reject is enough."""
    return np.column_stack([odds, odds.min(axis=1)])


def _calibration(odds: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of log odds and an intercept, by Newton steps on a lightly penalised likelihood."""
    x = np.column_stack([odds, np.ones(len(y))])
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = _chance(x @ weights)
        slope = x.T @ (p - y) + 1e-2 * weights
        weights -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(weights)), slope)
    return weights


@dataclass(frozen=True)
class CoTrained:
    """Two views, and the regressions that calibrate and combine them; or a constant."""

    constant: float | None
    views: list[View]
    single: list[np.ndarray]
    both: np.ndarray | None

    def scores(self, data: tuple[Design, Design]) -> np.ndarray:
        """Columns: the combined probability, and that of each view."""
        if self.constant is not None:
            return np.full((len(data[0]), 3), self.constant)
        odds = np.stack([v.odds(d) for v, d in zip(self.views, data, strict=True)], axis=1)
        margins = [_together(odds) @ self.both[:-1] + self.both[-1], *(odds[:, k] * w[0] + w[1] for k, w in enumerate(self.single))]
        return _chance(np.stack(margins, axis=1))


def co_trained(rows: DataFrame, docs: DataFrame, labels: DataFrame, good: Column, sample: int = SAMPLE, rounds: int = ROUNDS) -> CoTrained:
    """The classifiers, from labels and from all ``rows`` of features."""
    chosen = label_sample(docs, labels, good.cast("int"), sample)
    told = rows.select("doc_id", F.struct("buckets", "tags", "shape").alias("r")).join(F.broadcast(chosen), "doc_id")
    table = told.groupBy("doc_id", "label").agg(F.min("r").alias("r")).select("doc_id", "label", "r.*").toArrow().sort_by("doc_id")
    y = table["label"].to_numpy().astype(np.int64)
    if len(set(y.tolist())) < 2:
        return CoTrained(float(y[0]) if len(y) else 0.5, [], [], None)
    labelled = designs(table)
    order = np.random.default_rng(5).permutation(len(y))
    held, base = order[: int(HELD * len(y))], order[int(HELD * len(y)) :]
    known = [design.take(base) for design in labelled]
    pupils = [Taught(View.fitted(d, y[base], size), d, y[base]) for d, size in zip(known, (WORD_BUCKETS, TAG_BUCKETS), strict=True)]
    ids = table["doc_id"].combine_chunks()
    for _ in range(rounds):
        teachers = [p.view for p in pupils]
        for pupil in pupils:
            pupil.start()
        for _ in range(STEPS):
            sums = lessons_of_all(rows, [p.view for p in pupils], teachers, ids)
            if sums is None:
                break
            for pupil, own in zip(pupils, _split(sums, teachers), strict=True):
                pupil.move(own)
    views = [p.view for p in pupils]
    at = held if len(set(y[held].tolist())) > 1 else order
    odds = np.stack([v.odds(d.take(at)) for v, d in zip(views, labelled, strict=True)], axis=1)
    return CoTrained(None, views, [_calibration(odds[:, [k]], y[at]) for k in (0, 1)], _calibration(_together(odds), y[at]))


def _score(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                found = model.value.scores(designs(part))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(found[:, k]) for k in range(3))], ["doc_id", "score", "text_score", "metadata_score"])

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, good: Column) -> DataFrame:
    """``doc_id, score, text_score, metadata_score`` of each document (columns doc_id, text, lang, source, n_chars)."""
    rows = written(record_features(docs))
    shared = docs.sparkSession.sparkContext.broadcast(co_trained(rows, docs, labels, good))
    return rows.mapInArrow(_score(shared), "doc_id long, score double, text_score double, metadata_score double")
