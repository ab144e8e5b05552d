"""Mixing to target weights by soft membership.

A classifier fitted on labelled rows gives every document a posterior over domains.
Rates, one for each document and never negative, are then fitted so that the expected
tokens of the domains, rates times tokens times posteriors, come near their targets:
least squares with errors relative to a domain's present size, and a light pull of
every rate towards one. Documents whose posteriors round alike share a rate, so Spark
first adds the documents up by rounded posterior. The descent is a projected gradient
with momentum: each round, Spark sums the expected tokens of all domains, and the next
step of every rate follows from those few sums and the rounded posterior. Tasks
therefore replay the steps from the list of past sums; rates are never gathered. The
descent ends where rates are known to be near the best ones, and says what errors are
left: targets that no rates can reach leave some.

Tokens are words ``[^\\x20\\x09-\\x0D]+``. The classifier is fitted on at most SAMPLE
labelled rows, those with the smallest hashes of their ids; all else uses all rows.

Nulls and edges: a null text has no tokens and the posterior of an empty text; labels
with a null or without a document say nothing, of several labels of a document the
least counts, and of documents that repeat an id the least text. If no label is usable, every domain is
as likely. Every input row gives one row. Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from millrace.llm.common import slices, written
from millrace.llm.text_classifier import SHAPE, WORD_BUCKETS, Design, Softmax, buckets_of, features, shape_of

#: The most labelled rows that the classifier is fitted on.
SAMPLE = 6_000
PULL = 1e-3
#: Posteriors are told apart in steps of one part in so many.
GRID = 200
#: Cells of a task, and where their tasks follow the shuffle instead of the most cells there can be.
CELLS = 100_000
MANY = 200
#: How near rates come to the best ones.
WITHIN = 0.01


def design_of(texts: list[bytes]) -> tuple[Design, np.ndarray]:
    """Features of texts, and their numbers of words."""
    words = [text.lower().split() for text in texts]
    shapes = [shape_of(text, text.split()) for text in texts]
    return Design.of([buckets_of(w) for w in words], shapes, SHAPE), np.array([len(w) for w in words], np.int64)


def label_sample(docs: DataFrame, labels: DataFrame, label: Column, size: int) -> DataFrame:
    """At most ``size`` rows doc_id, label of documents with a label that isn't null; of several labels the least counts."""
    marked = labels.select("doc_id", label.alias("label")).filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    return marked.join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)


def labelled_documents(docs: DataFrame, chosen: DataFrame, columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """``doc_id, label`` and ``columns`` of the chosen documents; of rows that repeat an id the least counts."""
    rows = docs.select("doc_id", F.struct(*columns).alias("r")).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("r").alias("r")).select("doc_id", "label", "r.*")


class Domains:
    """The posterior over named domains, from a table of labelled features."""

    def __init__(self, names: list[str], known: pa.Table) -> None:
        self.names = names
        self.model = None
        known = known.filter(pc.is_in(known["label"], pa.array(names))).sort_by("doc_id")
        y = np.array([names.index(label) for label in known["label"].to_pylist()], np.int64)
        if len(set(y.tolist())) > 1:
            self.model = Softmax(Design.gathered(known["buckets"], known["shape"]), y, len(names), WORD_BUCKETS)
        self.only = int(y[0]) if len(y) else None

    def posteriors(self, design: Design) -> np.ndarray:
        if self.model:
            return self.model.probabilities(design)
        return np.tile(np.eye(len(self.names))[self.only] if self.only is not None else np.full(len(self.names), 1 / len(self.names)), (len(design), 1))


def _classify(domains, carried: Sequence[str]):
    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                design, tokens = design_of(texts)
                p = domains.value.posteriors(design)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), p.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*map(part.column, ["doc_id", *carried]), pa.array(tokens), lists], ["doc_id", *carried, "n_tokens", "posterior"])

    return classify


def posteriors(docs: DataFrame, labels: DataFrame, label: Column, names: list[str], sample: int = SAMPLE, carried: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, the columns ``carried``, ``n_tokens`` and ``posterior`` of each document (columns doc_id, text)."""
    known = labelled_documents(docs, label_sample(docs, labels, label, sample))
    domains = Domains(names, features(known).toArrow())
    shared = docs.sparkSession.sparkContext.broadcast(domains)
    read = docs.select(*dict.fromkeys(["doc_id", *carried, "text"]))
    found = [StructField("n_tokens", LongType()), StructField("posterior", ArrayType(DoubleType()))]
    return read.mapInArrow(_classify(shared, carried), StructType([*(read.schema[k] for k in ["doc_id", *carried]), *found]))


# --- rates ----------------------------------------------------------------------


@dataclass
class Step:
    """What a round leaves: the domains' relative errors, and the share of its movement that the next one adds."""

    errors: np.ndarray
    momentum: float = 0.0


@dataclass
class Place:
    """Rates after some steps: those of the last step, where the next one starts, and how they got there."""

    rates: np.ndarray
    ahead: np.ndarray
    moved: np.ndarray
    #: How far the last step went from where it started.
    pulled: np.ndarray


def replay(p: np.ndarray, steps: list[Step], highest: float) -> Place:
    """Rates that past steps make of one, for rows of posteriors."""
    rates = ahead = np.ones(len(p))
    moved = pulled = np.zeros(len(p))
    for step in steps:
        new = np.clip(ahead - (p @ step.errors + PULL * (ahead - 1)) / (1 + PULL), 0.0, highest)
        moved, pulled, rates = new - rates, new - ahead, new
        ahead = rates + step.momentum * moved
    return Place(rates, ahead, moved, pulled)


def cells(scored: DataFrame, width: int) -> DataFrame:
    """``cell, tokens, expected``: documents whose posteriors round alike, their tokens and expected tokens by domain.

    ``cell`` is the posterior in units of a GRID-th, so there are no more of them than such
    posteriors, however many documents there are.
    """
    sums = F.array(*(F.sum(F.col("n_tokens") * F.col("posterior")[k]) for k in range(width)))
    grouped = scored.groupBy(_cell().alias("cell")).agg(F.sum("n_tokens").alias("tokens"), sums.alias("expected"))
    # Rounding adds up to half a unit a domain to the whole: no more cells than such sums.
    most = comb(GRID + width // 2 + width, width) - comb(GRID - width // 2 - 1 + width, width)
    return grouped.repartition(1 + most // CELLS) if most < MANY * CELLS else grouped


def _cell() -> Column:
    return F.transform("posterior", lambda p: F.rint(p * GRID).cast("int"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _expected(steps: list[Step], highest: float, width: int):
    """Sums of a part of the cells: tokens of each domain as they are, and at the rates ahead; then tokens, and two sums of the last step."""

    def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * width + 3)
        for batch in batches:
            if batch.num_rows:
                at = replay(_matrix(batch.column("cell"), width) / GRID, steps, highest)
                tokens, sums = batch.column("tokens").to_numpy().astype(np.float64), _matrix(batch.column("expected"), width)
                total += np.concatenate([sums.sum(axis=0), at.ahead @ sums, [tokens.sum(), tokens @ at.pulled**2, -(tokens * at.pulled) @ at.moved]])
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["sums"])

    return expected


@dataclass
class Fit:
    """The steps from which every rate follows, and the relative errors of the domains that are left."""

    steps: list[Step]
    left: list[float]


def fitted(grouped: DataFrame, targets: list[float], volume: float, highest: float) -> Fit:
    """Descends over written cells until rates are within WITHIN of the best ones.

    ``volume`` is the total asked for, as a multiple of the tokens there are. The pull
    makes the problem strongly convex: the rates' distance from the best ones, as a root
    mean square over tokens, is at most the last step's length over PULL. Momentum starts
    anew where a step turned against the movement before; that is seen a round later.
    """
    width, steps, weight = len(targets), [], 1.0
    while True:
        partial = grouped.mapInArrow(_expected(steps, highest, width), "sums array<double>").collect()
        sums = np.sum([r["sums"] for r in partial], axis=0) if partial else np.zeros(2 * width + 3)
        plain, tokens, (n, length, turned) = sums[:width], sums[width : 2 * width], sums[2 * width :]
        present = np.maximum(plain, 1e-6 * plain.sum()) + 1e-12
        errors = (tokens - np.array(targets) * volume * plain.sum()) / present
        if not n or steps and np.sqrt(length / n) <= WITHIN * PULL:
            return Fit(steps, errors.tolist())
        grown = 1.0 if turned > 0 else (1 + np.sqrt(1 + 4 * weight * weight)) / 2
        steps.append(Step(errors, (weight - 1) / grown if grown > 1 else 0.0))
        weight = grown


def _rate(fit: Fit, highest: float, width: int):
    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, at = np.unique(np.rint(_matrix(batch.column("posterior"), width) * GRID), axis=0, return_inverse=True)
            rates = replay(own / GRID, fit.steps, highest).rates[at.ravel()] if batch.num_rows else np.zeros(0)
            left = pa.array([fit.left] * batch.num_rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates), left], [*batch.schema.names, "rate", "left"])

    return rate


def mixed_rates(
    docs: DataFrame, labels: DataFrame, label: Column, targets: dict[str, float], volume: float = 1.0, highest: float = 8.0, carried: Sequence[str] = ()
) -> DataFrame:
    """``doc_id``, the columns ``carried``, ``n_tokens``, ``posterior``, ``rate`` and ``left`` of each document.

    Posteriors and the relative errors ``left``, the same in every row, are in the order of ``targets``.
    """
    scored = written(posteriors(docs, labels, label, list(targets), carried=carried))
    fit = fitted(written(cells(scored, len(targets))), list(targets.values()), volume, highest)
    added = [StructField("rate", DoubleType()), StructField("left", ArrayType(DoubleType()))]
    return scored.mapInArrow(_rate(fit, highest, len(targets)), StructType([*scored.schema.fields, *added]))
