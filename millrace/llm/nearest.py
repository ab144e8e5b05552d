"""Nearest neighbours by inner product: collision-counting hashing with query-centred windows.

A vector's direction is projected on random lines; each line of a block is a sorted
array. Around a query's own projection a window opens in every array, and widens by
virtual rehashing: a radius that grows by a fixed factor stands for a coarser hash
without hashing anew, until the windows hold a set share of all entries. Their sizes
follow from the windows' ends alone; entries are then counted from the outside, which
by then is the smaller part.

The share of arrays in which a vector collides tells its angle to the query, so a
vector's collision threshold falls with its length: of each block, a set share and some
more for each neighbour asked for, those whose length times the cosine so told is
largest, have passed it. These are verified by their exact inner product.

Vectors are dealt into blocks of about BLOCK, queries into chunks of about CHUNK; a
task indexes a block and asks it a chunk, so no task holds more than that. Every
block answers every query and the best answers are ranked over blocks.

Edges: vectors that are null, zero, or hold a null or non-finite component take no
part, nor do rows without vec_id. Rows that repeat a vec_id are one vector, the
smallest of them. Vectors of different lengths are never compared. A query with fewer
candidates than asked for gets all of them. Other columns are not read.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 128
#: The share of all entries that the last windows hold, and of a block that is verified.
INSIDE = 0.85
VERIFIED = 0.12
#: How many more are verified for each neighbour asked for.
SPARE = 10
#: The first radius, of directions one unit long, and by how much it grows.
RADIUS = 0.25
GROWTH = 1.2
BLOCK = 16_384
CHUNK = 4_096

ANSWERS = "query_id long, vec_id long, score double"


def _unit(directions: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng(11).standard_normal((dimensions, directions))


class CollisionIndex:
    """The sorted projections of the directions of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        # By the largest component first, so that no square overflows or vanishes.
        largest = np.abs(vectors).max(axis=1)
        scaled = vectors / largest[:, None]
        rest = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
        self.ids, self.vectors, self.lengths = ids, vectors, largest * rest
        self.lines = _unit(PROJECTIONS, vectors.shape[1])
        projected = (scaled / rest[:, None]) @ self.lines
        order = np.argsort(projected, axis=0, kind="stable")
        self.rows = order.T.astype(np.int32).ravel()
        # The arrays lie behind each other, shifted apart, so that one search finds all windows' ends.
        self.lowest, self.highest = float(projected.min()), float(projected.max())
        self.shifts = np.arange(PROJECTIONS) * (self.highest - self.lowest + 1.0)
        self.sorted = (np.take_along_axis(projected, order, axis=0).T + self.shifts[:, None]).ravel()

    def collisions(self, query: np.ndarray) -> tuple[np.ndarray, float]:
        """In how many arrays each row lies in the last window, and that window's radius."""
        scaled = query / np.abs(query).max()
        centre = (scaled / np.sqrt(scaled @ scaled)) @ self.lines
        n, radius = len(self.ids), RADIUS
        while True:
            low = self.sorted.searchsorted(np.clip(centre - radius, self.lowest, self.highest + 0.5) + self.shifts)
            high = self.sorted.searchsorted(np.clip(centre + radius, self.lowest - 0.5, self.highest) + self.shifts, "right")
            if (high - low).sum() >= INSIDE * n * PROJECTIONS:
                break
            radius *= GROWTH
        # What lies between one array's window and the next one's.
        ends = zip([0, *high.tolist()], [*low.tolist(), len(self.rows)], strict=True)
        outside = np.bincount(np.concatenate([self.rows[i:j] for i, j in ends]), minlength=n)
        return PROJECTIONS - outside, radius

    def candidates(self, query: np.ndarray, least: int) -> np.ndarray:
        """The ``least`` rows that passed their thresholds by most; ties to earlier rows."""
        if least >= len(self.ids):
            return np.arange(len(self.ids))
        counts, radius = self.collisions(query)
        told = self.lengths * _cosines(radius)[counts]
        passed = np.partition(told, -least)[-least]
        above = np.flatnonzero(told > passed)
        return np.concatenate([above, np.flatnonzero(told == passed)[: least - len(above)]])

    def nearest(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the best found, in double precision, ties to smaller ids."""
        rows = self.candidates(query, verified(len(self.ids), k))
        rows = rows[self.ids[rows] != query_id]
        scores = np.einsum("ij,j->i", self.vectors.take(rows, axis=0), query)
        if len(rows) > k:
            fit = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
            rows, scores = rows[fit], scores[fit]
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[best]], scores[best]


def verified(n: int, k: int) -> int:
    """How many of a block of n vectors are verified for k neighbours."""
    return min(n, 1 + SPARE * k + math.ceil(VERIFIED * n))


@lru_cache(maxsize=256)
def _cosines(radius: float) -> np.ndarray:
    """The cosine that each number of collisions tells: projections of two directions differ normally, by their distance."""
    share = (np.arange(PROJECTIONS + 1) + 0.5) / (PROJECTIONS + 1)
    distances = [radius / NormalDist().inv_cdf((1 + p) / 2) for p in share]
    return 1 - np.square(distances) / 2


def _ask(k: int):
    def vectors_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids, lists = table.column("vec_id").to_numpy(), table.column("vector").combine_chunks()
        return ids, lists.flatten().to_numpy().reshape(len(ids), -1)

    def ask(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        if vectors.num_rows and queries.num_rows:
            index = CollisionIndex(*vectors_of(vectors))
            found = [(q, *index.nearest(q, v, k)) for q, v in zip(*vectors_of(queries), strict=True)]
        ids = [np.full(len(x), q, np.int64) for q, x, _ in found]
        columns = [np.concatenate(c) if found else [] for c in (ids, [x for _, x, _ in found], [x for *_, x in found])]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["query_id", "vec_id", "score"])

    return ask


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return finite & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each query (columns vec_id, embedding)."""
    whole = F.col("embedding").cast("array<double>").alias("vector")
    rows = vectors.select("vec_id", whole).filter(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    single = rows.groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("size", F.size("vector"))
    total = single.agg(F.count("*").alias("n"), F.sum(is_query.cast("int")).alias("q")).first()
    blocks, chunks = max(1, -(-total["n"] // block)), max(1, -(-(total["q"] or 0) // chunk))
    number = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    indexed = single.withColumn("block", number(blocks)).withColumn("chunk", every(chunks))
    asked = single.filter(is_query).withColumn("chunk", number(chunks)).withColumn("block", every(blocks))
    keys = ["size", "block", "chunk"]
    answers = indexed.groupBy(keys).cogroup(asked.groupBy(keys)).applyInArrow(_ask(k), ANSWERS)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
