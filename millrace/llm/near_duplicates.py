"""Near duplicates: MinHash with tensored banding, links confirmed on whole shingle sets.

A document has two small collections of half keys, each hashed from a few minimum
hashes. A table key joins one half key of the first collection with one of the
second, so ``m`` half keys on each side give ``m * m`` tables from ``2 * m * half``
minimum hashes; plain banding would need ``2 * half`` for each table, ``m * m *
2 * half``. A pair becomes a candidate where a half key of each side agrees.

Equal sets are grouped first and only one of them, the class representative with
the smallest doc_id, goes on. In a bucket each member is compared with its first
member only. Where that leaves members of a bucket in different components, those
documents are compared across components, block by block inside tasks, for links
the first comparison could not see; no bucket is cut or expanded into rows of pairs.

Nulls and edges: a text without words, or a null one, has an empty set and is
linked with nothing. Rows without doc_id can't be named as a component: their
component is null and they are kept. Rows that repeat a doc_id are one node with
the links of all its texts; each gives one row. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import REMEMBERED, mixed, slices, written
from millrace.llm.graph import components

#: The chance that a pair just at the threshold agrees in no half key of one side.
MISS = 2e-5
#: Documents of a half key that a task compares with as many others, and shingles at once.
BLOCK = 512
COLUMNS = 4096


@dataclass(frozen=True)
class Banding:
    """Words of a shingle, least similarity in hundredths, minimum hashes of a half key."""

    words: int = 3
    percent: int = 85
    half: int = 3

    def side(self) -> int:
        """Half keys on each side: as few as keep misses below MISS."""
        return math.ceil(math.log(MISS) / math.log(1 - (self.percent / 100) ** self.half))

    def alike(self, common: Column, first: Column, second: Column) -> Column:
        return 100 * common >= self.percent * (first + second - common)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _shingles(words: list[bytes], hashes: _WordHashes, size: int) -> np.ndarray:
    """Hashes of the distinct shingles, in order."""
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - size + 1)
    total = np.full(n, min(len(w), size), np.uint64)
    for k in range(min(size, len(w))):
        total = mixed(total + w[k : k + n])
    return np.unique(total)


def _sets_of(texts: list[bytes], hashes: _WordHashes, size: int) -> list[np.ndarray]:
    if len(hashes) > REMEMBERED:
        hashes.clear()
    return [_shingles(text.lower().split(), hashes, size) for text in texts]


def _sign(banding: Banding):
    side, half = banding.side(), banding.half
    drawn = np.random.default_rng(7).integers(0, 1 << 63, (2, 2 * side * half), np.uint64)
    factors, shifts = drawn[0] * np.uint64(2) + np.uint64(1), drawn[1]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for part, texts in slices(batch, "text"):
                sets = _sets_of(texts, hashes, banding.words)
                sizes = np.array([len(s) for s in sets])
                filled = np.flatnonzero(sizes)
                keys = np.zeros((len(filled), 2 * side), np.int64)
                ids = np.zeros((len(sets), 2), np.int64)
                if len(filled):
                    every = np.concatenate([sets[k] for k in filled])
                    starts = np.cumsum(sizes[filled]) - sizes[filled]
                    for k in range(2 * side):
                        key = np.full(len(filled), k, np.uint64)
                        for j in range(k * half, (k + 1) * half):
                            key = mixed(key + np.minimum.reduceat(every * factors[j] + shifts[j], starts))
                        keys[:, k] = key.view(np.int64)
                    for j in range(2):
                        ids[filled, j] = np.add.reduceat(mixed(every + shifts[j]), starts).view(np.int64)
                offsets = np.zeros(len(sets) + 1, np.int32)
                offsets[1:] = np.cumsum((sizes > 0) * side)
                halves = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[:, s : s + side].ravel())) for s in (0, side)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids[:, 0]), pa.array(ids[:, 1]), *halves],
                    ["doc_id", "n_shingles", "id1", "id2", "first", "second"],
                )

    return sign


def _list_sets(size: int):
    def list_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for part, texts in slices(batch, "text"):
                sets = _sets_of(texts, hashes, size)
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["id", "set"])

    return list_sets


def _shared_halves(signed: DataFrame) -> DataFrame:
    """``id, first, second``: of each class representative, the half keys that others have too, as ``at, half`` of a side.

    Only those can make a table key that two documents share, and most documents have
    none, so far fewer table keys than ``m * m`` a document are made.
    """
    representative = signed.filter("n_shingles > 0 and doc_id is not null").groupBy("id1", "id2").agg(F.min(F.struct("doc_id", "first", "second")).alias("r"))
    first = F.transform("r.first", lambda x, i: F.struct(F.lit(True).alias("is_first"), i.alias("at"), x.alias("half")))
    second = F.transform("r.second", lambda x, i: F.struct(F.lit(False).alias("is_first"), i.alias("at"), x.alias("half")))
    halves = representative.select(F.col("r.doc_id").alias("id"), F.inline(F.concat(first, second)))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    of = F.struct("at", "half")
    return halves.join(shared, "half", "left_semi").groupBy("id").agg(F.collect_list(F.when(F.col("is_first"), of)).alias("first"), F.collect_list(F.when(~F.col("is_first"), of)).alias("second"))


def _collisions(signed: DataFrame) -> DataFrame:
    """``key, id, lead, n`` of every table bucket with two members or more."""
    keys = F.flatten(F.transform("first", lambda x: F.transform("second", lambda y: F.xxhash64(x["at"], y["at"], x["half"], y["half"]))))
    members = _shared_halves(signed).select("id", F.explode(keys).alias("key"))
    bucket = Window.partitionBy("key")
    return members.select("key", "id", F.min("id").over(bucket).alias("lead"), F.count("*").over(bucket).alias("n")).filter("n > 1")


def _confirmed(pairs: DataFrame, sets: DataFrame, banding: Banding) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike."""
    a, b = (sets.select(F.col("id").alias(k), F.col("set").alias(f"{k}_set")) for k in "ab")
    common = F.size(F.array_intersect("a_set", "b_set"))
    return pairs.join(a, "a").join(b, "b").filter(banding.alike(common, F.size("a_set"), F.size("b_set"))).select("a", "b")


def _compare(percent: int):
    """Pairs of a group's documents, across parts, whose sets are about as alike as asked.

    The group is one block of a half key's documents or two; of two only pairs across
    them count. Common shingles are counted by products of 0/1 matrices.
    """

    def compare(group: pa.Table) -> pa.Table:
        ids, parts, n, block = (group.column(c).to_numpy() for c in ("id", "part", "n", "block"))
        lists = group.column("tokens").combine_chunks()
        tokens = lists.flatten().to_numpy()
        of = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
        _, token, times = np.unique(tokens, return_inverse=True, return_counts=True)
        shared = times[token] > 1
        of, token = of[shared], token[shared]
        order = np.argsort(token, kind="stable")
        of, token = of[order], np.unique(token[order], return_inverse=True)[1]
        left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        common = np.zeros((len(left), len(right)), np.float32)
        for first in range(0, int(token[-1]) + 1 if len(token) else 0, COLUMNS):
            some = slice(*np.searchsorted(token, [first, first + COLUMNS]))
            ones = np.zeros((len(ids), COLUMNS), np.float32)
            ones[of[some], token[some] - first] = 1
            common += ones[left] @ ones[right].T
        union = n[left][:, None] + n[right][None, :] - common
        near = (100 * common >= percent * union) & (parts[left][:, None] != parts[right][None, :])
        a, b = (ids[side[at]] for side, at in zip((left, right), np.nonzero(near), strict=True))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return compare


def _unseen_pairs(signed: DataFrame, collisions: DataFrame, parts: DataFrame, sets: DataFrame, banding: Banding) -> DataFrame:
    """Pairs across components, of documents in buckets that the first links left apart.

    Those documents meet by the half keys of one side, of which a pair as alike as asked
    misses all with probability MISS. The documents of a half key are dealt into blocks,
    and tasks compare block with block; only pairs near the threshold leave a task.
    """
    held = collisions.filter("n > 2").select("key", "id").join(parts, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("component", "id").alias("part"))
    apart = held.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("key")
    documents = held.join(apart, "key", "left_semi").select("id", "part").distinct()
    halves = signed.select(F.col("doc_id").alias("id"), "first")
    keyed = written(documents.join(halves, "id").select("id", "part", F.posexplode("first").alias("side", "half")).distinct())
    hosts = keyed.groupBy("side", "half").agg(F.count("*").alias("m"), F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("id"), blocks).cast("int")
    dealt = keyed.join(hosts, ["side", "half"]).withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    grouped = dealt.select("side", "half", "id", "part", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    tokens = sets.select("id", F.size("set").alias("n"), F.transform("set", lambda x: (x % (1 << 31)).cast("int")).alias("tokens"))
    return grouped.join(tokens, "id").groupBy("side", "half", "lo", "hi").applyInArrow(_compare(banding.percent - 1), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each document (columns doc_id, text)."""
    schema = "doc_id long, n_shingles long, id1 long, id2 long, first array<long>, second array<long>"
    signed = written(docs.select("doc_id", "text").mapInArrow(_sign(banding), schema))
    copies = signed.filter("n_shingles > 0 and doc_id is not null").select("doc_id", "id1", "id2")
    first = copies.groupBy("id1", "id2").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("other")).filter("b < other")
    equal = copies.join(first, ["id1", "id2"]).filter("doc_id != b").select(F.col("doc_id").alias("a"), "b")

    collisions = written(_collisions(signed))
    wanted = collisions.select(F.col("id").alias("doc_id")).distinct()
    sets = written(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi").mapInArrow(_list_sets(banding.words), "id long, set array<long>"))
    pairs = collisions.filter("id != lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = written(_confirmed(pairs, sets, banding).union(equal).distinct())
    parts = components(links)
    unseen = written(_confirmed(_unseen_pairs(signed, collisions, parts, sets, banding), sets, banding))
    if not unseen.isEmpty():
        parts = components(links.union(unseen))
    found = signed.select("doc_id", "n_shingles").join(parts, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("component", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
