"""Removal of repeated passages: windows of words that also start earlier, found by FM-indexes.

A window's anchor is the shortest-hashed run of ANCHOR words inside it, so equal
windows have equal anchors wherever they stand. Neighbouring windows with one anchor
form a segment. Of equal segments the first stands for all: in the others every
window starts earlier, in the first. First segments whose anchor no other segment has
can't hold a repeated window; the rest are dealt by anchor into shards.

Each shard indexes its segments in one compressed FM-index and streams them against
it: backward search gives, for every window end, its matching statistic. A
statistic of a whole window marks windows with equal words, and of those all but the
first occurrence are repeats. A shard is closed at about SHARD_WORDS words.

An anchor in more than BLOCK places, such as a passage in a third of all documents,
is dealt into blocks of about that size. A block knows only its own first occurrence
of a window; those are then compared across blocks by a hash of the window, one row
for each block at most.

Order and edges: documents are ordered by doc_id, a null one before all others. Rows
that repeat a doc_id are documents of their own under the same id; of equal windows
at the same doc_id and start none is earlier. A null text has no words. Every input
row gives one row. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import mixed, slices
from millrace.llm.fm_index import FMIndex

WINDOW = 20
ANCHOR = 6
SHARD_WORDS = 500_000
BLOCK = 50_000
FIRST_KEY = -(1 << 63)


# --- anchors --------------------------------------------------------------------


def segments(words: list[bytes], window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Hash of the anchor, hash of all words, first word and length of each segment of a document."""
    if len(words) < window:
        return (np.zeros(0, np.int64),) * 4
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(w) - anchor + 1
    grams = w[:n].copy()
    for k, power in enumerate(_powers(anchor)[1:], 1):
        grams += w[k : k + n] * power
    grams = mixed(grams)
    views = np.lib.stride_tricks.sliding_window_view(grams, window - anchor + 1)
    least = views.argmin(axis=1) + np.arange(len(views))
    starts = np.flatnonzero(np.diff(least, prepend=-1))
    lengths = np.diff(np.append(starts, len(least))) + window - 1
    # A segment is hashed by its anchor, its length, and a sum over its words that knows their places.
    places = np.concatenate([[0], np.cumsum(w * _powers(len(w)))]).astype(np.uint64)
    whole = (places[starts + lengths] - places[starts]) * _powers(len(w) + 1)[len(w) - starts]
    anchors = grams[least[starts]]
    return anchors.view(np.int64), mixed(whole + mixed(anchors + lengths.astype(np.uint64))).view(np.int64), starts, lengths


def _powers(n: int) -> np.ndarray:
    """An odd number to the powers 0 .. n - 1, modulo 2 ** 64."""
    global _POWERS
    if len(_POWERS) < n:
        factors = np.full(max(n, 4096), 0x9E3779B97F4A7C15, np.uint64)
        factors[0] = 1
        _POWERS = np.cumprod(factors)
    return _POWERS[:n]


_POWERS = np.zeros(0, np.uint64)


PLACES = "anchor long, segment long, key long, version int, start int, length int, later boolean"


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with their places.

    Of equal segments seen together only the first competes for being first of all;
    the others are ``later`` already and get an anchor of their own, which spreads them.
    """
    for batch in batches:
        for part, texts in slices(batch, "text"):
            found = [segments(text.split()) for text in texts]
            anchor, segment, start, length = (np.concatenate(c) for c in zip(*found, strict=True))
            times = [len(x[0]) for x in found]
            key, version = (np.repeat(part.column(c).to_numpy(), times) for c in ("key", "version"))
            order = np.lexsort((start, key, segment))
            again = np.diff(segment[order], prepend=segment[order[:1]] + 1 if len(order) else []) == 0
            same_place = (np.diff(key[order], prepend=0) == 0) & (np.diff(start[order], prepend=0) == 0)
            later = np.zeros(len(order), bool)
            later[order] = again & ~same_place
            anchor = np.where(later, mixed(key * 1_000_003 + start).view(np.int64), anchor)
            columns = [anchor, segment, key, version, start.astype(np.int32), length.astype(np.int32), later]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "segment", "key", "version", "start", "length", "later"])


# --- shards ---------------------------------------------------------------------

SEGMENTS = "anchor long, block int, blocks int, key long, version int, start int, words binary"


def _cut(block_size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows = []
                for key, version, text, own in zip(part.column("key").to_pylist(), part.column("version").to_pylist(), texts, part.column("segments").to_pylist(), strict=True):
                    words = text.split()
                    for s in own:
                        blocks = -(-s["n"] // block_size)
                        block = xxhash.xxh3_64_intdigest(f"{key}:{s['start']}") % blocks if blocks > 1 else 0
                        rows.append((s["anchor"], block, blocks, key, version, s["start"], b" ".join(words[s["start"] : s["start"] + s["length"]])))
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                columns = zip(*rows, strict=True) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["anchor", "block", "blocks", "key", "version", "start", "words"])

    return cut


REPEATS = "tie long, key long, version int, at int, until int, firm boolean"


def _spread(counts: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for each count n, one after another."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def shard_repeats(shard: pa.Table) -> pa.Table:
    """The repeated stretches of a shard, and the first windows of blocks (``firm`` false)."""
    texts, of_row = np.unique(np.array(shard.column("words").to_pylist(), object), return_inverse=True)
    key, version, start, blocks = (shard.column(c).to_numpy() for c in ("key", "version", "start", "blocks"))
    order = np.lexsort((start, key))
    first = np.full(len(texts), -1)
    first[of_row[order[::-1]]] = order[::-1]

    split = [t.split(b" ") for t in texts]
    numbers: dict[bytes, int] = {}
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    text = np.zeros(lengths.sum() + len(split), np.int32)
    begins = np.cumsum(lengths + 1) - lengths - 1
    text[np.repeat(begins, lengths) + _spread(lengths)] = [numbers.setdefault(w, len(numbers) + 1) for words in split for w in words]
    index = FMIndex(text, len(numbers) + 1, WINDOW)

    counts = lengths - WINDOW + 1
    of_text, offset = np.repeat(np.arange(len(texts)), counts), _spread(counts)
    matched, group = index.matching_statistics(text, begins[of_text] + offset + WINDOW, WINDOW)
    group = np.where(matched == WINDOW, group, len(text) + np.arange(len(group)))

    # The first place of each group of equal windows, over all rows that hold its segments.
    place_key, place_at = key[first[of_text]], start[first[of_text]] + offset
    by_place = np.lexsort((place_at, place_key, group))
    leads = by_place[np.flatnonzero(np.diff(group[by_place], prepend=-1))]
    _, lead_of = np.unique(group, return_inverse=True)
    lead_key, lead_at = place_key[leads][lead_of], place_at[leads][lead_of]

    row = np.repeat(np.arange(len(key)), counts[of_row])
    step = _spread(counts[of_row])
    window = (np.cumsum(counts) - counts)[of_row[row]] + step
    at = start[row] + step
    later = (key[row] > lead_key[window]) | ((key[row] == lead_key[window]) & (at > lead_at[window]))

    runs = later & ~np.concatenate([[False], (later[:-1] & (row[1:] == row[:-1]))])
    stops = later & ~np.concatenate([(later[1:] & (row[1:] == row[:-1])), [False]])
    a, z = np.flatnonzero(runs), np.flatnonzero(stops)
    kept = np.flatnonzero(~later & (blocks[row] > 1))
    ties = [xxhash.xxh3_64_intdigest(b" ".join(split[t][o : o + WINDOW]), 1) for t, o in zip(of_row[row[kept]].tolist(), step[kept].tolist(), strict=True)]
    alone = mixed(key[row[a]].astype(np.uint64) * np.uint64(31) + at[a].astype(np.uint64))
    rows = np.concatenate([row[a], row[kept]])
    return pa.table(
        {
            "tie": np.concatenate([alone, np.array(ties, np.uint64)]).view(np.int64),
            "key": key[rows],
            "version": version[rows],
            "at": np.concatenate([at[a], at[kept]]).astype(np.int32),
            "until": np.concatenate([at[z], at[kept]]).astype(np.int32) + np.int32(WINDOW),
            "firm": np.arange(len(rows)) < len(a),
        }
    )


def _firm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeats that a shard knows by itself."""
    for found in _shards(batches):
        yield found.filter(found.column("firm"))


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first windows of blocks, of anchors that have several."""
    several = (batch.filter(pc.greater(batch.column("blocks"), 1)) for batch in batches)
    for found in _shards(several):
        yield found.filter(pc.invert(found.column("firm")))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by anchor and block, which stay together."""
    held: list[pa.RecordBatch] = []
    words = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        words += batch.column("words").nbytes // 6
        if words < SHARD_WORDS:
            continue
        table = pa.Table.from_batches(held)
        anchor, block = table.column("anchor").to_numpy(), table.column("block").to_numpy()
        tail = np.flatnonzero((anchor != anchor[-1]) | (block != block[-1]))
        cut = int(tail[-1]) + 1 if len(tail) else 0
        if cut:
            yield from shard_repeats(table.slice(0, cut)).to_batches()
            held = table.slice(cut).combine_chunks().to_batches()
            words = sum(b.column("words").nbytes for b in held) // 6
    if held:
        yield from shard_repeats(pa.Table.from_batches(held)).to_batches()


# --- documents ------------------------------------------------------------------

CLEANED = "doc_id long, n_words long, n_removed long, kept string"


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch, "text"):
            totals, removed, kept = [], [], []
            for text, own, repeats in zip(texts, part.column("segments").to_pylist(), part.column("repeats").to_pylist(), strict=True):
                words = text.split()
                gone = np.zeros(len(words), bool)
                for x in own or ():
                    gone[x["start"] : x["start"] + x["length"]] = True
                for x in repeats or ():
                    gone[x["at"] : x["until"]] = True
                totals.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(compress(words, (~gone).tolist()) if removed[-1] else words))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )


def _segments(base: DataFrame) -> DataFrame:
    """``key, version, segments``: of each document the segments that come later than an
    equal one, and those to be looked up because another segment has the same anchor."""
    equal, anchored = Window.partitionBy("anchor", "segment"), Window.partitionBy("anchor")
    places = base.select("key", "version", "text").mapInArrow(_places, PLACES).repartition("anchor")
    judged = places.withColumns(
        {
            "later": F.col("later") | (F.struct("key", "start") > F.min(F.struct("key", "start")).over(equal)),
            "apart": F.min("segment").over(anchored) != F.max("segment").over(anchored),
            "n": F.count("*").over(anchored),
        }
    )
    return judged.filter("later or apart").groupBy("key", "version").agg(F.collect_list(F.struct("anchor", "start", "length", "n", "later")).alias("segments"))


def without_repeats(docs: DataFrame, block_size: int = BLOCK) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words left of each document, joined by one space."""
    base = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(FIRST_KEY)).alias("key"), F.hash("text").alias("version"))
    held = _segments(base)
    own = held.withColumn("segments", F.filter("segments", lambda s: ~s["later"])).filter(F.size("segments") > 0)
    gone = F.transform(F.filter("segments", lambda s: s["later"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    cut = base.join(own, ["key", "version"]).select("doc_id", "key", "version", "text", "segments").mapInArrow(_cut(block_size), SEGMENTS)
    dealt = cut.repartition("anchor", "block").sortWithinPartitions("anchor", "block")
    lead = F.min(F.struct("key", "at")).over(Window.partitionBy("tie"))
    across = dealt.mapInArrow(_open, REPEATS).withColumn("lead", lead).filter("struct(key, at) > lead").drop("lead")
    repeats = dealt.mapInArrow(_firm, REPEATS).union(across).groupBy("key", "version").agg(F.collect_list(F.struct("at", "until")).alias("repeats"))
    both = base.join(held.withColumn("segments", gone), ["key", "version"], "left").join(repeats, ["key", "version"], "left")
    return both.select("doc_id", "text", "segments", "repeats").mapInArrow(_clean, CLEANED)
