"""Learning byte-pair merges from corpus-wide word counts.

Inside the training loop a token is a single character (its id shifted into a free
range), so a word is a short string, a pair is two characters, a merge is
``replace`` and string order is id order.

One round of the loop, all of it exact:

1. count the pairs of all words and take the first ``width`` in merge order (count,
   then ids); the next one is the bound;
2. cut every word wherever a pair outside that set stands, and count the distinct
   pieces that are left. A pair that comes before the bound can only lie, or come to
   lie, inside a piece: a merge makes pairs that are no more frequent than the ones
   they are made of and have higher ids;
3. pick merges on the pieces while the best pair comes before the bound;
4. rewrite the words with the picked merges and drop those that are one token.

Steps 1, 2 and 4 run on the whole word table in Spark. Only the pairs of step 1
and the pieces of step 2 reach the driver: they are asked for with a limit and,
when there are more, the set of pairs is halved. A set of one pair needs no pieces.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import SPECIAL_TOKENS, byte_symbols
from millrace.operators.words import alphabet
from millrace.session import cut_lineage

VOCAB_SCHEMA = "id INT, token STRING, special BOOLEAN"
MERGES_SCHEMA = "rank INT, left STRING, right STRING"

# Characters below this one stay free for separators.
FIRST_CHARACTER = 0x100
MAX_VOCABULARY = 0x110000 - 0x800 - FIRST_CHARACTER

# Bounds on what one round may bring to the driver.
MAX_PIECES = 120_000
MAX_PIECE_LENGTH = 2_000
# Bits of a character, and the pairs a task adds up before it hands them on.
CHARACTER_BITS = 21
HELD_PAIRS = 1_000_000
ROUNDS_PER_CHECKPOINT = 4
WORDS_PER_TASK = 250_000


class Vocabulary(NamedTuple):
    """``vocab(id, token, special)`` and ``merges(rank, left, right)``."""

    vocab: DataFrame
    merges: DataFrame


def token_character(token_id: int) -> str:
    """The character that stands for a token id, leaving out surrogates."""
    code = token_id + FIRST_CHARACTER
    return chr(code if code < 0xD800 else code + 0x800)


def train_bpe(
    counts: DataFrame,
    vocab_size: int = 6400,
    min_frequency: int = 2,
    specials: Sequence[str] = SPECIAL_TOKENS,
    width: int = 2048,
) -> Vocabulary:
    """Learn a vocabulary from ``(word, n)``.

    The pair with the highest count is merged first; ties go to the smaller left
    id, then to the smaller right id. ``width`` bounds how many pairs a round looks
    at; rounds start with fewer and grow while their pieces stay few. It steers how
    many merges one round finds, not which.
    """
    if vocab_size > MAX_VOCABULARY:
        raise ValueError(f"vocab_size must not exceed {MAX_VOCABULARY}")
    counts = cut_lineage(counts.select("word", "n"))
    cores = counts.sparkSession.sparkContext.defaultParallelism
    partitions = max(cores, counts.count() // WORDS_PER_TASK)
    letters = sorted(row.symbol for row in alphabet(counts).collect())
    tokens = _Tokens([*specials, *letters])
    words = counts.repartition(partitions).select(
        F.translate(
            byte_symbols(F.col("word")),
            "".join(letters),
            "".join(tokens.character[letter] for letter in letters),
        ).alias("symbols"),
        F.coalesce(F.col("n").cast("long"), F.lit(0)).alias("n"),
    )
    words = words.filter(F.length("symbols") > 1).persist(StorageLevel.MEMORY_AND_DISK)
    merges: list[tuple[str, str]] = []
    rounds, reach, previous = 0, min(width, 64), None
    while len(tokens) < vocab_size:
        found = _pick_merges(words, tokens, vocab_size, min_frequency, reach)
        if previous is not None:
            previous.unpersist()
        if not found.picked:
            break
        merges += [(tokens.token[pair[0]], tokens.token[pair[1]]) for pair, _ in found.picked]
        rounds += 1
        reach = min((4 if 8 * found.n_pieces < MAX_PIECES else 2) * len(found.pairs), width)
        previous = words
        words = _rewrite(words, found).filter(F.length("symbols") > 1)
        if rounds % ROUNDS_PER_CHECKPOINT == 0:
            words = cut_lineage(words)
        words = words.persist(StorageLevel.MEMORY_AND_DISK)
    if previous is not None:
        previous.unpersist()
    words.unpersist()
    spark = counts.sparkSession
    vocab = [(i, t, i < len(specials)) for i, t in enumerate(tokens.names)]
    ranked = [(rank, left, right) for rank, (left, right) in enumerate(merges)]
    return Vocabulary(
        spark.createDataFrame(vocab, VOCAB_SCHEMA), spark.createDataFrame(ranked, MERGES_SCHEMA)
    )


def build_vocab(specials: Sequence[str], letters: DataFrame, merges: DataFrame) -> DataFrame:
    """Number special tokens, then symbols in order, then merges by rank.

    A merge that spells a token which is there already adds no id. The window has
    no partition on purpose: the table is no longer than the vocabulary.
    """
    spark = merges.sparkSession
    rows = [(0, i, token, True) for i, token in enumerate(specials)]
    reserved = spark.createDataFrame(rows, "part INT, place INT, token STRING, special BOOLEAN")
    symbols = letters.select(
        F.lit(1).alias("part"), F.lit(0).alias("place"), F.col("symbol").alias("token"),
        F.lit(False).alias("special"),
    )
    merged = merges.select(
        F.lit(2).alias("part"), F.col("rank").alias("place"),
        F.concat("left", "right").alias("token"), F.lit(False).alias("special"),
    )
    first = (
        reserved.union(symbols).union(merged)
        .groupBy("token")
        .agg(F.min(F.struct("part", "place", "special")).alias("first"))
    )
    order = Window.orderBy("first.part", "first.place", "token")
    return first.select(
        (F.row_number().over(order) - 1).alias("id"), "token", F.col("first.special").alias("special")
    )


def vocab_size(vocab: DataFrame) -> DataFrame:
    """The number of tokens, as a table of one row."""
    return vocab.agg(F.count(F.lit(1)).alias("vocab_size"))


class _Tokens:
    """The tokens so far, each with the character that stands for it."""

    def __init__(self, names: Iterable[str]) -> None:
        self.names: list[str] = []
        self.character: dict[str, str] = {}
        self.token: dict[str, str] = {}
        for name in names:
            self.add(name)

    def __len__(self) -> int:
        return len(self.names)

    def add(self, name: str) -> tuple[str, bool]:
        """The character of ``name`` and whether the token is new."""
        if name in self.character:
            return self.character[name], False
        character = token_character(len(self.names))
        self.names.append(name)
        self.character[name] = character
        self.token[character] = name
        return character, True


def _pair_keys(symbols: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words in a row, where each word ends, and the pair that begins at each code point.

    A pair is one number, in the order of its two characters; -1 stands at the last character of a word.
    """
    codes = np.frombuffer("".join(symbols.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    ends = np.cumsum(pc.utf8_length(symbols).to_numpy(), dtype=np.int64)
    pairs = np.full(len(codes), -1)
    pairs[:-1] = codes[:-1] << CHARACTER_BITS | codes[1:]
    pairs[ends - 1] = -1
    return codes, ends, pairs


def _pair_text(key: int) -> str:
    return chr(key >> CHARACTER_BITS) + chr(key & (1 << CHARACTER_BITS) - 1)


def _pair_key(pair: str) -> int:
    return ord(pair[0]) << CHARACTER_BITS | ord(pair[1])


def _summed(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of ``n`` over each."""
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every = every[order]
    starts = np.flatnonzero(np.diff(every, prepend=-1))
    return every[starts], np.add.reduceat(np.concatenate(n)[order], starts) if len(starts) else every[starts]


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, sums, held = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends, pairs = _pair_keys(batch.column(0))
        n = np.repeat(batch.column(1).to_numpy(), np.diff(ends, prepend=0))
        there = pairs >= 0
        for held_list, part in zip((keys, sums), _summed([pairs[there]], [n[there]])):
            held_list.append(part)
        held += len(keys[-1])
        if held > HELD_PAIRS:
            distinct, totals = _summed(keys, sums)
            keys, sums, held = [distinct], [totals], len(distinct)
            if 2 * held > HELD_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(totals)], ["pair", "n"])
                keys, sums, held = [], [], 0
    if keys:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(keys, sums)], ["pair", "n"])


def _top_pairs(words: DataFrame, n: int) -> list[tuple[str, int]]:
    totals = words.mapInArrow(_count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    rows = totals.orderBy(F.desc("n"), "pair").limit(n).collect()
    return [(_pair_text(row.pair), row.n) for row in rows]


def _cut(symbols: pa.Array, known: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The pieces of all words in a row, the characters in each, and the first piece of each word.

    A piece ends where no pair of ``known``, which is sorted, leads on.
    """
    codes, ends, pairs = _pair_keys(symbols)
    held = known[np.minimum(np.searchsorted(known, pairs), len(known) - 1)] == pairs
    starts = np.flatnonzero(np.concatenate(([True], ~held[:-1])))
    widths = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    offsets = np.concatenate(([0], np.cumsum(widths)))[np.append(starts, len(codes))]
    data = codes.astype(np.uint32).tobytes().decode("utf-32-le").encode("utf-8")
    pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
    firsts = np.searchsorted(starts, np.concatenate(([0], ends[:-1])))
    return pieces, np.diff(starts, append=len(codes)), firsts


def _pieces(words: DataFrame, pairs: list[str]) -> list[tuple[str, int]] | None:
    """Distinct pieces held together by ``pairs``, or None if over the bounds."""
    known = np.array(sorted(map(_pair_key, pairs)))

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                pieces, sizes, firsts = _cut(batch.column(0), known)
                n = np.repeat(batch.column(1).to_numpy(), np.diff(firsts, append=len(pieces)))
                long = pa.table({"piece": pieces, "n": pa.array(n)}).filter(pa.array(sizes > 1))
                sums = long.group_by("piece", use_threads=False).aggregate([("n", "sum")])
                yield from sums.rename_columns(["piece", "n"]).combine_chunks().to_batches()

    pieces = (
        words.mapInArrow(cut_batches, "piece string, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .withColumn("piece", F.when(F.length("piece") <= MAX_PIECE_LENGTH, F.col("piece")))
    )
    rows = pieces.limit(MAX_PIECES + 1).collect()
    if len(rows) > MAX_PIECES or any(row.piece is None for row in rows):
        return None
    return [(row.piece, row.n) for row in rows]


class _Round(NamedTuple):
    """Merges as ``(pair, character of the merged token)``, and what they make of the words.

    ``pairs`` hold the pieces together and ``changed`` says what becomes of a piece.
    """

    picked: list[tuple[str, str]]
    pairs: list[str]
    changed: dict[str, str]
    n_pieces: int


def _pick_merges(words: DataFrame, tokens: _Tokens, vocab_size: int, min_frequency: int, width: int) -> _Round:
    """The next merges."""
    top = _top_pairs(words, width + 1)
    if not top or top[0][1] < max(min_frequency, 1):
        return _Round([], [], {}, 0)
    while True:
        pairs = [pair for pair, _ in top[:width]]
        if len(pairs) == 1:
            pair = pairs[0]
            merged, _ = tokens.add(tokens.token[pair[0]] + tokens.token[pair[1]])
            return _Round([(pair, merged)], pairs, {}, 1)
        pieces = _pieces(words, pairs)
        if pieces is not None:
            bound = top[width] if len(top) > width else None
            picked, texts = _replay(pieces, tokens, vocab_size, min_frequency, bound)
            changed = {old: new for (old, _), new in zip(pieces, texts) if old != new}
            return _Round(picked, pairs, changed, len(pieces))
        width = len(pairs) // 2


def _replay(
    pieces: list[tuple[str, int]],
    tokens: _Tokens,
    vocab_size: int,
    min_frequency: int,
    bound: tuple[str, int] | None,
) -> tuple[list[tuple[str, str]], list[str]]:
    """Merge the best pair of the pieces while it comes before ``bound``: the merges, and what is left of the pieces."""
    texts = [text for text, _ in pieces]
    totals: Counter[str] = Counter()
    holders: defaultdict[str, set[int]] = defaultdict(set)
    for i, (text, n) in enumerate(pieces):
        for a, b in zip(text, text[1:]):
            totals[a + b] += n
            holders[a + b].add(i)
    queue = [(-n, pair) for pair, n in totals.items()]
    heapq.heapify(queue)
    picked: list[tuple[str, str]] = []
    while queue and len(tokens) < vocab_size:
        n, pair = heapq.heappop(queue)
        if -n != totals[pair]:
            continue
        if -n < max(min_frequency, 1) or (bound and (n, pair) >= (-bound[1], bound[0])):
            break
        name = tokens.token[pair[0]] + tokens.token[pair[1]]
        if name in tokens.character and picked:
            # A second spelling of a token: leave it to a round of its own.
            break
        merged, new = tokens.add(name)
        picked.append((pair, merged))
        changed = set()
        for i in holders.pop(pair):
            before, weight = texts[i], pieces[i][1]
            after = texts[i] = before.replace(pair, merged)
            for a, b in zip(before, before[1:]):
                totals[a + b] -= weight
                changed.add(a + b)
            for a, b in zip(after, after[1:]):
                totals[a + b] += weight
                holders[a + b].add(i)
                changed.add(a + b)
        if not new:
            break
        for other in changed:
            if totals[other] > 0:
                heapq.heappush(queue, (-totals[other], other))
    return picked, texts


def _rewrite(words: DataFrame, found: _Round) -> DataFrame:
    """Apply the merges of a round to every word, in Arrow batches.

    No merge reaches over the end of a piece, so a word is what its pieces become.
    """
    if not found.changed:
        (pair, merged), = found.picked
        return words.withColumn("symbols", F.replace("symbols", F.lit(pair), F.lit(merged)))
    known = np.array(sorted(map(_pair_key, found.pairs)))
    old, new = pa.array(found.changed.keys(), pa.string()), pa.array(found.changed.values(), pa.string())

    def rewrite_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                pieces, _, firsts = _cut(batch.column(0), known)
                at = pc.index_in(pieces, value_set=old)
                pieces = pa.concat_arrays([pc.coalesce(new.take(at), pieces)])
                bounds = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset :][np.append(firsts, len(pieces))]
                symbols = pa.StringArray.from_buffers(len(firsts), pa.py_buffer(bounds), pieces.buffers()[2])
                yield pa.RecordBatch.from_arrays([symbols, batch.column(1)], ["symbols", "n"])

    return words.mapInArrow(rewrite_batches, words.schema)
