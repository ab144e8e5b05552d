"""Packing of token pieces into sequences by the sum-of-squares rule.

A piece goes where the sum, over all residual gaps, of the squared number of open
sequences with that gap becomes smallest; opening a sequence is one of the choices.
The rule keeps gaps spread out, so that pieces still to come find one that fits.
Larger pieces come first, in an order that doesn't depend on their length; the
smallest three tenths follow, largest first, and open a sequence only where no gap
holds them. They fill what is left: a group ends within a sequence or two of the
least number.

Pieces are dealt in turn to groups of about GROUP pieces, each packed by one task on
its own; a group leaves a handful of sequences unfilled, so groups cost next to
nothing in sequences and bound what a task holds.

Nulls and edges: a null text is empty; an empty document is its closing id alone.
Repeated rows, and rows with a null or a repeated doc_id, are packed one by one.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.common import mixed, slices, written

LENGTH = 4096
END_ID = 1
GROUP = 131_072
#: The share of pieces, the smallest ones, that fill gaps at the end.
FILLERS = 0.3
#: Encoded words that a task remembers before it starts anew.
REMEMBERED_IDS = 700_000

# Characters that the vocabulary's normaliser only lower-cases, and its word pattern for them.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class _Symbols(dict):
    """The character that stands for each byte: itself if printable, else the next free one."""

    def __init__(self) -> None:
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        super().__init__({b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)})


class _Encoded(dict):
    """Ids (little-endian, four bytes each) of every word seen; a word is a run without ASCII white space.

    Words of plain characters are lower-cased and cut here and their parts given to the
    tokenizer's model; all others go through the whole tokenizer. White space never
    joins with anything in this vocabulary, so words can be encoded one by one.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.symbols = _Symbols()
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.symbols)
        ids = self.parts[part] = np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()
        return ids

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and "<|" not in text:
            ids = b"".join([self.parts.get(p) or self._part(p) for p in _PARTS.findall(text.lower())])
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids

    def of(self, text: bytes) -> bytes:
        if len(self) > REMEMBERED_IDS:
            self.forget()
        return b"".join(map(self.__getitem__, text.split()))

    def forget(self) -> None:
        self.clear()
        self.parts.clear()


#: By path; a worker process keeps the tokenizer from task to task, but no words: other stages' tasks run in it too.
_WORKER: dict[str, _Encoded] = {}


def encoded(path: str) -> _Encoded:
    if path not in _WORKER:
        _WORKER[path] = _Encoded(path)
    return _WORKER[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoded(path)
        end = np.array([END_ID], "<u4").tobytes()
        try:
            for batch in batches:
                for part, texts in slices(batch, "text"):
                    rows = []
                    for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                        ids = words.of(text) + end
                        for k, at in enumerate(range(0, len(ids), 4 * length)):
                            piece = ids[at : at + 4 * length]
                            rows.append((doc_id, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
                    columns = [pa.array(c, pa.int32() if k == 1 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])
        finally:
            words.forget()

    return cut


def token_pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """Every document's ids with a closing id, in pieces of at most ``length``."""
    return docs.select("doc_id", "text").mapInArrow(_cut(tokenizer_path, length), PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int, fill_from: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item, placed in the order given.

    Of equally good places the smallest gap wins; a new sequence is opened only where
    that is better than every gap there is, and from item ``fill_from`` on only where
    no gap is large enough.
    """
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    counts = np.zeros(capacity + 1, np.int64)
    gaps: list[int] = []
    sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, size in enumerate(lengths.tolist()):
        best, gain = capacity, 2 * counts[capacity - size] + (size < capacity)
        if size < capacity:
            # Leaving gap g and making gap g - size changes the sum by 2 * (count there - count here) + 2.
            there, here = counts[: capacity - size], counts[size:capacity]
            change = 2 * (there - here) + 2
            change[0] -= 1
            change[here == 0] = 1 << 40
            g = int(change.argmin())
            if change[g] <= gain or (k >= fill_from and here[g]):
                best = g + size
        if best == capacity:
            number = len(gaps)
            gaps.append(capacity)
        else:
            number = open_by_gap[best].pop()
            counts[best] -= 1
        sequences[k], offsets[k] = number, capacity - gaps[number]
        gaps[number] -= size
        if gaps[number]:
            open_by_gap[gaps[number]].append(number)
            counts[gaps[number]] += 1
    return sequences, offsets


def _pack(capacity: int):
    def pack(pieces: pa.Table) -> pa.Table:
        lengths = pieces.column("length").to_numpy()
        shuffled = np.argsort(mixed(pieces.column("row").to_numpy()))
        small = lengths[shuffled] < np.quantile(lengths, FILLERS)
        fillers = shuffled[small][np.argsort(-lengths[shuffled[small]], kind="stable")]
        order = np.concatenate([shuffled[~small], fillers])
        sequences, offsets = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        sequences[order], offsets[order] = sum_of_squares(lengths[order], capacity, len(order) - len(fillers))
        numbers = (pieces.column("group").to_numpy() << 32) + sequences
        return pieces.drop_columns(["row", "group"]).append_column("sequence_id", pa.array(numbers)).append_column("offset", pa.array(offsets))

    return pack


def packed(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """The pieces of ``token_pieces`` with ``sequence_id`` and ``offset``."""
    pieces = written(token_pieces(docs, tokenizer_path, length))
    groups = max(1, -(-pieces.count() // GROUP))
    # Numbers follow the written files, so a task that runs again deals the same way.
    numbered = pieces.withColumn("row", F.monotonically_increasing_id())
    dealt = numbered.withColumn("group", F.col("row").bitwiseAND((1 << 33) - 1) % groups)
    return dealt.groupBy("group").applyInArrow(_pack(length), PIECES + ", sequence_id long, offset long")
