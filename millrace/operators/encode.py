"""Text to token ids and back."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.merge import Merges, merge_symbols
from millrace.functions.text import (
    BYTE_SYMBOLS,
    byte_symbols,
    required,
    split_words_and_specials,
)
from millrace.operators.bpe import MAX_VOCABULARY

# A vocabulary travels to the tasks whole; training can make none with more tokens.
MAX_SHARED_VOCABULARY = MAX_VOCABULARY
MAX_REMEMBERED_WORDS = 100_000
# Words, or ids, that a task looks at together; lists that have more are looked at one by one.
TOGETHER = 100_000
# Bytes of a word up to which words are merged many at once.
SHORT_WORD = 32
# Characters in which the first words of a text are looked for, to each.
CHARACTERS_PER_WORD = 8


def encode(
    df: DataFrame,
    key: str,
    text: str | Sequence[str],
    vocab: DataFrame,
    merges: DataFrame,
    max_length: int | None = None,
    prefix_space: bool = True,
) -> DataFrame:
    """``(key, ids)`` of every text; no row leaves its partition.

    Spark splits the texts into words; each task then encodes every distinct word
    it meets once and looks up the rest, on Arrow batches. The corpus is not
    shuffled, so neither a frequent word nor a long text makes a hot key. Bytes
    that the vocabulary lacks are dropped. Given several text columns, the result
    has an id list under each of their names.

    With ``max_length`` the lists hold the first so many ids of the texts. A text is
    then split and sent to Python only as far as its head, wherever the vocabulary has
    every byte of these words, so that each of them makes an id.
    """
    texts = [text] if isinstance(text, str) else list(text)
    names = ["key", "ids"] if isinstance(text, str) else ["key", *texts]
    ids, ranks, specials = _collect_vocabulary(vocab, merges)
    shared = df.sparkSession.sparkContext.broadcast((ids, ranks, frozenset(specials), Merges(ids, ranks, BYTE_SYMBOLS)))
    words = df.select(F.col(key).alias("key"), *[required(F.col(t), t).alias(n) for t, n in zip(texts, names[1:])])
    if max_length is None:
        words = words.select("key", *[split_words_and_specials(F.col(n), specials, prefix_space).alias(n) for n in names[1:]])
    else:
        words = _leading_words(words, names[1:], ids, specials, max_length, prefix_space)
    list_type = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType(
        [words.schema["key"], *[T.StructField(name, list_type, False) for name in names[1:]]]
    )

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ranks, specials, merges = shared.value
        known: dict[str, bytes] = {}
        for batch in batches:
            for start, end in _parts(batch.columns[1:]):
                part = batch.slice(start, end - start)
                columns = [part.column(0)]
                for words in part.columns[1:]:
                    if len(known) > MAX_REMEMBERED_WORDS:
                        known.clear()
                    columns.append(_encode_lists(words, known, ids, ranks, specials, merges, max_length))
                yield pa.RecordBatch.from_arrays(columns, names)

    return words.mapInArrow(encode_batches, schema)


def _leading_words(
    texts: DataFrame, names: Sequence[str], ids: Mapping[str, int], specials: Sequence[str], n: int, prefix_space: bool
) -> DataFrame:
    """The words of every text, or its first ``n`` if each of these makes an id.

    A cut through a text can change the word at the cut, and no more words in front of
    it than a special token has characters; these are left out of the head.
    """
    enough = n + 1 + max(map(len, specials), default=0)
    width = CHARACTERS_PER_WORD * enough
    heads = texts.select(
        "*", *[split_words_and_specials(F.substring(name, 1, width), specials, prefix_space).alias(f"_{name}") for name in names]
    )
    letters = "".join(symbol for symbol in BYTE_SYMBOLS if symbol in ids)
    columns = []
    for name in names:
        head = F.slice(f"_{name}", 1, n)
        known = F.lit(True)
        if len(letters) < len(BYTE_SYMBOLS):
            known = F.translate(byte_symbols(F.array_join(head, "")), letters, "") == ""
        whole = split_words_and_specials(F.col(name), specials, prefix_space)
        short = F.length(name) <= width
        columns.append(
            F.when(short, F.col(f"_{name}")).when((F.size(f"_{name}") >= enough) & known, head).otherwise(whole).alias(name)
        )
    return heads.select("key", *columns)


def decode(
    df: DataFrame, ids: str, vocab: DataFrame, skip_special: bool = True, output: str = "text"
) -> DataFrame:
    """``df`` with the text of its id lists; ids outside the vocabulary read as nothing.

    Tasks have the vocabulary as one buffer of bytes with the place of every token in
    it, and gather the bytes of many lists at once. Nothing is shuffled.
    """
    table = vocab.select("id", "token", "special")
    if skip_special:
        table = table.filter(~F.col("special"))
    rows = sorted((row.id, _bytes_of(row.token)) for row in _collect_bounded(table, "vocabulary"))
    known = np.fromiter((i for i, _ in rows), np.int64, len(rows))
    ends = np.cumsum(np.fromiter((len(b) for _, b in rows), np.int64, len(rows)))
    shared = df.sparkSession.sparkContext.broadcast((known, ends, b"".join(b for _, b in rows)))

    @F.arrow_udf("binary")
    def gathered(lists: pa.Array) -> pa.Array:
        parts = [_gather_bytes(lists.slice(start, end - start), *shared.value) for start, end in _parts([lists])]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return df.withColumn(output, F.make_valid_utf8(gathered(F.col(ids)).cast("string")))


def _parts(columns: Sequence[pa.ListArray]) -> Iterator[tuple[int, int]]:
    """The rows of parts of a batch, with about TOGETHER entries in the lists of each."""
    sizes = sum(c.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    part = np.cumsum(sizes) // TOGETHER
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    return zip(starts.tolist(), [*starts[1:].tolist(), len(part)])


def _gather_bytes(lists: pa.ListArray, known: np.ndarray, ends: np.ndarray, data: bytes) -> pa.Array:
    """The bytes of every list's tokens; a null list stays null."""
    flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
    # One entry more, of no bytes, for ids that are not there.
    starts = np.concatenate(([0], ends, ends[-1:] if len(ends) else [0]))
    place = np.searchsorted(known, flat)
    there = np.concatenate((known, [-1]))[place] == flat
    place = np.where(there & (flat >= 0), place, len(known))
    sizes = starts[place + 1] - starts[place]
    upto = np.concatenate(([0], np.cumsum(sizes)))
    within = np.arange(upto[-1]) - np.repeat(upto[:-1], sizes)
    gathered = np.frombuffer(data, np.uint8)[np.repeat(starts[place], sizes) + within]
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    bounds = upto[np.concatenate(([0], np.cumsum(lengths)))]
    buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(gathered)]
    texts = pa.Array.from_buffers(pa.large_binary(), len(lists), buffers).cast(pa.binary())
    return pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.binary()))


def check_ids(tokens: DataFrame, ids: str, vocab: DataFrame) -> DataFrame:
    """``(token_id, n)`` for ids that the vocabulary lacks.

    Ids are counted first, so the join sees one row per distinct id.
    """
    used = (
        tokens.select(F.explode(ids).alias("token_id"))
        .groupBy("token_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return used.join(vocab.select(F.col("id").alias("token_id")), "token_id", "left_anti")


def resolve_specials(specials: DataFrame, pad_only: bool = False) -> DataFrame:
    """Fill in missing special tokens of ``(bos, eos, pad, unk)``.

    Padding falls back to the end token; without either, both become ``</s>``. The
    start token falls back to ``<s>``. With ``pad_only``, as for generation, padding
    takes the end token if there is one, and nothing else changes.
    """
    if pad_only:
        return specials.select("bos", "eos", F.coalesce("pad", "eos").alias("pad"), "unk")
    end = F.lit("</s>")
    return specials.select(
        F.coalesce("bos", F.lit("<s>")).alias("bos"),
        F.when(F.col("pad").isNull(), F.coalesce("eos", end)).otherwise(F.col("eos")).alias("eos"),
        F.coalesce("pad", "eos", end).alias("pad"),
        "unk",
    )


def _collect_bounded(table: DataFrame, what: str) -> list:
    rows = table.limit(MAX_SHARED_VOCABULARY + 1).collect()
    if len(rows) > MAX_SHARED_VOCABULARY:
        raise ValueError(f"the {what} has more than {MAX_SHARED_VOCABULARY} rows")
    return rows


def _collect_vocabulary(vocab: DataFrame, merges: DataFrame):
    rows = _collect_bounded(vocab.select("id", "token", "special"), "vocabulary")
    ids = {row.token: row.id for row in rows}
    ranks = {
        (row.left, row.right): (row.rank, row.left + row.right)
        for row in _collect_bounded(merges.select("rank", "left", "right"), "merge list")
    }
    return ids, ranks, [row.token for row in rows if row.special]


_BYTE_OF = {symbol: byte for byte, symbol in enumerate(BYTE_SYMBOLS)}


def _bytes_of(token: str) -> bytes:
    """The bytes of a token: what its symbols stand for, or its own text where they are others."""
    if all(symbol in _BYTE_OF for symbol in token):
        return bytes(_BYTE_OF[symbol] for symbol in token)
    return token.encode("utf-8")


def _encode_lists(lists: pa.ListArray, known, ids, ranks, specials, merges: Merges, max_length: int | None) -> pa.ListArray:
    """Encode the words of every list, looking each distinct word up once."""
    words = lists.flatten().dictionary_encode()
    distinct = words.dictionary.to_pylist()
    short = {}
    for word in distinct:
        if word not in known:
            spelled = word.encode("utf-8")
            if word in specials:
                known[word] = np.array([ids[word]], np.int32).tobytes()
            elif len(spelled) <= SHORT_WORD:
                short[word] = spelled
            else:
                known[word] = np.array(_encode_word(word, ids, ranks), np.int32).tobytes()
    known.update(zip(short, merges.encode(list(short.values()))))
    encoded = [known[word] for word in distinct]
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
    starts = np.concatenate(([0], np.cumsum(sizes)))
    values = np.frombuffer(b"".join(encoded), np.int32)
    place = words.indices.to_numpy(zero_copy_only=False)
    counts = sizes[place]
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    firsts = np.concatenate(([0], np.cumsum(lengths)))
    if max_length is not None:
        # Ids of the list in front of each word; what goes beyond is never gathered.
        before = np.concatenate(([0], np.cumsum(counts)))
        before = before[:-1] - np.repeat(before[firsts[:-1]], lengths)
        counts = np.clip(max_length - before, 0, counts)
    ends = np.concatenate(([0], np.cumsum(counts)))
    within = np.arange(ends[-1]) - np.repeat(ends[:-1], counts)
    flat = values[np.repeat(starts[:-1][place], counts) + within]
    return pa.ListArray.from_arrays(pa.array(ends[firsts], pa.int32()), pa.array(flat, pa.int32()))


def _encode_word(word: str, ids, ranks) -> list[int]:
    symbols = [s for s in (BYTE_SYMBOLS[b] for b in word.encode("utf-8")) if s in ids]
    return [ids[token] for token in merge_symbols(symbols, ranks)]
