"""Phrase collocations of each language, by best-first branch and bound on prefixes.

A phrase grows word by word from its prefix. Cutting it after the first word gives a
score of at most ``1000 * n / f(first word)``, as the whole phrase is never more
frequent than its rest; so the count of a prefix's first word bounds all that can grow
from it, and a prefix seen less than ``least`` times grows nothing. The frontier opens
in order of that bound: first the rarest first words that make up a share of the
language, then those whose bound reaches the last of the ``best`` surviving scores
found, or a larger share where there are too few yet. A language is settled when no
closed word's bound reaches that score, so ties are in, too.

A round reads the corpus once for each length. Tasks look up whether a position can
start a phrase in bit tables of a fixed size, filled from hashes of the prefixes that
are left; false hits cost rows, which go when Spark has counted phrases by all their
words. One more reading counts the rests of the candidates found, and their
extensions by a word on the left. A phrase inside a longer candidate with (nearly) its
count is also inside one that is longer by one word, so these settle what survives.

Words are 64-bit hashes. That no two words of a language share one is checked on all
words, by 64 further bits, and another seed is taken if some do. Products are decimals of 38 digits.

A null text is empty, a null language ``und``. Rows without words, and tables without
rows, give nothing; repeated rows count as often as they stand there. Only ``lang``
and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import REMEMBERED, mixed, slices, written

#: A byte that no text in UTF-8 has stands between pieces.
_BETWEEN = b"\xff"
_SPLIT = bytes.maketrans(b"\t.,;:!?\n\x0b\x0c\r" + bytes(range(65, 91)), b" " + _BETWEEN * 10 + bytes(range(97, 123)))
_WORDS = "lang string, phrase binary, key long, check long, n long"
_COUNTS = "lang string, phrase binary, key long, n long"
_CORPUS = "lang string, words array<long>, phrase binary, word string"
#: A bit table has 2 ** 26 bits in 2 ** 20 numbers, whatever it is filled with.
_SLOT, _BIT = 44, 38
#: The frontier's share of a language in the first round, and its growth while scores are too few.
FIRST_SHARE, GROWTH = 0.125, 4
#: Words in a row of the corpus as hashes, about.
ROW_WORDS = 64
#: Row groups of the corpus as hashes: readers hold one at a time.
_ROW_GROUPS = {"parquet.block.size": 16 << 20}
#: Parts in which a language's scores are cut before they meet.
PARTS = 64


@dataclass(frozen=True)
class Mining:
    """Least count, words of the longest phrase, phrases wanted, and the hundredths of a
    count with which a longer candidate takes a phrase in."""

    least: int = 100
    longest: int = 5
    best: int = 2000
    absorb: int = 100


def mined(docs: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, cut`` of each language's best phrases."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    seed, words = _count_words(texts, mining)
    totals = words.filter("phrase is null").select("lang", F.col("n").alias("total"))
    words = words.filter("phrase is not null")
    runs = written(_runs(texts, seed, _bits(words)), **_ROW_GROUPS)
    corpus = runs.filter("words is not null").select("lang", "words")
    names = runs.filter("word is not null").select("lang", F.col("phrase").alias("one"), "word").distinct()
    best, limits, share = None, None, FIRST_SHARE
    while True:
        limits = written(_opened(words, totals, limits, best, share, mining))
        if limits.filter("upto > after").isEmpty():
            break
        found = _grown(corpus, words, limits, mining)
        if found is not None:
            scores = _scored(_surviving(found, mining), found, words, totals)
            scores = scores if best is None else scores.unionByName(best.drop("place"))
            best = written(_cut(scores, mining.best, [F.desc("score"), F.desc("a")], F.rank()))
            for bits in filter(None, found["shared"]):
                bits.unpersist()
        share *= GROWTH
    if best is None:
        return _nothing(texts)
    spelled = _cut(_spelled(best, names), mining.best, [F.desc("score"), F.desc("a"), "phrase"], F.row_number())
    return spelled.select("lang", F.col("place").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "cut")


def _nothing(texts: DataFrame) -> DataFrame:
    return texts.sparkSession.createDataFrame(
        [], "lang string, rank long, phrase string, a long, l long, r long, n long, score long, cut int"
    )


class _Words(dict):
    """Numbers of words as a task meets them, their spelling and two hashes; 0 stands between pieces.

    A word is looked up with the blank behind it; a blank alone is no word.
    """

    def __init__(self, seed: int) -> None:
        super().__init__({_BETWEEN + b" ": 0, b" ": 1})
        self.seed, self.spelled = seed, [_BETWEEN, b""]
        self.hashes, self.checks = np.zeros(2, np.uint64), np.zeros(2, np.int64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.spelled.append(word[:-1])
        return number

    def sequence(self, texts: list[bytes]) -> np.ndarray:
        blob = _BETWEEN.join(texts).translate(_SPLIT).replace(_BETWEEN, b" " + _BETWEEN + b" ") + b" "
        ends = np.flatnonzero(np.frombuffer(blob, np.uint8) == ord(" ")) + 1
        words = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate(([0], ends))), pa.py_buffer(blob)])
        words = words.dictionary_encode()
        numbers = np.array([self[w] for w in words.dictionary.to_pylist()], np.int64)[words.indices.to_numpy()]
        new = b"".join([xxhash.xxh3_128_digest(w, self.seed) for w in self.spelled[len(self.hashes) :]])
        both = np.frombuffer(new, "<u8").reshape(-1, 2)
        self.hashes = np.concatenate((self.hashes, np.maximum(both[:, 0], 1)))
        self.checks = np.concatenate((self.checks, both[:, 1].view(np.int64)))
        return numbers[numbers != 1]


def _language_key(lang: str) -> np.uint64:
    """A number to start keys with; longer than the language, as a word may be spelled like it."""
    return np.uint64(xxhash.xxh3_64_intdigest(b"language " + lang.encode(errors="surrogatepass")))


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    for part, texts in slices(batch, "text"):
        groups: dict[str, list[bytes]] = {}
        for lang, text in zip(part.column("lang").to_pylist(), texts, strict=True):
            groups.setdefault(lang, []).append(text)
        yield from groups.items()


def _count_words(texts: DataFrame, mining: Mining) -> tuple[int, DataFrame]:
    """The seed of the hashes, and the frequent words; a null word has its language's total."""
    seed = 0
    while True:
        rows = texts.mapInArrow(_word_counter(seed), _WORDS).groupBy("lang", "phrase", "key")
        words = rows.agg(F.min("check").alias("least"), F.max("check").alias("most"), F.sum("n").alias("n"))
        words = written(words.filter(f"n >= {mining.least} or phrase is null or least != most"))
        if words.filter("least != most").isEmpty():
            return seed, words.drop("least", "most")
        seed += 1


def _word_counter(seed: int):
    def rows(words: _Words, counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, n in counts.items():
            met = np.flatnonzero(n[2:]) + 2
            hashes, n = words.hashes[met], n[met]
            keys = mixed(hashes ^ _language_key(lang)).view(np.int64)
            yield _batch(lang, phrase=_packed(hashes[:, None]), key=keys, check=words.checks[met], n=n)
            yield _batch(lang, phrase=pa.nulls(1, pa.binary()), key=pa.nulls(1, pa.int64()), check=pa.nulls(1, pa.int64()), n=n.sum()[None])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = _Words(seed), {}
        for batch in batches:
            for lang, texts in _by_language(batch):
                n = np.bincount(words.sequence(texts), minlength=1)
                total = counts.get(lang, n[:0])
                if len(total) < len(n):
                    total = np.concatenate((total, np.zeros(2 * len(n) - len(total), np.int64)))
                total[: len(n)] += n
                counts[lang] = total
                if len(words) > REMEMBERED:
                    yield from rows(words, counts)
                    words, counts = _Words(seed), {}
        yield from rows(words, counts)

    return count


def _packed(rows: np.ndarray) -> pa.Array:
    """Rows of hashes as binary values."""
    count, m = rows.shape
    offsets = np.arange(count + 1, dtype=np.int32) * np.int32(8 * m)
    return pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows, "<u8"))])


def _batch(lang: str, **columns: pa.Array | np.ndarray) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(arrays[0])), *arrays], ["lang", *columns])


def _bits(counted: DataFrame) -> Broadcast:
    """A shared bit table of the keys: its slots that have bits, and these bits.

    At most 2 ** 20 rows reach the driver, from any table.
    """
    bit = F.shiftrightunsigned("key", _BIT).bitwiseAND(F.lit(63)).cast("int")
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")
    rows = counted.groupBy(F.shiftrightunsigned("key", _SLOT).cast("int").alias("slot")).agg(bits).toArrow()
    shared = rows["slot"].to_numpy(), rows["bits"].to_numpy()
    return counted.sparkSession.sparkContext.broadcast(shared)


def _table(shared: Broadcast | None) -> np.ndarray | None:
    """The whole bit table, in a task."""
    if shared is None:
        return None
    slots, bits = shared.value
    table = np.zeros(1 << (64 - _SLOT), np.uint64)
    table[slots] = bits.view(np.uint64)
    return table


def _among(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (table[keys >> np.uint64(_SLOT)] >> ((keys >> np.uint64(_BIT)) & np.uint64(63)) & np.uint64(1)).astype(bool)


def _runs(texts: DataFrame, seed: int, shared: Broadcast) -> DataFrame:
    """The corpus as hashes of frequent words; one 0 stands for everything between them.

    Rows without a list name the words that their task met. The others hold some
    ROW_WORDS and end with a 0, so batches of rows are small and no phrase is cut.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, kept, frequent = _Words(seed), {}, _table(shared)
        for batch in batches:
            for lang, texts in _by_language(batch):
                if len(words) > REMEMBERED:
                    words, kept = _Words(seed), {}
                numbers = words.sequence(texts)
                known = kept.get(lang, words.hashes[:0])
                new = words.hashes[len(known) :]
                met = _among(mixed(new ^ _language_key(lang)), frequent) & (new != 0)
                kept[lang] = np.concatenate((known, np.where(met, new, np.uint64(0))))
                names = pa.array([words.spelled[k] for k in np.flatnonzero(met) + len(known)], pa.binary())
                yield _batch(lang, words=pa.nulls(len(names), pa.list_(pa.int64())), phrase=_packed(new[met][:, None]), word=names.cast(pa.string()))
                run = kept[lang][numbers]
                run = run[(run != 0) | np.concatenate(([False], run[:-1] != 0))]
                lists = _rows_of(run)
                yield _batch(lang, words=lists, phrase=pa.nulls(len(lists), pa.binary()), word=pa.nulls(len(lists), pa.string()))

    return texts.mapInArrow(encode, _CORPUS)


def _rows_of(run: np.ndarray) -> pa.ListArray:
    run = np.concatenate((run, np.zeros(1, np.uint64)))
    ends = np.flatnonzero(run == 0) + 1
    cuts = np.unique(ends[np.searchsorted(ends, np.arange(ROW_WORDS, len(run), ROW_WORDS))])
    cuts = np.unique(np.concatenate(([0], cuts, [len(run)])))
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(run.view(np.int64)))


def _opened(words: DataFrame, totals: DataFrame, limits: DataFrame | None, best: DataFrame | None, share: float, mining: Mining) -> DataFrame:
    """``lang, total, after, upto``: first words with counts in between are expanded next.

    Counts are summed by eighths of a power of two, so a language has few rows in the window.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 8)
    steps = words.groupBy("lang", step.alias("step")).agg(F.sum("n").alias("tokens"), F.max("n").alias("upto"))
    so_far = F.sum("tokens").over(Window.partitionBy("lang").orderBy("step"))
    steps = steps.withColumn("before", so_far - F.col("tokens")).join(totals, "lang")
    if limits is None:
        steps = steps.withColumn("after", F.lit(0).cast("long"))
    else:
        steps = steps.join(limits.select("lang", F.col("upto").alias("after")), "lang")
    within = F.max(F.when(F.col("before") <= share * F.col("total"), F.col("upto")))
    following = F.min(F.when(F.col("upto") > F.col("after"), F.col("upto")))
    wide = F.greatest(within, following, F.col("after")).alias("wide")
    reached = steps.groupBy("lang", "total", "after").agg(wide, F.max("upto").alias("most"))
    if best is None:
        return reached.select("lang", "total", "after", F.col("wide").alias("upto"))
    last = best.groupBy("lang").agg(F.when(F.count("*") >= mining.best, F.min("score")).alias("last"))
    # The bound of a word reaches the last score up to this count.
    in_reach = F.expr("cast(least(cast(1000 as decimal(38,0)) * total div last, most) as long)")
    upto = F.when(F.col("last") > 0, F.greatest(in_reach, "after")).otherwise(F.col("wide"))
    return reached.join(last, "lang", "left").select("lang", "total", "after", upto.alias("upto"))


def _each(corpus: DataFrame, schema: str, shared: dict, rows) -> DataFrame:
    """What ``rows(lang, words, bit tables)`` makes of each language in each batch of the corpus."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {name: _table(bits) for name, bits in shared.items()}
        for batch in batches:
            langs, lists = batch.column("lang"), batch.column("words")
            for lang in pc.unique(langs).to_pylist():
                run = lists.filter(pc.equal(langs, pa.scalar(lang))).flatten()
                yield from rows(lang, run.to_numpy(zero_copy_only=False).view(np.uint64), tables)

    return corpus.mapInArrow(tasks, schema)


def _growing(lang: str, run: np.ndarray, longest: int) -> Iterator[tuple]:
    """The places of phrases of 1, 2, … words and their keys. The places sent back go on growing."""
    padded = np.concatenate((run, np.zeros(longest, np.uint64)))
    places, keys = np.arange(len(run)), np.full(len(run), _language_key(lang))
    for m in range(1, longest + 1):
        ahead = padded[places + m - 1]
        there = ahead != 0
        places, keys = places[there], mixed(keys[there] ^ ahead[there])
        on = yield m, places, keys
        if on is not None:
            places, keys = places[on], keys[on]
            yield


def _phrases(lang: str, run: np.ndarray, places: np.ndarray, keys: np.ndarray, m: int, **marks: bool) -> Iterator[pa.RecordBatch]:
    """The phrases of ``m`` words at these places, counted by keys that tell most of them apart."""
    if not len(places):
        return
    order = np.argsort(keys)
    places, keys = places[order], keys[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    rows = np.stack([run[places + j] for j in range(m)], axis=1)
    n = np.diff(starts, append=len(keys))
    # Equal keys of different words are rare, and counted one by one.
    other = (rows != np.repeat(rows[starts], n, axis=0)).any(axis=1)
    if other.any():
        n = n - np.add.reduceat(other, starts, dtype=np.int64)
        starts, n = np.concatenate((starts, np.flatnonzero(other))), np.concatenate((n, np.ones(other.sum(), np.int64)))
    columns = {name: np.full(len(n), value) for name, value in marks.items()}
    yield _batch(lang, phrase=_packed(rows[starts]), key=keys[starts].view(np.int64), n=n, **columns)


def _starting(size: int):
    """Phrases of ``size`` words whose shorter prefixes are all in the bit tables."""

    def rows(lang: str, run: np.ndarray, tables: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        growing = _growing(lang, run, size)
        for m, places, keys in growing:
            if m == size:
                yield from _phrases(lang, run, places, keys, m)
            elif tables[m] is not None:
                growing.send(_among(keys, tables[m]))

    return rows


def _around(longest: int):
    """Phrases in the bit tables of rests, and those in the tables of candidates with the word before them."""

    def rows(lang: str, run: np.ndarray, tables: dict[tuple, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for m, places, keys in _growing(lang, run, longest):
            if ("rest", m) in tables:
                met = _among(keys, tables["rest", m])
                yield from _phrases(lang, run, places[met], keys[met], m, left=False)
            if ("inner", m) in tables:
                met = _among(keys, tables["inner", m]) & (places > 0)
                met[met] = run[places[met] - 1] != 0
                before = places[met] - 1
                yield from _phrases(lang, run, before, mixed(keys[met] + run[before]), m + 1, left=True)

    return rows


def _grown(corpus: DataFrame, words: DataFrame, limits: DataFrame, mining: Mining) -> dict | None:
    """Candidates that start with an opened word, by length, and what their scores and survival need."""
    opened = words.join(limits, "lang").filter("n > after and n <= upto").select("lang", "phrase", "key", "n")
    firsts = opened.select("lang", F.col("phrase").alias("first"))
    grown, tables = {}, [_bits(opened)]
    for m in range(2, mining.longest + 1):
        counted = _totals(_each(corpus, _COUNTS, dict(enumerate(tables, 1)), _starting(m)))
        # Written before the join, which Spark would move below the count.
        counted = written(counted.filter(F.col("n") >= mining.least).withColumn("first", F.substring("phrase", 1, 8)))
        # False hits of the bit tables go here.
        level = written(counted.join(firsts, ["lang", "first"], "left_semi").drop("first"))
        if level.isEmpty():
            break
        grown[m] = level
        tables.append(_bits(level))
    if not grown:
        return None
    inner = [m for m in grown if m < mining.longest]
    # Rests of two words and more, by their number of words.
    rests: dict[int, list[DataFrame]] = {}
    for m, level in grown.items():
        for k in range(1, m - 1):
            rests.setdefault(m - k, []).append(level.select("lang", F.substring("phrase", 8 * k + 1, 8 * m).alias("phrase")))
    shared = {("rest", m): _bits(_keyed(_all(parts))) for m, parts in rests.items()}
    shared |= {("inner", m): tables[m - 1] for m in inner}
    lookup, longer = [words.select("lang", "phrase", "n")], []
    if shared:
        longest = max(m for _, m in shared)
        around = _each(corpus, f"{_COUNTS}, left boolean", shared, _around(longest)).groupBy("lang", "left", "phrase").agg(F.sum("n").alias("n"))
        around = written(around)
        lookup.append(around.filter(~F.col("left")).select("lang", "phrase", "n"))
        longer.append(around.filter("left").select("lang", F.expr("substring(phrase, 9)").alias("phrase"), "n"))
    longer += [grown[m + 1].select("lang", F.substring("phrase", 1, 8 * m).alias("phrase"), "n") for m in inner if m + 1 in grown]
    return {
        "shared": [*tables, *shared.values()],
        "phrases": _all([level.withColumn("size", F.lit(m)) for m, level in grown.items()]),
        "prefixes": _all([opened.select("lang", "phrase", "n"), *[grown[m].select("lang", "phrase", "n") for m in inner]]),
        "rests": _all(lookup),
        "longer": _all(longer) if longer else None,
    }


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "phrase").agg(F.min("key").alias("key"), F.sum("n").alias("n"))


def _all(tables: list[DataFrame]) -> DataFrame:
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result


def _keyed(phrases: DataFrame) -> DataFrame:
    """Phrases with the keys that tasks compute from their words."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
                key = np.full(1, _language_key(lang))
                for word in np.frombuffer(phrase, "<u8"):
                    key = mixed(key ^ word)
                keys.append(key.view(np.int64)[0])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64())], ["key"])

    return phrases.distinct().mapInArrow(add, "key long")


def _surviving(found: dict, mining: Mining) -> DataFrame:
    """Candidates that no candidate longer by one word takes in."""
    phrases = found["phrases"].select("lang", "phrase", "size", F.col("n").alias("a"))
    if found["longer"] is None:
        return phrases
    most = found["longer"].groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    taken = (F.col("most") >= mining.least) & (100 * F.col("most") >= mining.absorb * F.col("a"))
    return phrases.join(most, ["lang", "phrase"], "left").filter(F.col("most").isNull() | ~taken).drop("most")


def _scored(candidates: DataFrame, found: dict, words: DataFrame, totals: DataFrame) -> DataFrame:
    """The least score over all cuts, with the shortest first part among equals."""
    cuts = candidates.withColumn("cut", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.withColumn("head", F.expr("substring(phrase, 1, 8 * cut)")).withColumn("rest", F.expr("substring(phrase, 8 * cut + 1)"))
    heads = found["prefixes"].select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = found["rests"].select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(totals, "lang")
    wide = {c: f"cast({c} as decimal(38, 0))" for c in ("a", "l", "r", "total")}
    score = F.expr(f"cast(1000 * {wide['a']} * {wide['total']} div ({wide['l']} * {wide['r']}) as long)")
    least = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("least")
    scored = cuts.groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(least)
    return scored.select("lang", "phrase", "a", "n", "least.*")


def _cut(rows: DataFrame, best: int, order_by: list, place: Column) -> DataFrame:
    """Rows of each language with a place up to ``best``.

    They are cut in parts first, so that no task sorts a whole language.
    """
    rows = rows.withColumn("part", F.pmod(F.hash("phrase"), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(*order_by)
        rows = rows.withColumn("place", place.over(order)).filter(F.col("place") <= best)
    return rows.drop("part")


def _spelled(best: DataFrame, names: DataFrame) -> DataFrame:
    """Phrases as texts in place of hashes."""
    places = best.withColumn("size", F.length("phrase") / 8).withColumn("at", F.explode(F.expr("sequence(0, int(size) - 1)")))
    spelled = places.withColumn("one", F.expr("substring(phrase, 8 * at + 1, 8)")).join(names, ["lang", "one"])
    ordered = F.array_sort(F.collect_list(F.struct("at", "word")))
    texts = spelled.groupBy("lang", "phrase").agg(F.array_join(F.transform(ordered, lambda x: x["word"]), " ").alias("text"))
    return best.drop("place").join(texts, ["lang", "phrase"]).drop("phrase").withColumnRenamed("text", "phrase")
