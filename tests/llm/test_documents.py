"""Operators over documents: edge cases, and brute force over the smallest table."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import common, packing, quality, text_classifier
from millrace.llm.near_duplicates import Banding, _collisions, _shared_halves, _sign, near_duplicates
from millrace.llm.packing import packed, sum_of_squares
from millrace.llm.pii import found_spans, personal_data, redacted
from millrace.llm.quality import gram_counts, kneser_ney, quality_rules
from millrace.llm.substrings import without_repeats
from millrace.llm.text_classifier import buckets_of
from tests.llm.conftest import prose

SF_DIR = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda x: (x is not None, x))


# --- quality --------------------------------------------------------------------


def base(text):
    words = WORD.findall(text)
    lines, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in lines
            lines.add(line)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for j in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_quality_counts_equal_brute_force(documents, texts):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules(documents).collect()}
    assert got == {k: base(t) for k, t in texts.items()}


def test_quality_edges(edge_documents, no_documents):
    rows = quality_rules(edge_documents).collect()
    assert len(rows) == edge_documents.count()
    assert [(r.n_words, r.kept, r.log_ppl) for r in rows if r.doc_id == 3] == [(0, False, None)]
    assert len({(r.n_words, r.log_ppl) for r in rows if r.doc_id in (1, 2)}) == 1
    assert quality_rules(no_documents).count() == 0


def test_probabilities_of_the_next_character_sum_to_one(documents):
    model = kneser_ney(gram_counts(documents).toArrow())
    ends = [chr(c).encode() for c in range(1, 127) if not chr(c).isspace()]
    stop = np.exp(model.score("en", [b"th"])[0])
    # The words "th" + c begin alike; what differs is the chance of c and of the end after it.
    begin = np.exp(model.score("en", [b"th" + c for c in ends]))
    assert 0 < stop < 1 and 0 < begin.sum() + stop < 1


def test_quality_bands_reject_other_scripts_and_keep_prose(spark):
    rows = [(k, prose(k, 90), "en") for k in range(60)] + [(100, " ".join("ZQXJ%%%##" + str(k % 7) for k in range(90)), "en")]
    kept = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(kept[k] for k in range(60)) and not kept[100]


# --- near duplicates ------------------------------------------------------------


def shingle_sets(texts, size):
    sets = {}
    for k, text in texts.items():
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[k] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    return sets


def components(sets, percent):
    part = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and part[a] != part[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    low, high = sorted((part[a], part[b]))
                    part = {k: low if v == high else v for k, v in part.items()}
    return part


def test_near_duplicates_equal_brute_force(documents, texts):
    sets = shingle_sets(texts, 3)
    part = components(sets, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(documents).collect()}
    assert got == {k: (len(sets[k]), part[k], part[k] == k) for k in texts}


def test_links_are_found_where_the_first_member_is_too_far(spark):
    """Copies changed in different places: ends of the chain aren't alike, neighbours are."""
    words = prose(3, 120).split()
    texts = {}
    for k in range(12):
        changed = list(words)
        for j in range(k):
            changed[4 + 9 * j] = f"new{j}"
        texts[k] = " ".join(changed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = components(shingle_sets(texts, 5), 80)
    assert {r.doc_id: r.component_id for r in near_duplicates(docs, Banding(words=5, percent=80)).collect()} == expected
    assert set(expected.values()) == {0}


def test_table_keys_are_made_of_shared_half_keys_alone(spark):
    """Buckets are those of all table keys; a document that is like no other makes none."""
    words = prose(3, 120).split()
    texts = {k: " ".join([*words[:60], *[f"new{k}_{j}" for j in range(k)], *words[60:]]) for k in range(4)}
    texts |= {k: " ".join(f"own{k}_{j}" for j in range(90)) for k in range(4, 40)} | {90: texts[2], 91: "", 92: None, None: texts[1]}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    schema = "doc_id long, n_shingles long, id1 long, id2 long, first array<long>, second array<long>"
    signed = docs.mapInArrow(_sign(Banding(words=5, percent=80)), schema)
    assert {r.id for r in _shared_halves(signed).collect()} <= {0, 1, 2, 3}

    every = F.flatten(F.transform("first", lambda x, i: F.transform("second", lambda y, j: F.xxhash64(i, j, x, y))))
    of = defaultdict(set)
    for r in signed.filter("n_shingles > 0 and doc_id < 90").select("doc_id", F.explode(every).alias("key")).collect():
        of[r.key].add(r.doc_id)
    expected = {(key, k, min(x), len(x)) for key, x in of.items() if len(x) > 1 for k in x}
    found = [tuple(r) for r in _collisions(signed).select("key", "id", "lead", "n").collect()]
    assert expected and sorted(found) == sorted(expected)


def test_near_duplicate_edges(edge_documents, no_documents):
    rows = near_duplicates(edge_documents).collect()
    assert len(rows) == edge_documents.count()
    of = defaultdict(list)
    for r in rows:
        of[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert {x[1:] for x in of[1]} == {(1, True)} and {x[1:] for x in of[2]} == {(1, False)} and len(of[2]) == 2
    assert of[3] == [(0, 3, True)] and of[4] == [(0, 4, True)] and of[5] == [(0, 5, True)]
    assert all(kept and component is None for _, component, kept in of[None])
    assert near_duplicates(no_documents).count() == 0


# --- personal data --------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub(r"[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def digest(text):
    spans = sorted((m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if passes(kind, m[0]))
    return hashlib.sha256(",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans).encode()).hexdigest()


CASES = [
    "a@b.co_m@x.org and a@b.com@d.org, c@d..e.f @x.y z@-.-",
    "1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.255 1.2.3 256.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 0000 0000 0000 5 5-5",
    "+1 (017) 555-7713 +49.30.1234567.. +12345678 ++1 2 3 4 5 6 7 8 9",
    "🙂 é +1 555 123 4567 🙂 x@é.com y@z.example 10.0.0.1\n10.0.0.2",
    "1" * 5_000 + " " + "1 " * 5_000 + "a." * 5_000 + "a@b" + ".c" * 5_000,
    "a" * 50_000 + "@" + "b" * 50_000,
]


def test_personal_data_equals_plain_patterns(spark, documents, texts):
    cases = dict(enumerate(CASES))
    for df, of in ((documents, texts), (spark.createDataFrame(list(cases.items()), "doc_id long, text string"), cases)):
        assert {r.doc_id: r.base_sha256 for r in personal_data(df).collect()} == {k: digest(t) for k, t in of.items()}


def test_further_kinds_need_checks_or_context(spark):
    rows = [(1, "IBAN DE89 3704 0044 0532 0130 00 ok"), (2, "IBAN DE89 3704 0044 0532 0130 01 ok"), (3, "call 212-555-0187 now"), (4, "part 212-555-0187 now"), (5, "ssn 123-45-6789"), (6, "123-45-6789")]
    found = {r.doc_id: [x.kind for x in r.found] for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: ["iban"], 2: [], 3: ["local_phone"], 4: [], 5: ["ssn"], 6: []}


def test_personal_data_edges_and_redaction(spark, edge_documents, no_documents):
    rows = personal_data(edge_documents).collect()
    assert len(rows) == edge_documents.count()
    assert {(r.base_sha256, r.spans) for r in rows if r.doc_id in (3, 4, 5)} == {(hashlib.sha256(b"").hexdigest(), "")}
    assert personal_data(no_documents).count() == 0
    docs = spark.createDataFrame([("🙂 mail a@b.com or 10.0.0.1, é",), ("nothing",), (None,), ("",)], "text string")
    assert [r[0] for r in docs.select(redacted(F.col("text"), found_spans(F.col("text")))).collect()] == ["🙂 mail <EMAIL> or <IP>, é", "nothing", None, ""]


# --- packing --------------------------------------------------------------------


def test_packing_keeps_every_id_and_fills_sequences(documents, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = packed(documents, TOKENIZER, length=512).collect()
    expected = {}
    for k, text in texts.items():
        n = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
        expected |= {(k, p): (512 * p, min(512, n - 512 * p)) for p in range(-(-n // 512))}
    assert {(r.doc_id, r.piece): (r.start, r.length) for r in rows} == expected
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert ends[-1] <= 512 and [o for o, _ in sorted(places)] == [0, *ends[:-1]]
    # No packing needs fewer sequences than the tokens fill.
    assert len(held) <= 1.02 * -(-sum(r.length for r in rows) // 512)


def test_words_encode_like_whole_texts(spark):
    import zlib

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = ["Don't we'll X's 12ab-ÀÉ ß!", "<|endoftext|> a<|startoftext|>b <|", "é ﬁ Å 🙂 x\x85y\x1cz", "a\r\n\x0b\x0cb", "", None, "ΟΔΟΣ İ"]
    rows = packed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), TOKENIZER).collect()
    for r in rows:
        whole = [*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert (r.length, r.ids_crc32) == (len(whole), zlib.crc32(np.array(whole, "<u4").tobytes()))


def test_packing_edges(edge_documents, no_documents):
    rows = packed(edge_documents, TOKENIZER).collect()
    assert sum(r.piece == 0 for r in rows) == edge_documents.count()
    assert packed(no_documents, TOKENIZER).count() == 0


def test_each_piece_lowers_the_sum_of_squares_most():
    lengths = np.random.default_rng(3).integers(1, 30, 200)
    sequences, _ = sum_of_squares(lengths, 40, len(lengths))
    gaps = {}
    for n, to in zip(lengths.tolist(), sequences.tolist(), strict=True):
        def after(choice, n=n):
            new = gaps | {choice: gaps.get(choice, 40) - n}
            return sum(c * c for g, c in Counter(new.values()).items() if g)
        choices = [s for s, g in gaps.items() if g >= n] + [len(gaps)]
        assert after(to) == min(map(after, choices))
        gaps[to] = gaps.get(to, 40) - n


# --- repeated passages ----------------------------------------------------------


def cleaned(rows, window=20):
    """Brute force over (doc_id, text) rows; a null id comes first."""
    order = lambda r: (r[0] is not None, r[0])
    words = [(r[0], WORD.findall(r[1] or "")) for r in sorted(rows, key=order)]
    first = {}
    for k, w in words:
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (k is not None, k, i))
    found = []
    for k, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (k is not None, k, i):
                gone.update(range(i, i + window))
        found.append((k, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return Counter(found)


@pytest.mark.parametrize("block_size", [50_000, 3])
def test_passages_equal_brute_force(documents, texts, block_size):
    got = Counter(tuple(r) for r in without_repeats(documents, block_size).collect())
    assert got == cleaned(list(texts.items()))


def test_passages_inside_a_document_and_edges(spark, edge_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in edge_documents.collect()]
    assert Counter(tuple(r) for r in without_repeats(edge_documents).collect()) == cleaned(rows)
    loops = [(1, "a b c " * 40), (2, prose(2, 50) + " " + prose(2, 50)), (3, "x y " + prose(2, 19)), (4, "a " * 25)]
    docs = spark.createDataFrame(loops, "doc_id long, text string")
    assert Counter(tuple(r) for r in without_repeats(docs).collect()) == cleaned(loops)
    assert without_repeats(no_documents).count() == 0


def test_a_third_of_junk_is_rejected(spark):
    """Junk under half of a language's rows moves neither centre nor width of the band."""

    def junk(k):
        letters = np.random.default_rng(k).integers(33, 127, (90, 8))
        return " ".join(bytes(word).decode() for word in letters.astype(np.uint8).tolist())

    rows = [(k, prose(k, 90), "en") for k in range(100)] + [(100 + k, junk(k), "en") for k in range(40)]
    kept = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sum(kept[k] for k in range(100)) >= 95 and not any(kept[k] for k in range(100, 140))


def test_words_of_the_classifier_are_forgotten_in_time():
    """Workers keep the table of words from stage to stage, so it stays small."""
    for k in range(60):
        buckets_of([b"%d-%d" % (k, i) for i in range(5_000)])
    assert len(text_classifier._WORDS) <= 60_000


def test_tasks_hold_few_words_and_texts_together(monkeypatch):
    """N-grams are made of some words at a time, texts of a batch part by part, with the same counts and scores."""
    held, taken = [], []
    grams_of, texts_of = quality.grams_of, common.texts_of
    monkeypatch.setattr(quality, "grams_of", lambda words, order: held.append(len(words)) or grams_of(words, order))
    monkeypatch.setattr(common, "texts_of", lambda column: taken.append(len(column)) or texts_of(column))
    texts = [" ".join(f"w{k * 977 + i}" for i in range(600)) for k in range(60)] + [None, "x" * 3_000_000, "w1 w1"]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    counts = pa.Table.from_batches(quality._count(4)(iter([batch])))
    assert max(held) <= 10_000 and sum(taken) == len(texts) and max(taken) < len(texts)
    words = Counter(w for t in texts for w in (t or "").encode().split())
    grams, lengths = grams_of(list(words), 4)
    wanted = Counter()
    for gram, n in zip(grams.tolist(), np.repeat(list(words.values()), lengths).tolist(), strict=True):
        wanted[gram] += n
    assert len(wanted) == counts.num_rows and dict(zip(counts["gram"].to_pylist(), counts["n"].to_pylist(), strict=True)) == wanted
    held.clear()
    model, some = kneser_ney(counts), list(words)[:25_000]
    scores = model.score("en", some)
    assert max(held) <= 10_000
    assert scores.tolist() == [x for k in range(0, len(some), 700) for x in model.score("en", some[k : k + 700])]


def test_packing_leaves_no_words_in_a_worker():
    """Workers go on to tasks of other stages, so only the tokenizer stays."""
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": [prose(1, 500), None]})
    lengths = [n for b in packing._cut(TOKENIZER, 4096)(iter([batch])) for n in b.column("length").to_pylist()]
    assert lengths[0] > 500 and lengths[1] == 1
    assert not packing.encoded(TOKENIZER) and not packing.encoded(TOKENIZER).parts
