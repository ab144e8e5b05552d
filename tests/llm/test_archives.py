"""Manifests and archives against brute force, their SQL and round trips."""

import base64
import hashlib
import zlib

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from millrace.llm.common import new_folder
from millrace.llm.manifest import verified_manifest
from millrace.llm.queries import ORACLE_SQL, QUERIES
from millrace.llm.warc import _records, read_archives, write_archives

SF_DIR = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """The top digest, and for every node its siblings on the way there, as (left, right)."""
    ways, groups = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        for k, members in enumerate(groups):
            run = nodes[k // 16 * 16 : k // 16 * 16 + 16]
            for m in members:
                ways[m].append(("".join(run[: k % 16]), "".join(run[k % 16 + 1 :])))
        groups = [sum(groups[k : k + 16], []) for k in range(0, len(groups), 16)]
        nodes = [sha("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
    return nodes[0], ways


def brute_manifest(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row.source, []).append((row.doc_id is not None, row.doc_id or 0, leaf(row, row.text), row))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    tops = {}
    for source in order:
        trees[source].sort(key=lambda x: x[:3])
        tops[source] = climb([x[2] for x in trees[source]])
    root, over = climb([tops[s][0] for s in order])
    result = []
    for source, above in zip(order, over):
        for (_, _, own, row), way in zip(trees[source], tops[source][1]):
            text, digest = row.text, own
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0 and text is not None:
                digest = leaf(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for left, right in way + above:
                digest = sha(left + digest + right)
            proof = sha("".join(a + b for a, b in way + above))
            result.append((row.doc_id, own, tops[source][0], root, proof, digest, digest == root))
    return sorted(result, key=str)


def manifest(df):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return sorted((tuple(r) for r in verified_manifest(df, tampered).collect()), key=str)


def test_manifest_of_deep_trees_equals_brute_force(spark):
    """A source of 700 rows, one of 16, one of 17, lone ones, and a source that is null."""
    sources = ["hot"] * 700 + ["a"] * 16 + ["b"] * 17 + [None] * 3 + [f"lone{k}" for k in range(40)] + ["", "é"]
    rows = [(k * 7919 % 1009, f"Text {k}" if k % 11 else None, "en" if k % 3 else None, s, k if k % 5 else None) for k, s in enumerate(sources)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = manifest(docs)
    assert got == brute_manifest(docs.collect())
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_manifest_edges(spark, edge_documents, no_documents):
    clashing = edge_documents.withColumnRenamed("extra", "tree").withColumn("slot_0", F.lit(1)).withColumn("way", F.lit(2))
    assert manifest(clashing) == brute_manifest(edge_documents.collect())
    assert manifest(no_documents) == []
    alone = edge_documents.filter("doc_id = 4")
    assert manifest(alone) == brute_manifest(alone.collect())
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r[1] == r[2] == r[3], r[4]) for r in manifest(alone)] == [(True, empty)]


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_warc_archives"])
def test_query_equals_its_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    duck = duckdb.connect()
    for table in ("pages", "documents"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = duck.sql(ORACLE_SQL[name]).df()[list(got.columns)]
    if "refers_to" in got:
        got["refers_to"], expected["refers_to"] = got["refers_to"].astype("Int64"), expected["refers_to"].astype("Int64")
    as_text = lambda df: sorted(map(tuple, df.astype(str).to_numpy().tolist()))
    assert as_text(got) == as_text(expected) and len(got) > 0


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


PAGES = [
    (1, "http://a/", "<p>one</p>", "x"),
    (2, "http://a/ b\r\nWARC-Type: revisit", "<p>one</p>", "x"),
    (3, None, "P*M\x18\x00\x00\x00\x00 WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n", "x"),
    (4, "http://é/ü", "naïve 🙂", "x"),
    (5, "u", None, None),
    (6, "u", "", "x"),
    (None, "u", "", "x"),
    (7, "u", "<p>same</p>", "x"),
    (7, "u", "<p>same</p>", "x"),
    (7, "v", "<p>same</p>", "x"),
    (8, "u", "long " * 400_000, "x"),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, row string")
    folder = new_folder(spark, "warc")
    write_archives(pages, folder, archive_bytes=500_000)
    rows = read_archives(spark, folder).collect()
    assert len(rows) == len(PAGES) and spark.read.format("binaryFile").load(folder).count() > 1
    content = {p[0]: (p[2] or "").encode() for p in PAGES}
    for r in rows:
        payload = content[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), digest(payload))
        assert r.payload == (payload if r.record_type == "response" else None)
    kinds = sorted([(r.page_id or 0, r.record_type, r.refers_to) for r in rows], key=str)
    assert kinds == [
        (0, "revisit", 6), (1, "revisit", 2), (2, "response", None), (3, "response", None), (4, "response", None), (5, "revisit", 6),
        (6, "response", None), (7, "response", None), (7, "revisit", 7), (7, "revisit", 7), (8, "response", None),
    ]
    assert {r.page_id: r.url for r in rows}[2] == "http://a/%20b%0D%0AWARC-Type:%20revisit"
    assert read_archives(spark, folder, with_payload=False).count() == len(PAGES)


def test_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, row string")
    folder = new_folder(spark, "warc")
    write_archives(pages, folder, least_bytes=11)
    kinds = {(r.page_id, r.record_type) for r in read_archives(spark, folder).collect()}
    assert {(1, "response"), (2, "response"), (5, "response"), (None, "response"), (7, "revisit"), (7, "response")} <= kinds


def test_archives_are_plain_zstandard(spark):
    """A dictionary in a skippable frame, and each record alone in a frame behind it."""
    folder = new_folder(spark, "warc")
    write_archives(spark.read.parquet(f"{SF_DIR}/pages.parquet").coalesce(1), folder)
    content = spark.read.format("binaryFile").load(folder).first().content
    assert content[:4] == (0x184D2A5D).to_bytes(4, "little")
    size = int.from_bytes(content[4:8], "little")
    kept = zstandard.ZstdCompressionDict(bytes(content[8 : 8 + size]))
    stream = zstandard.ZstdDecompressor(dict_data=kept).stream_reader(bytes(content[8 + size :]), read_across_frames=True)
    records = list(_records(bytes(content)))
    assert stream.read() == b"".join(records) and len(records) == 50
    assert all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    assert len(content) < sum(map(len, records)) / 2


def test_archives_of_no_pages(spark):
    folder = new_folder(spark, "warc")
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert read_archives(spark, folder).count() == 0
