"""WARC archives in Zstandard, each with its own dictionary in front.

A task writes one archive: it trains a dictionary on the first ``SAMPLE_BYTES`` of its
records, puts it into a skippable frame at the head, and compresses every record into
a frame of its own with that dictionary, so that a single record can be read alone.
The bytes go through Spark's text sink, which commits whole files to any store that
Spark writes to. The sink puts a separator behind each row; here it is an empty
skippable frame, whose eight bytes are ASCII, so files are plain Zstandard throughout.
The sink names the files, and names end in ``.txt``.

Of records with equal payloads of ``least_bytes`` or more, the one with the greatest
page_id (null is least) is a response, and the others are revisits of it, without the
payload. Rows that repeat page_id and payload count as such records, too, so one of
them alone has the payload. Payloads are equal if SHA-1, SHA-256 and length are.

A null html is an empty payload, a null url has no target. Control characters and
spaces of a url are percent-encoded. Tables without rows make archives without
records. Only ``page_id, url, html`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import written

#: Bytes of payloads in an archive, about.
ARCHIVE_BYTES = 64_000_000
#: Most bytes of records that a dictionary is trained on, and of the dictionary.
SAMPLE_BYTES, DICTIONARY_BYTES = 4_000_000, 65_536
LEVEL = 3
# Fixed values of the formats: Zstandard's magic numbers, that of a dictionary frame, the revisit profile.
_FRAME, _SKIPPABLE, _DICTIONARY = 0xFD2FB528, 0x184D2A50, 0x184D2A5D
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SEPARATOR = "P*M\x18\x00\x00\x00\x00"
#: Names that record ids are derived from.
_IDS = uuid.UUID("9d1f6a52-52f0-4f4e-9df3-0a6f1d6f3a11")

RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """Write a record for every row of ``pages`` below ``folder``; ``date`` is that of all records.

    The rows are written once with a number, by which each finds its decision again:
    payloads are shuffled by these even numbers, and digests alone meet by content.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = written(rows, compression="zstd")
    content = ["sha1", "sha256", "size"]
    facts = rows.select("row", "page_id", F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("sha256"), F.octet_length("payload").alias("size"))
    kept = facts.filter(F.col("size") >= least_bytes).groupBy(*content).agg(F.max(F.struct("page_id", "row")).alias("of"))
    decided = facts.join(kept, content, "left").select("row", "sha1", "size", F.col("of.row").alias("of_row"), F.col("of.page_id").alias("of_page"))
    revisit = F.coalesce(F.col("of_row") != F.col("row"), F.lit(False))
    archives = max(1, -(-(facts.agg(F.sum("size")).first()[0] or 0) // archive_bytes))
    dealt = rows.repartition(archives, "row").join(decided.repartition(archives, "row"), "row")
    records = dealt.select(
        "row", "page_id", "url", "sha1", "size", revisit.alias("revisit"),
        F.when(revisit, F.col("of_row")).alias("of_row"), F.when(revisit, F.col("of_page")).alias("of_page"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )
    frames = records.mapInArrow(_archive(date), "frame binary").select(F.col("frame").cast("string").alias("value"))
    frames.write.option("lineSep", _SEPARATOR).option("maxRecordsPerFile", 0).option("compression", "none").text(folder)


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records below ``folder``, one row each; responses are checked against their digests."""
    schema = RECORDS if with_payload else RECORDS.rsplit(",", 1)[0]
    names = [column.split()[0] for column in schema.split(", ")]
    files = spark.read.format("binaryFile").load(folder).select("content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for records in _lots(map(_parsed, _records(content.as_py()))):
                    yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in records], pa.schema(_FIELDS[: len(names)]))

    return files.mapInArrow(read, schema)


_FIELDS = [
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
]


def _lots(records: Iterable[dict], rows: int = 1000, most: int = 8_000_000) -> Iterator[list[dict]]:
    """Records in lists of a bounded size."""
    lot, size = [], 0
    for record in records:
        lot.append(record)
        size += len(record["payload"] or b"")
        if len(lot) >= rows or size >= most:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def _archive(date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (_record(row, date) for batch in batches for row in _rows(batch))
        first, size = [], 0
        for record in records:
            first.append(record)
            size += len(record)
            if size >= SAMPLE_BYTES:
                break
        if not first:
            return
        dictionary = _dictionary(first)
        raw = dictionary.as_bytes()
        yield _frames([struct.pack("<II", _DICTIONARY, len(raw)) + raw])
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        for some in (first, records):
            lot, size = [], 0
            for record in some:
                lot.append(compressor.compress(record))
                size += len(lot[-1])
                if size >= SAMPLE_BYTES:
                    yield _frames(lot)
                    lot, size = [], 0
            if lot:
                yield _frames(lot)

    return write


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}


def _frames(frames: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A trained dictionary; of too few records to train on, their own text."""
    size = min(DICTIONARY_BYTES, max(sum(map(len, records)) // 8, 1024))
    try:
        return zstandard.train_dictionary(size, [r[: DICTIONARY_BYTES * 2] for r in records], level=LEVEL, d=8, k=1024)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(records)[:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _record(row: dict, date: str) -> bytes:
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    block = http + (row["payload"] or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if row['revisit'] else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_IDS, str(row['row']))}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {_escaped(row['url'])}")
    if row["page_id"] is not None:
        head.append(f"Page-ID: {row['page_id']}")
    if row["revisit"]:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(_IDS, str(row['of_row']))}>"]
        if row["of_page"] is not None:
            head.append(f"Refers-To-Page-ID: {row['of_page']}")
    return "\r\n".join([*head, "", ""]).encode(errors="surrogatepass") + block + b"\r\n\r\n"


def _escaped(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def _records(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, frame by frame."""
    data, at = memoryview(archive), 0
    reader = zstandard.ZstdDecompressor()
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at)
        if magic == _FRAME:
            end = _frame_end(data, at)
            yield reader.decompress(data[at:end])
        elif magic & 0xFFFFFFF0 == _SKIPPABLE:
            end = at + 8 + size
            if magic == _DICTIONARY:
                kept = bytes(data[at + 8 : end])
                if kept[:4] == struct.pack("<I", _FRAME):
                    kept = zstandard.ZstdDecompressor().decompress(kept)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(kept))
        else:
            raise ValueError(f"no frame at byte {at} of an archive")
        at = end


def _frame_end(data: memoryview, at: int) -> int:
    """Where the frame ends that begins at ``at``: behind its blocks and its checksum."""
    parameters = zstandard.get_frame_parameters(data[at : at + 18])
    at += zstandard.frame_header_size(data[at : at + 18])
    while True:
        block = int.from_bytes(data[at : at + 3], "little")
        # A block of one repeated byte holds that byte alone.
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            return at + 4 * parameters.has_checksum


def _parsed(record: bytes) -> dict:
    head, _, block = record.partition(b"\r\n\r\n")
    version, *lines = head.decode(errors="surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    if version != "WARC/1.1" or block[length:] != b"\r\n\r\n":
        raise ValueError("a record of an archive is damaged")
    http, _, payload = block[:length].partition(b"\r\n\r\n")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    if kind == "response":
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError("a payload differs from its digest")
    known = {name: int(fields[name]) if name in fields else None for name in ("Page-ID", "Refers-To-Page-ID")}
    return {
        "page_id": known["Page-ID"], "url": fields.get("WARC-Target-URI"), "record_type": kind, "refers_to": known["Refers-To-Page-ID"],
        "payload_bytes": size, "payload_digest": digest, "payload": payload if kind == "response" else None,
    }
