"""WARC archives with one Zstandard frame per record and the dictionary in a leading skippable frame.

An archive is built as one value by one task and written by Spark's text writer, one archive per file, so it reaches any
store Spark writes to and failed tasks are committed or dropped as usual.  The writer's line separator is an empty
skippable frame, which every Zstandard reader passes over.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from mlframe.llm.common import raw
from mlframe.runtime import scratch_dir

# Fixed values of the format: magic numbers of the dictionary's and the separator's skippable frames, all 16 of which may occur.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
# Payload bytes after which an archive is closed, sample the dictionary is trained on, and its size.
ARCHIVE_BYTES = 16_000_000
SAMPLE_BYTES = 1_000_000
DICTIONARY_BYTES = 16_384
STEP = 65_536
KINDS = ("response", "revisit")
HEADERS = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "WARC-Payload-Digest", "X-Payload-Length", "Content-Length")
DATE = "1970-01-01T00:00:00Z"
ROW = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, kind: str, refers_to: int | None, payload: bytes) -> bytes:
    """One WARC 1.1 record.  A revisit has an empty block and names the record it repeats."""
    block = b"" if kind == "revisit" else payload
    uri = (url or "urn:none").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
             f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {_urn(refers_to)}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def pack(records: list[bytes]) -> bytes:
    """An archive of ``records``: dictionary frame, then a frame for each."""
    sample, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        sample.append(r[:STEP])
        size += len(sample[-1])
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, sample)
    except zstandard.ZstdError:  # too few or too short records to train on: they are the dictionary as they stand
        trained = zstandard.ZstdCompressionDict(b"".join(sample)[:DICTIONARY_BYTES].ljust(8, b"\0"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    body = trained.as_bytes()
    compress = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True, write_content_size=True).compress
    return b"".join([struct.pack("<II", DICTIONARY_MAGIC, len(body)), body, *map(compress, records)])


def unpack(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, decoded one frame at a time with the dictionary of its leading frame."""
    view, at, read = memoryview(archive), 0, None
    while at < len(view):
        if len(view) - at < 8:
            raise ValueError(f"archive is cut at byte {at}")
        magic, length = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            if at + 8 + length > len(view):
                raise ValueError(f"skippable frame at byte {at} is cut")
            if at == 0:
                if magic != DICTIONARY_MAGIC:
                    raise ValueError("archive does not start with a dictionary frame")
                read = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(view[8:8 + length])))
            at += 8 + length
            continue
        if read is None:
            raise ValueError("archive does not start with a dictionary frame")
        frame, out = read.decompressobj(), []
        while not frame.eof:
            piece = view[at:at + STEP]
            if not len(piece):
                raise ValueError("last frame is cut")
            out.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield b"".join(out)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record.  Raises ValueError for a bad version, a missing or repeated header, a wrong length,
    digest or reference, and for bytes after the record."""
    head, found, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not found or version not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or name in headers:
            raise ValueError(f"bad header line {line[:80]!r}")
        headers[name] = value.strip()
    if missing := [h for h in HEADERS if h not in headers]:
        raise ValueError(f"headers missing: {missing}")
    kind, length = headers["WARC-Type"], int(headers["Content-Length"])
    if kind not in KINDS:
        raise ValueError(f"unknown record type {kind!r}")
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {length}, the block has {len(rest) - 4} bytes")
    block = rest[:length]
    if kind == "revisit":
        if length or "WARC-Refers-To" not in headers:
            raise ValueError("a revisit needs an empty block and WARC-Refers-To")
    elif headers["WARC-Payload-Digest"] != f"sha1:{digest(block)}" or int(headers["X-Payload-Length"]) != length:
        raise ValueError("payload digest or length does not fit the block")
    return headers, block


def _id(urn: str) -> int | None:
    if not (urn.startswith("<urn:page:") and urn.endswith(">")):
        raise ValueError(f"bad record id {urn!r}")
    return None if urn[10:-1] == "none" else int(urn[10:-1])


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([pack(held)], pa.binary())], ["archive"])

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("page_id", "url", "kind", "refers_to")]
        for page_id, url, kind, ref, html in zip(*cols, raw(batch.column("html"))):
            held.append(record(page_id, url, kind, ref, html or b""))
            size += len(held[-1])
            if size >= ARCHIVE_BYTES:
                yield close()
                held, size = [], 0
    if held:
        yield close()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])
    for batch in batches:
        for i in range(batch.num_rows):
            rows = []
            for data in unpack(batch.column("content")[i].as_buffer()):
                h, _ = parse(data)
                revisit = h["WARC-Type"] == "revisit"
                rows.append((_id(h["WARC-Record-ID"]), int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"),
                             h["WARC-Type"], _id(h["WARC-Refers-To"]) if revisit else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, schema)], schema=schema)


def write(pages: DataFrame, path: str) -> None:
    """Write a record for every row of ``pages (page_id, url, html)`` into archives below ``path``.

    Of rows with equal html (null counts as empty) the one with the largest page_id becomes a response, the others revisits
    of it.  Rows that repeat that page_id are responses too; a null page_id is smaller than any other.  Only digests are
    grouped; payloads move once, to the archive they go into.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")) \
        .withColumn("sha", F.unhex(F.sha1(F.encode("html", "UTF-8"))))
    keepers = named.groupBy("sha").agg(F.max("page_id").alias("keeper"))
    response = F.col("page_id").eqNullSafe(F.col("keeper"))
    rows = named.join(keepers, "sha").select(
        "page_id", "url", "html", F.when(response, F.lit("response")).otherwise(F.lit("revisit")).alias("kind"),
        F.when(~response, F.col("keeper")).alias("refers_to"))
    rows.mapInArrow(_archives, "archive binary").select(F.col("archive").cast("string")) \
        .write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 1).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record below ``path``, validated."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read, ROW)


def query(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back.  No pages: no archive, no rows."""
    path = f"{scratch_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write(pages, path)
    return read(pages.sparkSession, path)


SQL = """
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(sha, ((i // 4) * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM (SELECT page_id, h, sha1(h) AS sha, max(page_id) OVER (PARTITION BY h) AS keeper
      FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))
"""
