"""WARC archives with a Zstandard dictionary.

Each archive begins with a skippable frame that holds a dictionary built from its own records;
behind it every record is a frame of its own, compressed with that dictionary. So an archive needs
no other file, and one record can be read alone from its offset.

Records with equal payloads (by length and SHA-1) of at least REVISIT bytes are stored once: the
page with the largest page_id is the response, the others revisit it and keep only their headers.
Payloads move once, to meet the record that they may revisit; the hash of the payload decides where,
and a payload that very many pages share is split over tasks by adaptive execution.

Archives hold about ARCHIVE_BYTES of records. Rows are written in a fixed order within a task and
moved into place under fixed names, so a task that runs again writes the same archives.

Defined cases. Null html: an empty payload. Null url: a record without a target. Null page_id: never
the response of a group that has another; kept as null. Rows with the same page_id and payload are
all responses if it is the largest. An empty table gives no archive and no rows. A very long payload makes a larger
archive. Other columns are not read. The table has no time of retrieval, so every record carries the date given, which
is the first day of 1970 unless another is.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.files import write_file
from stratiform.llm.tables import in_arrow, table
from stratiform.session import scratch_dir

REVISIT = 1000
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20
LEVEL = 3
#: Of the format: the skippable frame that may lead an archive, and its size field.
SKIPPABLE = 0x184D2A5D
FRAME = struct.Struct("<II")
DATE = "1970-01-01T00:00:00Z"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}>"


def record(page: dict, date: str = DATE) -> bytes:
    """One WARC record: an HTTP response, or a revisit with its headers only."""
    payload = (page["html"] or "").encode()
    digest = page["digest"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = page["refers_to"] is not None
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page['page_id'], digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page["url"] is not None:
        lines.insert(3, f"WARC-Target-URI: {quote(page['url'], safe='%/:?#[]@!$&()*+,;=~')}")
    if revisit:
        lines.insert(2, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.insert(3, f"WARC-Refers-To: {_record_id(page['refers_to'], digest)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> bytes:
    """A dictionary for records like these, from SAMPLE_BYTES of them spread evenly; the beginning of
    the records themselves where they are too few to train one."""
    step = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    sample = [x[: 64 << 10] for x in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[-DICTIONARY_BYTES:]


def archive(records: list[bytes], level: int = LEVEL) -> bytes:
    """A whole archive file."""
    words = dictionary(records)
    press = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(words))
    return b"".join([FRAME.pack(SKIPPABLE, len(words)), words, *map(press.compress, records)])


def records_of(content: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive."""
    content = memoryview(content)
    magic, size = FRAME.unpack_from(content)
    if magic != SKIPPABLE:
        raise ValueError("the archive has no leading dictionary")
    words = zstandard.ZstdCompressionDict(content[FRAME.size : FRAME.size + size].tobytes())
    reader = zstandard.ZstdDecompressor(dict_data=words).stream_reader(content[FRAME.size + size :], read_across_frames=True)
    plain = reader.read()
    at = 0
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        version, *lines = plain[at:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError("the archive is damaged")
        headers = dict(line.split(": ", 1) for line in lines)
        begin, at = end + 4, end + 4 + int(headers["Content-Length"])
        yield headers, plain[begin:at]
        at += 4


def _writer(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size, count = TaskContext.get().partitionId(), [], 0, 0

        def flush() -> pa.RecordBatch:
            name = f"part-{number:08d}-{count:06d}.warc.zst"
            write_file(f"{folder}/{name}", archive(held))
            return pa.record_batch([[name], [len(held)]], names=["name", "records"])

        for batch in batches:
            for i in range(batch.num_rows):
                held.append(record(batch.slice(i, 1).to_pylist()[0]))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    held, size, count = [], 0, count + 1
        if held:
            yield flush()

    return run


def _page_of(record_id: str) -> int | None:
    number = record_id.split(":")[2]
    return int(number) if number else None


def _reader(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for headers, block in records_of(content.as_buffer()):
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.rpartition(b"Content-Length: ")[2])
                digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                kind = headers["WARC-Type"]
                if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
                refers = _page_of(headers["WARC-Refers-To"]) if kind == "revisit" else None
                rows.append((_page_of(headers["WARC-Record-ID"]), size, digest, kind, refers))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def write_archives(pages: DataFrame, folder: str, revisit: int = REVISIT) -> int:
    """Archives of all rows of ``pages`` (page_id, url, html); returns the number of records."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").select(
        "*", F.octet_length(payload).cast("long").alias("size"), F.sha1(payload).alias("digest")
    )
    large = rows.filter(F.col("size") >= revisit).groupBy("digest", "size")
    firsts = large.agg(F.max("page_id").alias("response"), F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    again = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    joined = rows.join(firsts, ["digest", "size"], "left").select(
        "page_id", "url", "html", "digest", F.when(again, F.col("response")).alias("refers_to")
    )
    ordered = joined.sortWithinPartitions("page_id", "digest", "url")
    written = in_arrow(ordered, _writer(folder), "name string, records long")
    return written.agg(F.sum("records")).first()[0] or 0


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of a folder."""
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return in_arrow(whole, _reader, schema)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    if not write_archives(table(spark, sf_dir, "pages"), folder):
        schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
        return spark.createDataFrame([], schema)
    return read_archives(spark, folder)
