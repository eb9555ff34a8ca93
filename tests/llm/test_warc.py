from __future__ import annotations

import hashlib
from collections import Counter

import pytest
import zstandard

from stratiform.llm import warc
from stratiform.llm.warc import FRAME, SKIPPABLE, archive, read_archives, record, records_of, write_archives
from stratiform.session import scratch_dir

BIG = "<html>" + "text é " * 300 + "</html>"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, digest string, size int")


@pytest.mark.parametrize("bytes_", [16 << 20, 3000])
def test_round_trip(spark, monkeypatch, bytes_):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", bytes_)
    rows = [(k, f"http://x/{k}", BIG) for k in range(9)] + [(20 + k, "http://y", f"<p>{k}</p>") for k in range(5)]
    rows += [(30, None, None), (31, "http://a b\nc", ""), (32, "u", "small"), (33, "u", "small"), (None, "u", BIG), (8, "u", BIG), (40, "u", BIG + "!")]
    folder = scratch_dir(spark, "warc")
    assert write_archives(pages(spark, rows), folder) == len(rows)
    found = Counter(tuple(x) for x in read_archives(spark, folder).collect())
    expected = Counter()
    for page_id, _, html in rows:
        payload = (html or "").encode()
        again = html == BIG and page_id != 8
        expected[page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", 8 if again else None] += 1
    assert found == expected


def test_group_without_ids_and_empty_table(spark):
    folder = scratch_dir(spark, "warc")
    assert write_archives(pages(spark, [(None, "u", BIG), (None, "u", BIG)]), folder) == 2
    assert {x["record_type"] for x in read_archives(spark, folder).collect()} == {"response"}
    assert write_archives(pages(spark, []), scratch_dir(spark, "warc")) == 0


def test_archive_layout():
    page = {"page_id": 7, "url": "http://x/ä", "html": BIG, "digest": hashlib.sha1(BIG.encode()).hexdigest(), "refers_to": None}
    content = archive([record(page | {"page_id": k}) for k in range(50)])
    magic, size = FRAME.unpack_from(content)
    assert magic == SKIPPABLE
    words = zstandard.ZstdCompressionDict(content[FRAME.size : FRAME.size + size])
    one = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
    first = one.decompress(content[FRAME.size + size :])
    assert first.startswith(b"WARC/1.1\r\n") and first.count(b"WARC/1.1") == 1 and one.unused_data
    headers = [h for h, _ in records_of(content)]
    assert len(headers) == 50 and headers[3]["WARC-Record-ID"].startswith("<urn:x-page:3:")
    assert len(content) < sum(len(record(page)) for _ in range(50)) / 10


def test_damage_is_noticed():
    page = {"page_id": 7, "url": "u", "html": BIG, "digest": "0" * 40, "refers_to": None}
    with pytest.raises(ValueError, match="dictionary"):
        list(records_of(b"\x00" * 32))
    assert len(list(records_of(archive([record(page)])))) == 1
