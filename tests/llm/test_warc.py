import base64
import hashlib
import random
import time
import uuid

import pytest
import zstandard

from clustertrace.llm.queries import op9_warc
from clustertrace.llm.shared import shared_dir
from clustertrace.llm.warc import archive, parse_record, read_archive, read_archives, record, write_archives

SCHEMA = "page_id bigint, url string, html string, payload string, first int"
BIG = "<p>é long page</p>" * 40_000
PAGES = [
    (5, "http://a.net/\r\nX-Evil: 1", "same", "x", 0), (3, None, "same", "x", 0), (9, "u", "same", "x", 0),
    (1, "u", None, None, None), (2, "u", "", "x", 0), (4, "", BIG, "x", 0), (6, "é 日本", BIG, "x", 0),
    (None, "u", "same", "x", 0), (None, "u", "alone", "x", 0), (7, "u", "a\r\n\r\nb\x00", "x", 0), (8, "u", "WARC/1.1\r\n", "x", 0),
]


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute(rows, least=0):
    out = []
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        ids = [j for j, _, h, *_ in rows if (h or "") == (html or "") and j is not None]
        first = min(ids) if ids and len(data) >= least else None
        revisit = first is not None and first != i
        out.append((i, len(data), digest(data), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def round_trip(spark, frame, **options):
    path = f"{shared_dir(spark)}/archives-{uuid.uuid4().hex}"
    write_archives(frame, path, **options)
    return path, read_archives(path, spark)


@pytest.mark.parametrize("least", [0, 3, 10_000])
def test_odd_pages(spark, least):
    _, read = round_trip(spark, spark.createDataFrame(PAGES, SCHEMA).repartition(3), least_bytes=least)
    rows = read.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == brute(PAGES, least)
    texts = {i: h or "" for i, _, h, *_ in PAGES}
    for r in rows:
        if r["record_type"] == "response" and r["page_id"] is not None:
            assert bytes(r["payload"]).decode() == texts[r["page_id"]]


def test_archives_are_cut_and_read_back(spark):
    rows = [(k, f"http://a/{k}", f"<p>page {k}</p>" * (k % 40), "x", 1) for k in range(400)]
    path, read = round_trip(spark, spark.createDataFrame(rows, SCHEMA).coalesce(2), archive_bytes=20_000)
    assert sorted((tuple(r)[:5] for r in read.collect()), key=repr) == brute(rows)
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("content").collect()
    assert len(files) > 8
    assert sum(len(list(read_archive(bytes(f["content"])))) for f in files) == 400


def test_reading_takes_time_in_proportion():
    rng = random.Random(4)
    records = [record(k, f"http://a/{k}", rng.randbytes(600), k, False) for k in range(16_000)]
    seconds = []
    for n in (1_000, 16_000):
        data = b"".join(archive(records[:n], 4096, 100_000))
        start = time.perf_counter()
        assert sum(1 for _ in read_archive(data)) == n
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 16 * 5 * seconds[0]


def test_cut_archive_raises():
    data = b"".join(archive([record(1, "http://a", b"x" * 500, 1, False)], 4096, 10))
    with pytest.raises(ValueError, match="ends within"):
        list(read_archive(data[:-5]))


def test_without_pages(spark):
    frame = spark.createDataFrame(PAGES, SCHEMA).filter("page_id = -1")
    assert round_trip(spark, frame)[1].collect() == []


def test_pages_and_files(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    rows = [tuple(r) for r in pages.collect()]
    path, read = round_trip(spark, pages)
    found = read.collect()
    assert sorted((tuple(r)[:5] for r in found), key=repr) == brute(rows)
    assert {r["page_id"]: (r["url"], bytes(r["payload"]).decode()) for r in found} == {i: (u, h) for i, u, h in rows}
    result = op9_warc(spark, sf_dir)
    assert result.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    for [content] in spark.read.format("binaryFile").load(path).select("content").collect():
        data = bytes(content)
        assert data[:4] == (0x184D2A5D).to_bytes(4, "little")  # the dictionary leads
        plain = b"".join(read_archive(data))
        assert plain.count(b"WARC/1.1\r\nWARC-Type: ") <= len(rows) and len(data) < len(plain)


def test_any_reader_with_the_dictionary_can_read_a_record():
    records = [record(k, f"http://a.net/{k}", b"<p>some page with number %d</p>" % k * 9) for k in range(200)]
    chunks = list(archive(records, 4096, 1_000_000))
    size = int.from_bytes(chunks[0][4:8], "little")
    known = zstandard.ZstdCompressionDict(chunks[0][8 : 8 + size])
    assert [zstandard.ZstdDecompressor(dict_data=known).decompress(c) for c in chunks[1:]] == records
    assert list(read_archive(b"".join(chunks))) == records
    assert sum(map(len, chunks[1:])) < sum(len(zstandard.compress(r)) for r in records)


def test_few_records_need_no_dictionary():
    records = [record(1, None, b""), record(2, "u", b"", 1, True)]
    assert list(read_archive(b"".join(archive(records, 4096, 10)))) == records
    fields, payload = parse_record(records[1])
    assert (fields["WARC-Type"], fields["WARC-Refers-To"], payload) == ("revisit", "<urn:page:1>", b"")
    assert list(archive([], 4096, 10)) == []
    with pytest.raises(ValueError):
        list(read_archive(b"no frame here"))
