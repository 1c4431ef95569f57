"""WARC archives whose records are compressed one by one with an embedded Zstandard dictionary."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clustertrace.llm.shared import give_back, stored

#: Fixed values of the formats: the magic numbers of the dictionary's frame and of a frame to skip.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50
ZSTD_MAGIC = 0xFD2FB528

#: A frame of one byte to skip; the byte is the line feed that Spark's text writer adds to a row.
_LINE_END = SKIPPABLE_MAGIC.to_bytes(4, "little") + (1).to_bytes(4, "little")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_FIELD = re.compile(r"[\x00-\x20\x7f]+")


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(key: object) -> str:
    return f"<urn:page:{key}>"


def record(key: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One record: a response with its payload, or a revisit with the headers only."""
    body = _HTTP if revisit else _HTTP + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(key)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(body))),
    ]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", _FIELD.sub(lambda m: "".join(f"%{ord(c):02X}" for c in m[0]), url)))
    if revisit:
        fields.insert(3, ("WARC-Refers-To", _urn(refers_to)))
        fields.insert(4, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"

#: Bytes of an archive that are looked at at once.
_STEP = 8192


def train_dictionary(records: list[bytes], size: int) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of at most ``size`` bytes from some records, None where they are too few or too alike."""
    total = sum(map(len, records))
    if len(records) < 8 or total < 8 * 1024:
        return None
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 16)), records)
    except zstandard.ZstdError:
        return None


def archive(records: Iterable[bytes], dictionary_size: int, sample_bytes: int, level: int = 3) -> Iterator[bytes]:
    """The chunks of one archive: the dictionary's frame, if there is one, and a frame per record.

    The dictionary is built from the archive's first records, ``sample_bytes`` of them together,
    which are held back meanwhile; nothing else is.
    """
    source = iter(records)
    first, held = [], 0
    for item in source:
        first.append(item)
        held += len(item)
        if held >= sample_bytes:
            break
    if not first:
        return
    dictionary = train_dictionary(first, dictionary_size)
    if dictionary is not None:
        data = dictionary.as_bytes()
        yield DICTIONARY_MAGIC.to_bytes(4, "little") + len(data).to_bytes(4, "little") + data
        compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
    else:
        compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
    for item in first:
        yield compressor.compress(item)
    first.clear()
    for item in source:
        yield compressor.compress(item)


def read_archive(data: bytes | memoryview) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    view = memoryview(data)
    at, decompressor = 0, zstandard.ZstdDecompressor()
    while at < len(view):
        magic = int.from_bytes(view[at : at + 4], "little")
        if magic == ZSTD_MAGIC:
            # In small steps, as what lies behind the frame is copied with the last of them.
            frame, parts = decompressor.decompressobj(), []
            while not frame.eof:
                if at >= len(view):
                    raise ValueError("the archive ends within a frame")
                parts.append(frame.decompress(view[at : at + _STEP]))
                at += min(_STEP, len(view) - at)
            at -= len(frame.unused_data)
            yield b"".join(parts)
        elif magic & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
            size = int.from_bytes(view[at + 4 : at + 8], "little")
            if magic == DICTIONARY_MAGIC:
                known = zstandard.ZstdCompressionDict(bytes(view[at + 8 : at + 8 + size]))
                decompressor = zstandard.ZstdDecompressor(dict_data=known)
            at += 8 + size
        else:
            raise ValueError(f"no frame at byte {at}")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """The named fields of a record and its payload; a revisit's payload is empty."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    dictionary_size: int = 65_536,
    sample_bytes: int = 4_000_000,
    archive_bytes: int = 32_000_000,
) -> None:
    """Writes archives into the folder ``path``, with a record per page.

    A partition begins a new archive, with a dictionary of its own, when the records of the one before have
    ``archive_bytes`` together; only a longer record makes a larger one.

    The payload is the text of ``payload_col`` in UTF-8, empty for NULL. Of equal payloads of at
    least ``least_bytes`` bytes, the record with the smallest id is the response, and the others are
    revisits that refer to it and hold no payload; of shorter payloads all are responses. Rows that
    repeat the smallest id are all responses; a row without an id is a response only if no equal
    payload has one.

    Equal payloads are found by SHA-256 and length in a grouping with a map-side part; the groups are
    written first and joined back, so Spark can split a hot one. Archives go through Spark's text
    writer, to any folder that Spark can write; the line feeds that it adds lie in frames that
    readers skip. A task holds one archive, the records that train its dictionary and one more. An
    empty table gives a folder without records; a text of any length is one record.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload")
    ).withColumn("sha", F.sha2("payload", 256))
    same = rows.filter(F.length("payload") >= least_bytes).groupBy("sha").agg(F.min("id").alias("first"))
    rows = rows.join(stored(same, "payloads"), "sha", "left").select("id", "url", "payload", "first")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            for k in range(len(batch)):
                key, url, data, first = (batch.column(c)[k].as_py() for c in range(4))
                revisit = first is not None and first != key
                yield record(key, url, data, first, revisit)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = records(batches)

        def some(first: bytes) -> Iterator[bytes]:
            held = len(first)
            yield first
            while held < archive_bytes and (item := next(source, None)) is not None:
                held += len(item)
                yield item

        for first in source:
            whole = b"".join([*archive(some(first), dictionary_size, sample_bytes), _LINE_END])
            yield pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], names=["archive"])
            del whole
        give_back()

    archives = rows.mapInArrow(write, "archive binary").select(F.col("archive").cast("string"))
    archives.write.option("compression", "none").option("maxRecordsPerFile", 1).text(path)


def read_archives(pages_path: str, spark) -> DataFrame:
    """Per record of the archives in a folder: ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``, ``url`` and ``payload`` (NULL for revisits).

    Size and digest of a response are taken from the payload as read, and a digest that differs from
    the record's own raises an error; those of a revisit are its record's.
    """
    files = spark.read.format("binaryFile").load(pages_path).select("content")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def key(urn: str | None) -> int | None:
        value = urn[len("<urn:page:") : -1] if urn else "None"
        return None if value == "None" else int(value)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for value in batch.column(0):
                rows, held = [], 0
                for data in read_archive(value.as_buffer()):
                    fields, payload = parse_record(data)
                    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = fields["WARC-Type"] == "revisit"
                    if not revisit and said != payload_digest(payload):
                        raise ValueError(f"{fields['WARC-Record-ID']}: the payload isn't what was written")
                    rows.append(
                        (
                            key(fields["WARC-Record-ID"]),
                            int(fields["X-Payload-Length"]) if revisit else len(payload),
                            said,
                            fields["WARC-Type"],
                            key(fields.get("WARC-Refers-To")),
                            fields.get("WARC-Target-URI"),
                            None if revisit else payload,
                        )
                    )
                    held += len(payload)
                    if held > 8_000_000:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, payload binary"
    return files.mapInArrow(read, schema)
