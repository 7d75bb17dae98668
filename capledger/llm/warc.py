"""WARC archives: writing with de-duplication, reading with segment reassembly.

A page becomes a response record whose HTTP block carries the payload in chunked transfer framing. Blocks
above a size are cut into segments: the first one keeps the record's type, the others are continuation
records that name its id and their number; the last one states the total length. A page whose payload has
been seen with a smaller id becomes a revisit record.

Archives are gzipped WARC files, written and read by Spark's text source, so that they can be of any size and
lie in any file system; each file is one gzip stream. The reader takes a file's pieces between version marks in order
and joins pieces until a record has as many bytes as its Content-Length says, so a mark inside a block does no harm, and
archives of other origin, of version 1.0 or 1.1, are read alike. A record that is cut off, or whose length does not fit,
comes out as damaged; the records behind it are found again. Archives that are not compressed may be split between tasks:
there a record at a split's border comes out as damaged if its block holds a mark. No part of the mark repeats its
beginning, so that it is found across the borders of buffers too.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import urllib.parse
import uuid
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_texts, pick, run_folder, shared_table, slices

VERSION = b"WARC/1.1\r\n"
#: What records of both versions begin with, and how they go on.
MARK, VERSIONS = b"WARC/1.", (b"0\r\n", b"1\r\n")
SEPARATOR = "\r\n\r\n"
DATE = "2025-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 100_000
#: Records that claim to be longer come out as damaged.
LONGEST_RECORD = 512 << 20

_FIELD = re.compile(rb"^([!-9;-~]+):[ \t]*(.*?)[ \t]*$", re.M)


class Damaged(ValueError):
    """A record, its segments or its framing do not fit together."""


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """The same for equal rows, so that a task that runs again names its records alike."""
    name = hashlib.sha256(repr((page_id, url, digest)).encode("utf-8", "surrogatepass")).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=4)}>"


def to_chunks(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing. A version line in the payload is cut in two by a chunk's border."""
    out, at = [], 0
    line = payload.find(VERSION)
    while at < len(payload):
        end = min(at + size, len(payload))
        while 0 <= line < at:
            line = payload.find(VERSION, at)
        if 0 <= line < end:
            end = line + 2
        out.append(b"%x\r\n%s\r\n" % (end - at, payload[at:end]))
        at = end
    return b"".join([*out, b"0\r\n\r\n"])


def from_chunks(body: bytes) -> bytes:
    """The payload of chunked transfer framing; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            raise Damaged("no chunk size")
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise Damaged("a chunk does not end where it should")
        out.append(body[at:at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP block, its transfer framing removed."""
    head, blank, body = block.partition(b"\r\n\r\n")
    if not blank:
        raise Damaged("no end of the HTTP header")
    fields = {k.lower(): v.lower() for k, v in _FIELD.findall(head.replace(b"\r\n", b"\n"))}
    return from_chunks(body) if fields.get(b"transfer-encoding") == b"chunked" else body


def reassemble(segments: list[tuple[int, bytes]], total: int | None) -> bytes:
    """The block of an origin record from its numbered segments; their lengths must add up to the total."""
    segments = sorted(segments, key=lambda s: s[0])
    if [n for n, _ in segments] != list(range(1, len(segments) + 1)):
        raise Damaged("segments missing or repeated")
    block = b"".join(b for _, b in segments)
    if total is None or len(block) != total:
        raise Damaged(f"{len(block)} bytes of {total}")
    return block


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", len(block))] if value is not None]
    return VERSION + "".join(lines).encode() + b"\r\n" + block


def records_of(
    page_id: int | None, url: str | None, payload: bytes, first: tuple[int, str | None] | None,
    segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
) -> list[bytes]:
    """The records of one page, without the separator behind them. ``first`` is the page it revisits."""
    digest = base32_sha1(payload)
    own = record_id(page_id, url, digest)
    uri = None if url is None else urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    if uri:
        uri = uri.replace("WARC/1.1", "WARC/1%2E1")  # no field ends in a version line
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri or None), ("Content-Type", "application/http; msgtype=response")]
    named = [("WARC-Record-ID", own), ("X-Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if first is not None:
        refers = [("WARC-Refers-To", record_id(*first, digest)), ("WARC-Profile", PROFILE)]
        return [_record([("WARC-Type", "revisit"), *named, *common, *refers], b"HTTP/1.1 200 OK\r\n\r\n")]
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
        + to_chunks(payload, chunk_bytes)
    )
    if len(block) <= segment_bytes:
        return [_record([("WARC-Type", "response"), *named, *common], block)]
    parts = [block[a:a + segment_bytes] for a in range(0, len(block), segment_bytes)]
    out = [_record([("WARC-Type", "response"), *named, *common, ("WARC-Segment-Number", 1)], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        total = len(block) if number == len(parts) else None
        out.append(_record([
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}-{number}>"), ("WARC-Date", DATE),
            ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", total),
        ], part))
    return out


def write(
    pages: DataFrame, path: str, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) into gzipped archives below ``path``.

    The payload is the html in UTF-8; null counts as empty. Of rows with equal payloads of at least
    ``min_bytes`` bytes those with the smallest page_id are responses and the others revisit it. Rows without
    a page_id are always responses. Repeated rows are kept; other columns are left out.
    """
    rows = pick(pages, ("page_id", "long"), ("url", "string"), ("html", "string")).withColumn(
        "payload", F.coalesce(F.col("html"), F.lit("")).cast("binary")
    ).drop("html").withColumn("digest", F.sha1("payload"))
    firsts = (
        rows.where(F.col("page_id").isNotNull() & (F.length("payload") >= min_bytes))
        .groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("first"))
    )
    decided = rows.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", (F.col("first.page_id") < F.col("page_id")).alias("revisits"),
        F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
    )

    def run(batches):
        for batch in batches:
            for part in slices(batch, 256):
                page_ids, urls, payloads, revisits, ids, first_urls = (c.to_pylist() for c in part.columns)
                out = []
                for i, payload in enumerate(payloads):
                    first = (ids[i], first_urls[i]) if revisits[i] else None
                    out += records_of(page_ids[i], urls[i], payload, first, segment_bytes, chunk_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    (
        decided.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR).option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file).text(path)
    )


PARSED = (
    "record_id string, page_id long, record_type string, refers_to string, number int, total long, digest string, "
    "block binary, payload_bytes long, payload_digest string, intact boolean, payload binary"
)


def fields_of(head: bytes) -> dict[bytes, str]:
    """Names in lower case and values of a header; of a repeated name the last."""
    return {k.lower(): v.decode("utf-8", "replace") for k, v in _FIELD.findall(head.replace(b"\r\n", b"\n"))}


def missing(piece: bytes) -> int:
    """How many bytes a record lacks: 0 if none, -1 if that cannot be said, at least one if its header has no end."""
    head, blank, rest = piece.partition(b"\r\n\r\n")
    if not blank:
        return 1
    length = fields_of(head).get(b"content-length", "")
    if not length.isdigit() or int(length) > LONGEST_RECORD:
        return -1
    return max(0, int(length) - len(rest))


def joined(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The records of one file from its pieces between marks, without the mark before each.

    Pieces are joined while a record lacks bytes. If the file ends before that, or the record would end in the midst of a
    piece, its first piece stands alone and the others are looked at again.
    """
    waiting = deque()
    pieces = iter(pieces)
    while True:
        first = waiting.popleft() if waiting else next(pieces, None)
        if first is None:
            return
        lacking = missing(first) if first.startswith(VERSIONS) else 0
        if lacking <= 0:
            yield first
            continue
        record, at = bytearray(first), 0
        while lacking > 0 and len(record) <= LONGEST_RECORD:
            more = waiting[at] if at < len(waiting) else next(pieces, None)
            if more is None:
                break
            if at == len(waiting):
                waiting.append(more)
            at += 1
            headless = b"\r\n\r\n" not in record
            record += MARK + more
            lacking = missing(bytes(record)) if headless else lacking - len(MARK) - len(more)
        # What is too much can only be the line ends behind the block.
        whole = lacking <= 0 and record[len(record) + lacking:].strip(b"\r\n") == b"" and -lacking <= len(SEPARATOR)
        if whole:
            for _ in range(at):
                waiting.popleft()
        yield bytes(record) if whole else first


def parse(value: bytes, payloads: bool) -> tuple:
    """One record without the mark before it, as in PARSED. A segment keeps its block; its payload is left for later."""
    head, _, rest = value.partition(b"\r\n\r\n")
    fields = fields_of(head)
    length = int(fields[b"content-length"]) if fields.get(b"content-length", "").isdigit() else -1
    block = rest[:length] if length >= 0 else b""
    complete = value.startswith(VERSIONS) and 0 <= length <= len(rest) and rest[length:].strip(b"\r\n") == b""
    kind, page = fields.get(b"warc-type"), fields.get(b"x-page-id")
    digest = fields.get(b"warc-payload-digest", "").removeprefix("sha1:") or None
    number, total = fields.get(b"warc-segment-number"), fields.get(b"warc-segment-total-length")
    named = (
        fields.get(b"warc-segment-origin-id") or fields.get(b"warc-record-id"), _number(page), kind or "unknown",
        fields.get(b"warc-refers-to"), _number(number), _number(total), digest,
    )
    if _number(number) is not None:
        return *named, block, None, None, complete, None
    if kind != "response":
        return *named, None, None, digest, complete, None
    return *named, None, *_payload(block, digest, complete, payloads)


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch(r"-?[0-9]{1,18}", text) else None


def _payload(block: bytes, digest: str | None, complete: bool, payloads: bool) -> tuple:
    try:
        payload = payload_of(block)
    except Damaged:
        return None, None, False, None
    found = base32_sha1(payload)
    return len(payload), found, complete and digest in (None, found), payload if payloads else None


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The responses and revisits below ``path``: page_id, record_type, payload_bytes, payload_digest, refers_to, intact, payload.

    Records of other kinds are left out if they are intact; a damaged one is told, as of its kind or ``unknown``.

    Segments are grouped by their origin's id, ordered by number and checked against the total length; then
    the transfer framing is removed. Revisits take the length of the record they refer to and name its page.
    Damaged records come with ``intact`` false and no length. Equal records, as repeated rows make them, each
    count. Without ``payloads`` that column is null.
    """
    def run(batches):
        schema = pa.schema([
            ("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.string()),
            ("number", pa.int32()), ("total", pa.int64()), ("digest", pa.string()), ("block", pa.binary()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_()), ("payload", pa.binary()),
        ])
        def pieces():
            """(file, piece), in order; what stands before the first mark of a file is no record unless it holds something."""
            for batch in batches:
                for part in slices(batch, 256):
                    yield from zip(part.column(1).to_pylist(), byte_texts(part.column(0)), strict=True)

        def rows(found):
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema,
            )

        found, held = [], 0
        for _, own in itertools.groupby(pieces(), key=lambda p: p[0]):
            for record in joined(piece for _, piece in own):
                if record.strip():
                    found.append(parse(record, payloads))
                    held += len(record)
                if held > 4 << 20 or len(found) >= 256:
                    yield rows(found)
                    found, held = [], 0
        if found:
            yield rows(found)

    fragments = spark.read.option("lineSep", MARK.decode()).text(path).select(
        F.col("value").cast("binary"), F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("file"),
    )
    parsed = shared_table(fragments.mapInArrow(run, PARSED), "records")
    result = ("page_id", "record_type", "payload_bytes", "payload_digest", "intact", "payload")

    # Equal segments of repeated rows are counted before a record's segments are brought together.
    segment = parsed.where("number IS NOT NULL").groupBy("record_id", "number", F.sha1("block").alias("content")).agg(
        F.count("*").alias("copies"), F.first("block").alias("block"), F.first("total", True).alias("total"),
        F.first("page_id", True).alias("page_id"), F.first("digest", True).alias("digest"), F.min("intact").alias("intact"),
    )
    origins = segment.groupBy("record_id").agg(
        F.collect_list(F.struct("number", "block")).alias("segments"), F.first("total", True).alias("total"),
        F.first("page_id", True).alias("page_id"), F.first("digest", True).alias("digest"), F.min("intact").alias("intact"),
        F.min("copies").alias("copies"),
    )

    def join_up(batches):
        for batch in batches:
            for row in batch.to_pylist():
                segments = [(s["number"], s["block"]) for s in row["segments"]]
                try:
                    found = _payload(reassemble(segments, row["total"]), row["digest"], row["intact"], payloads)
                except Damaged:
                    found = (None, None, False, None)
                yield pa.RecordBatch.from_pylist([{
                    "record_id": row["record_id"], "page_id": row["page_id"], "record_type": "response",
                    "payload_bytes": found[0], "payload_digest": found[1] or row["digest"], "intact": found[2],
                    "payload": found[3], "copies": row["copies"],
                }], schema=pa.schema([
                    ("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_()),
                    ("payload", pa.binary()), ("copies", pa.int64()),
                ]))

    long_ones = origins.mapInArrow(
        join_up, "record_id string, page_id long, record_type string, payload_bytes long, payload_digest string, "
                 "intact boolean, payload binary, copies long",
    )
    responses = parsed.where("record_type = 'response' AND number IS NULL").select("record_id", *result).union(
        long_ones.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("record_id", *result)
    )
    known = responses.groupBy("record_id").agg(
        F.min("page_id").alias("origin_page"), F.min("payload_bytes").alias("origin_bytes"),
        F.min("payload_digest").alias("origin_digest"), F.min("intact").alias("origin_intact"),
    )
    revisits = parsed.where("record_type = 'revisit'").drop("record_id", "payload_bytes").join(
        known, F.col("refers_to") == F.col("record_id"), "left"
    )
    broken = parsed.where("NOT intact AND number IS NULL AND record_type NOT IN ('response', 'revisit')")
    responses = responses.select(*result).union(broken.select(*result))
    return responses.select(*result, F.lit(None).cast("long").alias("refers_to")).union(revisits.select(
        "page_id", "record_type", F.col("origin_bytes"), "payload_digest",
        F.col("intact") & F.coalesce(F.col("origin_intact") & (F.col("payload_digest") == F.col("origin_digest")), F.lit(False)),
        "payload", F.col("origin_page"),
    ))


def round_trip(pages: DataFrame) -> DataFrame:
    """The pages written to archives in the run's folder and read back."""
    spark = pages.sparkSession
    path = f"{run_folder(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path)
    return read(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact",
    )
