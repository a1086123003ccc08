"""WARC archives of pages: written in segments, read back by putting the segments together.

A page is an HTTP response with chunked transfer framing. A block above ``segment_bytes`` is split: the first segment
is the response record, the others are continuation records that name their origin and their number, and the last one
states the total length. Of pages with equal payloads of at least ``min_bytes`` bytes one is stored and the others
refer to it as revisits; whole payloads are compared by their SHA-1.

Records go through Spark's text writer, whose line separator ends each record, as gzip files of a bounded number of
records, and come back through its binary file reader. Only records that were split are shuffled by their origin.

Defined results: a null html counts as an empty payload; a null ``page_id`` is kept, and is a revisit of an equal page
that has an id, or else a response; a row that repeats page and payload is one more equal record; other columns are
left out. A segment that is missing, or a total length that does not match, is an error that names the record; so is
chunked framing that does not end.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardrail.llm.common import written

RECORD_END = "\r\n\r\n"
RECORDS_PER_FILE = 10_000
CHUNK_BYTES = 8_192
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class ArchiveError(ValueError):
    """An archive that cannot be read whole."""


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def to_chunks(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = (payload[i : i + size] for i in range(0, len(payload), size))
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def from_chunks(framed: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        try:
            size = int(framed[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0 or end + 2 + size > len(framed):
            raise ArchiveError("chunked framing is broken")
        if size == 0:
            return b"".join(out)
        out.append(framed[end + 2 : end + 2 + size])
        at = end + 2 + size
        if framed[at : at + 2] != b"\r\n":
            raise ArchiveError("chunked framing is broken")
        at += 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return from_chunks(body) if b"transfer-encoding: chunked" in head.lower() else body


def record(fields: dict[str, object], block: bytes) -> bytes:
    """A record without the separator that ends it."""
    head = "".join(f"{k}: {v}\r\n" for k, v in (fields | {"Content-Length": len(block)}).items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def records_of(page_id, url, html: str | None, digest: str, refers_to, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page: a revisit, a response, or a response and its continuations."""
    url = "".join(c if c > " " else "%{:02X}".format(ord(c)) for c in url or "about:blank")
    name = f"<urn:page:{page_id}:{digest}>"
    fields = {"WARC-Type": "response", "WARC-Record-ID": name, "WARC-Target-URI": url, "WARC-Date": "1970-01-01T00:00:00Z"}
    fields |= {"Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{digest}"}
    if refers_to is not None:
        refers = {"WARC-Type": "revisit", "WARC-Refers-To": f"<urn:page:{refers_to}:{digest}>", "WARC-Profile": REVISIT_PROFILE}
        yield record(fields | refers, HTTP_HEAD)
        return
    block = HTTP_HEAD + to_chunks((html or "").encode())
    if len(block) <= segment_bytes:
        yield record(fields, block)
        return
    yield record(fields | {"WARC-Segment-Number": 1}, block[:segment_bytes])
    for number, at in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
        more = {"WARC-Type": "continuation", "WARC-Segment-Origin-ID": name, "WARC-Segment-Number": number}
        more |= {"WARC-Record-ID": f"<urn:page:{page_id}:{digest}:{number}>", "WARC-Date": fields["WARC-Date"]}
        if at + segment_bytes >= len(block):
            more["WARC-Segment-Total-Length"] = len(block)
        yield record(more, block[at : at + segment_bytes])


def write_archives(pages: DataFrame, path: str, segment_bytes: int = 1 << 20, min_bytes: int = 0) -> None:
    """Writes a record for each page below ``path``.

    Equal payloads meet by their digest: a first shuffle carries a digest and an id per page, added up before it; the
    second deals out the pages by digest, and adaptive execution splits a digest that many pages share.
    """

    def run(batches):
        for batch in batches:
            names = ("page_id", "url", "html", "sha1", "refers_to")
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                page_id, url, html, sha1, refers_to = row
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                parts = list(records_of(page_id, url, html, digest, refers_to, segment_bytes))
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["record"])

    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html).alias("sha1"))
    stored = rows.groupBy("sha1").agg(F.max("page_id").alias("stored_id"))
    again = (F.octet_length("html") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("stored_id"))
    rows = rows.join(stored, "sha1").withColumn("refers_to", F.when(again, F.col("stored_id")))
    records = rows.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    writer = records.write.option("lineSep", RECORD_END).option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.option("compression", "gzip").text(path)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The fields (names in lower case) and the block of every record of an archive, plain or gzipped."""
    if archive[:2] == b"\x1f\x8b":
        out, rest = [], archive
        while rest:  # one gzip member after another
            member = zlib.decompressobj(31)
            out.append(member.decompress(rest))
            if not member.eof:
                raise ArchiveError("the archive ends inside a gzip member")
            rest = member.unused_data
        archive = b"".join(out)
    file = io.BytesIO(archive)
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ArchiveError(f"no record starts with {line[:40]!r}")
        fields = {}
        while (line := file.readline()) and line.strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = file.read(length)
        if len(block) != length:
            raise ArchiveError(f"{fields['warc-record-id']}: the block ends after {len(block)} of {length} bytes")
        yield fields, block


def reassemble(name: str, segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """The block of a record from its segments: number, total length if it is the last, and bytes."""
    segments = sorted(segments, key=lambda s: s[0])
    total = segments[-1][1]
    if [s[0] for s in segments] != list(range(1, len(segments) + 1)) or total is None:
        raise ArchiveError(f"{name}: segments {[s[0] for s in segments]} are not the whole record")
    block = b"".join(s[2] for s in segments)
    if len(block) != total:
        raise ArchiveError(f"{name}: {len(block)} bytes; the last segment says {total}")
    return block


def _page(name: str) -> tuple[int | None, str]:
    _, _, page_id, digest = name.strip("<>").split(":")[:4]
    return (None if page_id == "None" else int(page_id)), digest


def _row(fields: dict[str, str], block: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload"""
    page_id, digest = _page(fields["warc-record-id"])
    url = fields.get("warc-target-uri")
    if fields["warc-type"] == "revisit":
        return page_id, url, None, digest, "revisit", _page(fields["warc-refers-to"])[0], None
    payload = payload_of(block)
    found = bare_digest(payload)
    if fields.get("warc-payload-digest") != f"sha1:{found}":
        raise ArchiveError(f"{fields['warc-record-id']}: the payload's digest is {found}")
    return page_id, url, len(payload), found, "response", None, payload


ROW_NAMES = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
ROW_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
SEGMENT_SCHEMA = "origin string, number int, total long, head string, block binary"


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every response and revisit record below ``path``, with the payload itself if ``payloads``."""
    schema = ROW_SCHEMA + (", payload binary" if payloads else "")
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    width = len(kinds) if payloads else len(kinds) - 1

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], kinds[i]) for i in range(width)]
        return pa.RecordBatch.from_arrays(columns, ROW_NAMES[:width])

    def whole(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = [
                    _row(f, b)[:width]
                    for f, b in parse(content.as_py())
                    if f["warc-type"] in ("response", "revisit") and "warc-segment-number" not in f
                ]
                yield batch_of(rows)

    def split(batches):
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
        names = ["origin", "number", "total", "head", "block"]
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for f, b in parse(content.as_py()):
                    if "warc-segment-number" in f:
                        origin = f.get("warc-segment-origin-id", f["warc-record-id"])
                        total = f.get("warc-segment-total-length")
                        head = None if "warc-segment-origin-id" in f else "\n".join(f"{k}: {v}" for k, v in f.items())
                        rows.append((origin, int(f["warc-segment-number"]), total and int(total), head, b))
                columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

    def together(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        copies = sum(r["number"] == 1 for r in rows)
        one = {(r["number"], r["total"], r["block"]) for r in rows}
        head = next((r["head"] for r in rows if r["head"]), None)
        if head is None or len(one) * copies != len(rows):
            raise ArchiveError(f"{rows[0]['origin']}: segments are missing")
        fields = dict(line.split(": ", 1) for line in head.split("\n"))
        row = _row(fields, reassemble(rows[0]["origin"], list(one)))[:width]
        return pa.Table.from_batches([batch_of([row] * copies)])

    files = spark.read.format("binaryFile").load(path).select("content")
    segments = files.mapInArrow(split, SEGMENT_SCHEMA)
    return files.mapInArrow(whole, schema).unionByName(segments.groupBy("origin").applyInArrow(together, schema))


def resolve(records: DataFrame) -> DataFrame:
    """Gives each revisit the payload size of the response it refers to."""
    revisits = records.filter("record_type = 'revisit'").drop("payload_bytes")
    sizes = records.filter("record_type = 'response'").groupBy("page_id", "payload_digest")
    sizes = sizes.agg(F.max("payload_bytes").alias("payload_bytes"))
    sizes = sizes.select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes")
    found = revisits.join(sizes, ["refers_to", "payload_digest"], "left").select(*records.columns)
    return records.filter("record_type = 'response'").unionByName(found)


def archive_round_trip(pages: DataFrame, path: str, segment_bytes: int, min_bytes: int = 0) -> DataFrame:
    """Writes the pages below ``path``, reads the archives back, and resolves revisits."""
    write_archives(pages, path, segment_bytes, min_bytes)
    return resolve(written(read_archives(pages.sparkSession, path), "warc-records"))
