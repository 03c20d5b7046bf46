"""Legacy web archives to WARC.

An ARC archive begins with a version block whose body names the fields of every record's header line:
version 1 has five, version 2 ten. A record is that line, as many bytes as its last field says, and a
newline. Converting a record keeps its bytes as the WARC block and makes what ARC lacks: a record id
(named by URL, time and digest, so that it is the same on every run), an ISO time from the 14 digits,
the record type from the content, and the payload digest. Payloads found before become revisits.

Archives are rows: a name and the bytes, a bounded number of them in each row, so that they are
written, read and shuffled like any other table. Bytes may be gzip members or plain.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.rows import pieces, select_as
from larder.session import materialize

#: Bytes of content after which a new archive is begun.
ARCHIVE_BYTES = 4_000_000
#: Payloads below this size are never revisits.
LEAST_REVISIT = 100

# Field names of the two header lines, as version blocks state them, and the revisit profile.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_UNSAFE = re.compile(r"[\s\x00-\x1f\x7f]")


def _line_safe(value: str | None) -> str:
    """A value for a header line: blanks and control characters percent-encoded, a dash for none."""
    return _UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), value) if value else "-"


# ARC

def arc_version_block(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 larder\n{ARC_FIELDS[version]}\n".encode()
    head = f"filedesc://{name} 0.0.0.0 {date} text/plain "
    return (head + ("" if version == 1 else "200 - - 0 " + name + " ") + f"{len(body)}\n").encode() + body + b"\n"


def arc_record(version: int, url: str | None, ip: str, date: str, kind: str, status: int, content: bytes, offset: int, name: str) -> bytes:
    fields = [_line_safe(url), ip, date, kind]
    if version == 2:
        fields += [str(status), hashlib.md5(content).hexdigest(), "-", str(offset), name]
    return " ".join([*fields, str(len(content))]).encode() + b"\n" + content + b"\n"


def http_response(page_id: int | None, payload: bytes) -> bytes:
    own = f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def read_arc(raw: bytes) -> Iterator[dict]:
    """The records of one archive, each a dict of its header fields and ``content``.

    The version is the one its first block states. Header lines are read from their end, as only
    the URL may hold blanks.
    """
    stream = io.BytesIO(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw)
    line = stream.readline()
    body = stream.read(int(line.split()[-1]))
    first, fields, *_ = body.decode("utf-8", "replace").split("\n")
    version = int(first.split()[0])
    if fields.split() != ARC_FIELDS.get(version, "").split():
        raise ValueError(f"unknown archive version: {first!r}")
    names = fields.split()
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        values = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", len(names) - 1)
        if len(values) != len(names):
            raise ValueError(f"a header line lacks fields: {line[:200]!r}")
        record = dict(zip(names, values))
        record["content"] = stream.read(int(record["Archive-length"]))
        if len(record["content"]) != int(record["Archive-length"]):
            raise ValueError("an archive ends within a record")
        yield record


def split_http(content: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower-cased), header bytes and payload; content that is no HTTP message is all payload."""
    end = content.find(b"\r\n\r\n")
    if not content.startswith(b"HTTP/") or end < 0:
        return {}, b"", content
    fields = {}
    for line in content[:end].decode("latin-1").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, content[:end + 4], content[end + 4:]


# WARC

def warc_date(arc_date: str) -> str:
    """ISO time of an ARC date of 14 digits; a shorter one means the start of its year, month, day and so on."""
    digits = re.sub(r"\D", "", arc_date)[:14]
    full = digits + "00000101000000"[len(digits):] if len(digits) >= 4 else "19700101000000"
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def record_id(url: str, date: str, page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {page_id} {digest}')}>"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _gzip_member(raw: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def read_warc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-cased) and block of each record of one archive."""
    stream = io.BytesIO(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:80]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("an archive ends within a record")
        yield fields, block


# Tables

def _archive_name(part: str) -> str:
    context = TaskContext.get()
    return f"{part}-{context.partitionId() if context else 0:06d}"


def write_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", version: int = 1,
              date: str = "20200101000000", ip: str = "0.0.0.0") -> DataFrame:
    """``archive``, ``content``: legacy archives with one record per page, about ``ARCHIVE_BYTES`` each.

    A null html is an empty payload, a null URL a dash; the page id travels in the stored HTTP header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, name, parts, size = 0, "", [], 0
        for batch in batches:
            for part, htmls in pieces(batch, "html"):
                for page_id, url, html in zip(part.column("page_id").to_pylist(), part.column("url").to_pylist(), htmls):
                    if not parts:
                        name = f"{_archive_name('legacy')}-{count:06d}.arc"
                        parts, size, count = [arc_version_block(name, version, date)], 0, count + 1
                    content = http_response(page_id, html.encode("utf-8", "replace"))
                    parts.append(arc_record(version, url, ip, date, "text/html", 200, content, size, name))
                    size += len(parts[-1])
                    if size >= ARCHIVE_BYTES:
                        yield _archive_row(name, b"".join(parts))
                        parts = []
        if parts:
            yield _archive_row(name, b"".join(parts))

    return select_as(pages, page_id=id_col, url=url_col, html=html_col).mapInArrow(run, "archive string, content binary")


def _archive_row(name: str, raw: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([raw], pa.binary())], names=["archive", "content"])


_CAPTURE = "page_id long, url string, ip string, date string, digest string, payload_bytes long, content binary"


def arc_captures(archives: DataFrame, with_content: bool = True) -> DataFrame:
    """The records of legacy archives with what WARC needs: ISO date, digest and size of the payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                rows = []
                for record in read_arc(raw.as_py()):
                    fields, _, payload = split_http(record["content"])
                    page = fields.get("x-page-id")
                    rows.append((int(page) if page else None, record["URL"], record["IP-address"], warc_date(record["Archive-date"]),
                                 hashlib.sha256(payload).hexdigest(), len(payload), record["content"] if with_content else None))
                if rows:
                    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     names=["page_id", "url", "ip", "date", "digest", "payload_bytes", "content"])

    return archives.mapInArrow(run, _CAPTURE)


def _first_holders(captures: DataFrame) -> DataFrame:
    """``page_id``, ``digest``, ``first_id``, ``first_url``, ``first_date`` of every capture that repeats an earlier payload."""
    large = captures.where((F.col("payload_bytes") >= LEAST_REVISIT) & F.col("page_id").isNotNull())
    held = large.groupBy("digest").agg(
        F.min(F.struct("page_id", "url", "date")).alias("first"), F.max("page_id").alias("last")).where("last > first.page_id")
    firsts = materialize(held.select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
                                     F.col("first.date").alias("first_date")), "first-holders")
    found = large.select("page_id", "digest").join(firsts, "digest").where("page_id > first_id")
    return materialize(found.distinct(), "revisits")


def convert(archives: DataFrame) -> DataFrame:
    """WARC archives (``archive``, ``content``: gzip members) with a record for every record of legacy archives.

    Of captures with the same payload of at least ``LEAST_REVISIT`` bytes, that with the smallest page
    id is a response and the others revisit it, keeping their own HTTP header. Captures without a page
    id, and repeats of one page, are responses.
    """
    revisits = _first_holders(arc_captures(archives, with_content=False).select("page_id", "url", "date", "digest", "payload_bytes"))
    both = arc_captures(archives).join(revisits, ["page_id", "digest"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, count, name = [], 0, 0, ""
        columns = ["page_id", "url", "ip", "date", "digest", "first_id", "first_url", "first_date"]
        for batch in batches:
            lists = [batch.column(c).to_pylist() for c in columns]
            contents = batch.column("content")
            for i, (page_id, url, ip, date, digest, first, first_url, first_date) in enumerate(zip(*lists)):
                if not parts:
                    name, count = f"{_archive_name('converted')}-{count:06d}.warc.gz", count + 1
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, date, None, "")), ("WARC-Date", date),
                            ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
                    parts = [_gzip_member(warc_record(info, b"software: larder\r\nformat: WARC File Format 1.1\r\n"))]
                content = contents[i].as_py()
                _, head, _ = split_http(content)
                fields = [("WARC-Type", "response" if first is None else "revisit"),
                          ("WARC-Record-ID", record_id(url, date, page_id, digest)), ("WARC-Date", date), ("WARC-Target-URI", url),
                          ("WARC-IP-Address", ip), ("WARC-Payload-Digest", f"sha256:{digest}"),
                          ("Content-Type", "application/http; msgtype=response")]
                if first is not None:
                    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(first_url, first_date, first, digest)),
                               ("WARC-Refers-To-Target-URI", first_url), ("WARC-Refers-To-Date", first_date), ("X-Refers-To-Page-Id", str(first))]
                parts.append(_gzip_member(warc_record(fields, content if first is None else head)))
                size += len(content)
                if size >= ARCHIVE_BYTES:
                    yield _archive_row(name, b"".join(parts))
                    parts, size = [], 0
        if parts:
            yield _archive_row(name, b"".join(parts))

    return both.select("page_id", "url", "ip", "date", "digest", "first_id", "first_url", "first_date", "content").mapInArrow(
        run, "archive string, content binary")


_RECORD = ("record_id string, record_type string, date string, url string, page_id long, payload_bytes long, payload_digest string, "
           "refers_to long, refers_to_record string, payload string")


def records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The response and revisit records of WARC archives.

    A response's payload is digested again and must agree with its header. ``payload_bytes`` and
    ``payload_digest`` are those of the full payload for revisits too, whose own payload is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                rows = [r for r in map(_record_row, read_warc(raw.as_py())) if r]
                if rows:
                    columns = [list(c) for c in zip(*rows)]
                    if not with_payload:
                        columns[-1] = [None] * len(rows)
                    kinds = [pa.string()] * 4 + [pa.int64()] * 2 + [pa.string(), pa.int64(), pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                     names=[c.split()[0] for c in _RECORD.split(", ")])

    return archives.mapInArrow(run, _RECORD)


def _record_row(record: tuple[dict[str, str], bytes]) -> tuple | None:
    fields, block = record
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = split_http(block)
    digest, page = fields["warc-payload-digest"].removeprefix("sha256:"), http.get("x-page-id")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    size = len(payload) if kind == "response" else int(http["content-length"])
    refers = fields.get("x-refers-to-page-id")
    return (fields["warc-record-id"], kind, fields["warc-date"], fields["warc-target-uri"], int(page) if page else None, size, digest,
            int(refers) if refers else None, fields.get("warc-refers-to"), payload.decode("utf-8", "replace") if kind == "response" else None)
