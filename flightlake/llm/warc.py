"""WARC derivatives: metadata and plain-text conversion records of responses.

A record is a block of named fields, an empty line, a body of Content-Length
bytes and two line ends. From every response come a ``metadata`` record (title,
links, status, the source's HTTP headers and digests as application/warc-fields)
and, where the payload is text, a ``conversion`` record with its plain text.
Both name the response (WARC-Refers-To, its target URI and date) and carry
digests of their own; the conversion's id is in the metadata and vice versa.
"""

from __future__ import annotations

import hashlib
import html
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.sources.tarstates import _filesystem

VERSION = b"WARC/1.1"
CRLF = "\r\n"
#: For responses that are made from a table without dates.
EPOCH = "1970-01-01T00:00:00Z"

# Tags whose ends are line ends, and those whose content is no text (HTML's own names).
_BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav noscript ol option p pre
section summary table tbody td textarea tfoot th thead title tr ul""".split())
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|title)\b[^>]*>(.*?)(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-z][a-z0-9]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.I | re.S)
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def html_to_text(source: str) -> tuple[str, str, list[str]]:
    """(plain text, title, link targets). Comments, scripts, styles and the
    title are no text; block elements end lines; blanks are joined and empty
    lines dropped; character references are resolved last."""
    title: list[str] = []
    links: list[str] = []

    def markup(m: re.Match) -> str:
        if m[4]:
            name = m[4].lower()
            if name == "a" and not m[3]:
                href = _HREF.search(m[5])
                if href:
                    links.append(html.unescape(href[1] or href[2] or href[3] or ""))
            return "\n" if name in _BLOCK else ""
        if m[1] and m[1].lower() == "title":
            title.append(" ".join(html.unescape(m[2]).split()))
        return ""

    text = html.unescape(_MARKUP.sub(markup, source))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line), title[0] if title else "", links


def digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def record_id(*parts: str) -> str:
    """A record id that only depends on its parts."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(chr(0).join(parts).encode('utf-8', 'surrogatepass')).digest())}>"


def build_record(fields: list[tuple[str, str]], body: bytes) -> bytes:
    """A whole record; line ends inside field values become blanks."""
    lines = [f"{k}: {' '.join(str(v).split(chr(10))).replace(chr(13), ' ')}" for k, v in fields]
    head = CRLF.join([VERSION.decode(), *lines, f"Content-Length: {len(body)}", "", ""])
    return head.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(fields with lower-case names, body); ValueError if it is no whole record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(b"WARC/"):
        raise ValueError("no record header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("a header line without a colon")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not length.isdigit() or len(rest) < int(length):
        raise ValueError("the body is shorter than Content-Length")
    return fields, rest[:int(length)]


def parse_http(body: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status code, headers, payload) of an HTTP response message."""
    head, gap, payload = body.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not lines[0].startswith("HTTP/"):
        raise ValueError("no HTTP response")
    status = (lines[0].split(None, 2) + ["", ""])[1]
    headers = [(n.strip(), v.strip()) for n, c, v in (x.partition(":") for x in lines[1:]) if c]
    return status, headers, payload


def derive(record: bytes) -> list[bytes]:
    """The derivative records of one response record."""
    fields, body = parse_record(record)
    if fields.get("warc-type") != "response":
        return []
    status, headers, payload = parse_http(body)
    source, uri, date = (fields.get(k, "") for k in ("warc-record-id", "warc-target-uri", "warc-date"))
    kind = next((v for n, v in headers if n.lower() == "content-type"), "")
    is_html = kind.lower().split(";")[0].strip() in ("text/html", "application/xhtml+xml")
    is_text = is_html or kind.lower().startswith("text/")
    charset = re.search(r"charset\s*=\s*[\"']?([\w-]+)", kind, re.I)
    name = charset[1] if charset else "utf-8"
    try:
        content = payload.decode(name, "replace")
    except LookupError:
        content = payload.decode("utf-8", "replace")
    text, title, links = html_to_text(content) if is_html else (content, "", [])
    ids = {t: record_id(t, source, uri) for t in ("metadata", "conversion")}
    link_to_source = [("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Refers-To", source),
                      ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date)]
    facts = [("title", title), ("http-status", status), ("charset", name),
             ("source-payload-digest", fields.get("warc-payload-digest") or digest(payload)),
             ("source-block-digest", fields.get("warc-block-digest") or digest(body))]
    facts += [("http-header", f"{n}: {v}") for n, v in headers] + [("outlink", x) for x in links]
    if is_text:
        facts.append(("conversion", ids["conversion"]))
    block = "".join(f"{k}: {' '.join(v.split())}{CRLF}" for k, v in facts).encode("utf-8", "surrogatepass")
    out = [build_record([("WARC-Type", "metadata"), ("WARC-Record-ID", ids["metadata"]), *link_to_source,
                         ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/warc-fields")], block)]
    if is_text:
        plain = text.encode("utf-8", "replace")
        out.append(build_record(
            [("WARC-Type", "conversion"), ("WARC-Record-ID", ids["conversion"]), *link_to_source,
             ("WARC-Concurrent-To", ids["metadata"]), ("WARC-Block-Digest", digest(plain)),
             ("WARC-Payload-Digest", digest(plain)), ("Content-Type", "text/plain; charset=utf-8")], plain))
    return out


def page_responses(pages: DataFrame, url: str = "url", payload: str = "html", date: str = EPOCH) -> DataFrame:
    """``pages`` less its payload, with ``record``: a response record for each
    row. A null URL or payload is empty; the id depends on URL and payload only."""
    body_text = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(body_text).cast("string"), F.lit(CRLF * 2)).cast("binary")
    body = F.concat(head, body_text)
    uri = F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\r\n]", " ")
    key = F.md5(F.concat(uri.cast("binary"), F.lit("\0").cast("binary"), body_text))
    urn = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(key, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
                   F.lit(">"))

    def line(name: str, value: Column) -> list[Column]:
        return [F.lit(f"{name}: "), value, F.lit(CRLF)]

    header = F.concat(
        F.lit(f"{VERSION.decode()}{CRLF}WARC-Type: response{CRLF}"), *line("WARC-Record-ID", urn),
        *line("WARC-Target-URI", uri), *line("WARC-Date", F.lit(date)),
        *line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.sha2(body_text, 256))),
        *line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(body, 256))),
        *line("Content-Type", F.lit("application/http; msgtype=response")),
        *line("Content-Length", F.octet_length(body).cast("string")), F.lit(CRLF))
    record = F.concat(header.cast("binary"), body, F.lit(CRLF * 2).cast("binary"))
    kept = [c for c in pages.columns if c.lower() not in (payload.lower(), "record")]
    return pages.select(*kept, record.alias("record"))


def build_derivatives(responses: DataFrame, record: str = "record") -> DataFrame:
    """One row for each derivative record: the columns of ``responses``, with
    ``record`` replaced by the derivative, and ``error``.

    A response with a textual payload gives a metadata and a conversion record,
    any other a metadata record; records of other types give nothing. A record
    that is null or broken gives one row with a null record and the fault in
    ``error``. Repeated responses give repeated derivatives with the same ids.
    Columns of the input named like the results (in any case) are replaced.
    """
    kept = [f for f in responses.schema.fields if f.name.lower() not in (record.lower(), "error")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{record}` binary, error string"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, records, errors = [], [], []
            for i, value in enumerate(batch.column(record)):
                try:
                    data = value.as_py()
                    if data is None:
                        raise ValueError("no record")
                    for r in derive(data):
                        at.append(i)
                        records.append(r)
                        errors.append(None)
                except ValueError as e:
                    at.append(i)
                    records.append(None)
                    errors.append(str(e))
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name).take(rows) for f in kept] + [pa.array(records, pa.binary()),
                                                                  pa.array(errors, pa.string())],
                names=[f.name for f in kept] + [record, "error"])

    return responses.select(*[f.name for f in kept], record).mapInArrow(build, schema)


_PARSED = ("record_type string, record_id string, refers_to string, target_uri string, date string, "
           "content_type string, block_digest string, payload_digest string, body binary")


def read_records(records: DataFrame, record: str = "record") -> DataFrame:
    """The fields and the body of each record; all null for a null or broken one.
    Columns of the input with the names of the results (in any case) are replaced."""
    own = {p.split()[0] for p in _PARSED.split(", ")} | {record.lower()}
    kept = [f for f in records.schema.fields if f.name.lower() not in own]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [_PARSED])
    names = ("warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri", "warc-date", "content-type",
             "warc-block-digest", "warc-payload-digest")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            bodies = []
            for value in batch.column(record):
                data = value.as_py()
                try:
                    fields, body = parse_record(data) if data is not None else ({}, None)
                except ValueError:
                    fields, body = {}, None
                for column, name in zip(columns, names):
                    column.append(fields.get(name))
                bodies.append(body)
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(c, pa.string()) for c in columns]
                + [pa.array(bodies, pa.binary())],
                names=[f.name for f in kept] + [p.split()[0] for p in _PARSED.split(", ")])

    return records.select(*[f.name for f in kept], record).mapInArrow(read, schema)


def compress_record(data: bytes) -> bytes:
    """A record as a gzip member of its own, as WARC files hold them."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _members(stream: BinaryIO, block: int = 1 << 20) -> Iterator[bytes]:
    """What the gzip members of a stream hold, in pieces. One pass: of a block
    only what is left behind a member's end is looked at again."""
    unpacker, fresh = zlib.decompressobj(31), True
    while data := stream.read(block):
        while data:
            if piece := unpacker.decompress(data, block):
                yield piece
            data = unpacker.unconsumed_tail
            fresh = False
            if unpacker.eof:
                data, unpacker, fresh = unpacker.unused_data, zlib.decompressobj(31), True
    if not fresh:
        raise ValueError("the last gzip member is cut off")


def split_stream(stream: BinaryIO, block: int = 1 << 20) -> Iterator[bytes]:
    """The records of a WARC stream, plain or of gzip members, one at a time.
    Holds one record and a block."""
    start = stream.read(2)
    rest = _Prefixed(start, stream)
    pieces = _members(rest, block) if start == b"\x1f\x8b" else iter(lambda: rest.read(block), b"")
    held, at = bytearray(), 0

    def more() -> bool:
        nonlocal at
        piece = next(pieces, b"")
        if at:
            del held[:at]
            at = 0
        held.extend(piece)
        return bool(piece)

    while True:
        looked = at
        while (end := held.find(b"\r\n\r\n", looked)) < 0:
            looked = max(0, len(held) - at - 3)
            if not more():
                if held[at:]:
                    raise ValueError("no record header")
                return
        length = re.search(rb"(?im)^content-length:\s*(\d+)", held[at:end])
        if not length:
            raise ValueError("no record header")
        size = end - at + 8 + int(length[1])
        while len(held) - at < size and more():
            pass
        yield bytes(held[at:at + size])
        at = min(len(held), at + size)


class _Prefixed:
    """A stream with some bytes before it."""

    def __init__(self, first: bytes, stream: BinaryIO):
        self.first, self.stream = first, stream

    def read(self, n: int) -> bytes:
        if self.first:
            data, self.first = self.first, b""
            return data
        return self.stream.read(n)


def split_file(content: bytes) -> Iterator[bytes]:
    """The records of a WARC file, plain or of gzip members, one at a time."""
    return split_stream(io.BytesIO(content))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, record) of the WARC files of a folder. A task reads its files as
    streams; it holds a record at a time."""
    files = spark.read.format("binaryFile").load(path).select("path")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("path").to_pylist():
                filesystem, inner = _filesystem(name)
                with filesystem.open_input_stream(inner, compression=None) as stream:
                    for record in split_stream(stream):
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([record], pa.binary())],
                                                         names=["path", "record"])

    return files.mapInArrow(split, "path string, record binary")
