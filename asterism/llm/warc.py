"""WARC derivatives: metadata and plain-text conversion records for response records.

For each response two records are made and linked to it: a ``metadata`` record with
what is known of the response (its own header fields, the HTTP status and headers,
digests and title), and a ``conversion`` record with the page's plain text. Both have
a WARC-Refers-To with the response's id, its target URI and date, and digests of
their own block; ids are made of the response's id, so a rerun makes the same ones.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import ROWS_AT_ONCE, map_rows, to_arrow
from asterism.llm.html_tree import INLINE, RAW, Node, parse

# Names and types of the WARC 1.1 and HTTP formats.
VERSION = b"WARC/1.1"
HTTP_TYPE = "application/http; msgtype=response"
FIELDS_TYPE = "application/warc-fields"
TEXT_TYPE = "text/plain; charset=utf-8"
# bytes of a file that go to Python at once, and that the header lines of a record may take
SLICE, MOST_HEADERS = 1 << 16, 1 << 20
HTML_TYPES = ("text/html", "application/xhtml+xml")

RECORD = "headers array<struct<name:string,value:string>>, block binary"
RESULT = (
    "type string, record_id string, refers_to string, target_uri string, date string, content_type string,"
    " block_digest string, payload_digest string, content_length long, record binary"
)

Headers = list[tuple[str, str]]


def sha1(data: bytes) -> str:
    """A digest as WARC writes it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def serialise(headers: Headers, block: bytes) -> bytes:
    """One record; line ends within a header value are folded to spaces."""
    lines = [VERSION, *(f"{name}: {' '.join(value.split())}".encode() for name, value in headers)]
    return b"\r\n".join([*lines, b"", block, b"", b""])


def records(data: bytes) -> Iterator[tuple[Headers, bytes]]:
    """The records of a WARC file, plain or gzipped as a whole or record by record.

    Raises ValueError where a record is damaged.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        headers = _fields(data[at:end].decode("utf-8", "replace").split("\r\n")[1:])
        length = first(headers, "Content-Length")
        if not (length or "").isdigit() or end + 4 + int(length) > len(data):
            raise ValueError(f"wrong length of the record at byte {at}")
        at = end + 4 + int(length)
        yield headers, data[end + 4 : at]
        at += len(data[at : at + 4]) - len(data[at : at + 4].lstrip(b"\r\n"))


def _fields(lines: Iterable[str]) -> Headers:
    """Header lines as pairs; a line that begins with a space continues the one before."""
    pairs: Headers = []
    for line in lines:
        if line[:1] in " \t" and pairs:
            pairs[-1] = (pairs[-1][0], f"{pairs[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            pairs.append((name.strip(), value.strip()))
    return pairs


def first(headers: Headers, name: str) -> str | None:
    return next((value for key, value in headers if key.lower() == name.lower()), None)


def split_http(block: bytes) -> tuple[str, Headers, bytes]:
    """Status line, headers and payload of an HTTP response; a block without headers is all payload."""
    head, found, payload = block.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"HTTP/"):
        return "", [], block
    status, *lines = head.decode("utf-8", "replace").split("\r\n")
    return status, _fields(lines), payload


def unchunked(payload: bytes) -> bytes:
    """The data of a chunked payload up to its last whole or cut chunk; one that isn't chunked stays."""
    parts, at = [], 0
    while at < len(payload):
        end = payload.find(b"\r\n", at)
        size = re.fullmatch(rb"[ \t]*([0-9A-Fa-f]+)[ \t]*(;.*)?", payload[at:end] if end >= 0 else b"", re.S)
        if not size:
            return b"".join(parts) if parts else payload
        length = int(size[1], 16)
        if not length:
            break
        parts.append(payload[end + 2 : end + 2 + length])
        at = end + 2 + length + 2
    return b"".join(parts)


def _inflated(payload: bytes, wbits: int) -> bytes:
    """All members of compressed data, as far as they are whole."""
    parts = []
    while payload:
        member = zlib.decompressobj(wbits)
        try:
            parts.append(member.decompress(payload) + member.flush())
        except zlib.error:
            if not parts:
                raise
            break
        if wbits < 0 and not member.eof:  # without a header plain bytes may look like a beginning
            raise zlib.error("no end")
        if not member.eof or wbits < 0:
            break
        payload = member.unused_data
    return b"".join(parts)


def decoded(payload: bytes, http: Headers) -> bytes:
    """A payload without its transfer and content codings: chunked, gzip and deflate.

    Several codings are undone from the last to the first. What isn't so coded in spite
    of its header, as where a crawler undid it, or is coded in another way, stays as it is.
    """
    for header in ("Transfer-Encoding", "Content-Encoding"):
        codings = ",".join(value for name, value in http if name.lower() == header.lower())
        for coding in reversed([c.partition(";")[0].strip().lower() for c in codings.split(",")]):
            if coding == "chunked":
                payload = unchunked(payload)
            for wbits in {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(coding, ()):
                try:
                    payload = _inflated(payload, wbits)
                    break
                except zlib.error:
                    continue
    return payload


def plain_text(source: str) -> tuple[str, str]:
    """(title, text) of a page: all text but scripts, styles and other raw elements, a line for each block."""
    title, pieces = "", []
    stack: list[Node | str | None] = [parse(source)]
    while stack:
        item = stack.pop()
        if item is None:  # the end of a block
            pieces.append("\n")
        elif isinstance(item, str):
            pieces.append(" ".join(item.split("\n")))
        elif item.name in RAW:
            if item.name == "title" and not title:
                title = " ".join("".join(x for x in item.items if isinstance(x, str)).split())
        elif item.name in INLINE and item.name != "br":
            stack += reversed(item.items)
        else:
            pieces.append("\n")
            stack += [None, *reversed(item.items)]
    lines = (" ".join(line.split()) for line in "".join(pieces).split("\n"))
    return title, "\n".join(filter(None, lines))


def decode_payload(payload: bytes, http: Headers) -> str:
    """Text of a payload: the charset of its type, or of its first bytes, else UTF-8; never raises."""
    declared = re.search(r"charset=[\"']?([\w-]+)", first(http, "Content-Type") or "", re.I)
    inside = re.search(rb"<meta[^>]{0,200}charset=[\"']?([\w-]+)", payload[:2048], re.I)
    name = declared[1] if declared else inside[1].decode() if inside else "utf-8"
    try:
        return payload.decode(name, "replace")
    except (LookupError, ValueError):  # no such charset, or one that isn't for such bytes
        return payload.decode("utf-8", "replace")


def derive(headers: Headers, block: bytes) -> list[dict]:
    """The metadata and the conversion record of one response; nothing for other records."""
    if (first(headers, "WARC-Type") or "").lower() != "response":
        return []
    source_id = first(headers, "WARC-Record-ID") or f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, sha1(block))}>"
    uri, date = first(headers, "WARC-Target-URI") or "", first(headers, "WARC-Date") or ""
    status, http, payload = split_http(block)
    payload_digest = first(headers, "WARC-Payload-Digest") or sha1(payload)
    text = decode_payload(decoded(payload, http), http)
    kind = (first(http, "Content-Type") or "text/html").partition(";")[0].strip().lower()
    title, plain = plain_text(text) if kind in HTML_TYPES else ("", text if kind.startswith("text/") else "")
    fields = [
        ("source-block-digest", first(headers, "WARC-Block-Digest") or sha1(block)),
        ("source-payload-digest", payload_digest),
        ("source-payload-length", str(len(payload))),
        ("http-status", status),
        ("title", title),
        *((f"source-{name.lower()}", value) for name, value in headers),
        *((f"http-{name.lower()}", value) for name, value in http),
    ]
    metadata = "".join(f"{name}: {' '.join(value.split())}\r\n" for name, value in fields).encode()
    made = []
    for made_type, content_type, body in (
        ("metadata", FIELDS_TYPE, metadata),
        ("conversion", TEXT_TYPE, plain.encode()),
    ):
        record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source_id} {made_type}')}>"
        digest = sha1(body)
        own: Headers = [
            ("WARC-Type", made_type),
            ("WARC-Record-ID", record_id),
            ("WARC-Refers-To", source_id),
            ("WARC-Target-URI", uri),
            ("WARC-Date", date),
            ("WARC-Block-Digest", digest),
            ("WARC-Payload-Digest", payload_digest if made_type == "metadata" else digest),
            ("Content-Type", content_type),
            ("Content-Length", str(len(body))),
        ]
        made.append(
            {
                "type": made_type, "record_id": record_id, "refers_to": source_id, "target_uri": uri, "date": date,
                "content_type": content_type, "block_digest": digest,
                "payload_digest": own[6][1], "content_length": len(body), "record": serialise(own, body),
            }
        )
    return made


def responses_from_pages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records (headers, block) for rows of (page_id, url, html), with page_id.

    The record id is made of page id and url, and block and payload digests are set.
    A null page has an empty payload and a null url an empty target.
    """

    def batch(columns: dict[str, list]) -> dict[str, list]:
        headers, blocks = [], []
        for page_id, url, source in zip(columns["page_id"], columns["url"], columns["html"]):
            payload = (source or "").encode()
            http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
            block = http.encode() + b"\r\n\r\n" + payload
            record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"
            fields = [
                ("WARC-Type", "response"),
                ("WARC-Record-ID", record_id),
                ("WARC-Target-URI", url or ""),
                ("WARC-Date", date),
                ("WARC-Block-Digest", sha1(block)),
                ("WARC-Payload-Digest", sha1(payload)),
                ("Content-Type", HTTP_TYPE),
                ("Content-Length", str(len(block))),
            ]
            headers.append([{"name": name, "value": value} for name, value in fields])
            blocks.append(block)
        return {"page_id": columns["page_id"], "headers": headers, "block": blocks}

    return map_rows(pages.select("page_id", "url", "html"), batch, f"page_id long, {RECORD}")


def _inflated_pieces(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The bytes of a file in pieces of bounded size, without its compression."""
    pieces = iter(pieces)
    head = b""
    for piece in pieces:
        head += piece
        if len(head) > 1:
            break
    if head[:2] != b"\x1f\x8b":
        yield head
        yield from pieces
        return
    member = zlib.decompressobj(31)
    for piece in chain([head], pieces):
        while piece:
            if member.eof:
                piece = piece.lstrip(b"\0")  # padding between members
                if not piece:
                    break
                member = zlib.decompressobj(31)
            try:
                yield member.decompress(piece, SLICE)
            except zlib.error as error:
                raise ValueError(f"damaged compression: {error}") from error
            piece = member.unused_data if member.eof else member.unconsumed_tail
    if not member.eof:
        raise ValueError("the compression ends early")


def stream_records(pieces: Iterable[bytes]) -> Iterator[tuple[Headers, bytes] | str]:
    """The records of a file that comes in pieces, holding one at a time.

    A damaged record ends the file: what is wrong is given in its place, as text.
    """
    data, at = bytearray(), 0
    source = _inflated_pieces(pieces)
    try:
        while True:
            while not data.lstrip(b"\r\n"):
                at += len(data)
                data.clear()
                if (piece := next(source, None)) is None:
                    return
                data += piece
            skipped = len(data) - len(data.lstrip(b"\r\n"))
            del data[:skipped]
            at += skipped
            while (end := data.find(b"\r\n\r\n")) < 0:
                if len(data) >= 5 and not data.startswith(b"WARC/") or len(data) > MOST_HEADERS:
                    raise ValueError(f"no record at byte {at}")
                if (piece := next(source, None)) is None:
                    raise ValueError(f"the record at byte {at} is cut")
                data += piece
            if not data.startswith(b"WARC/"):
                raise ValueError(f"no record at byte {at}")
            headers = _fields(data[:end].decode("utf-8", "replace").split("\r\n")[1:])
            length = first(headers, "Content-Length") or ""
            if not (length.isascii() and length.isdigit()):
                raise ValueError(f"no length of the record at byte {at}")
            whole = end + 4 + int(length)
            while len(data) < whole:
                if (piece := next(source, None)) is None:
                    raise ValueError(f"the record at byte {at} is cut")
                data += piece
            yield headers, bytes(data[end + 4 : whole])
            del data[:whole]
            at += whole
    except ValueError as error:
        yield str(error)


def read_warc(files: DataFrame) -> DataFrame:
    """Records (headers, block, error) of WARC files, given as rows with ``content``, as
    ``binaryFile`` reads them.

    A damaged file gives the records before the damage and one row with the ``error`` and
    nothing else. A null or empty file gives none. A file is handed on in slices, so a
    task's Python holds a batch of them and one record, not whole files.
    """
    schema = f"{RECORD}, error string"
    arrow = to_arrow(files.sparkSession, schema)
    # slices of a file stay together and in order: nothing is shuffled
    ends = F.sequence(F.lit(0), F.expr(f"(octet_length(content) - 1) div {SLICE}"))
    slices = files.where(F.octet_length("content") > 0).select(
        F.monotonically_increasing_id().alias("file"), "content"
    )
    slices = slices.select("file", "content", F.explode(ends).alias("k"))
    slices = slices.select("file", F.expr(f"substring(content, cast(k * {SLICE} + 1 as int), {SLICE})").alias("slice"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (file, piece)
            for batch in batches
            for at in range(batch.num_rows)
            for file, piece in [(batch.column("file")[at].as_py(), batch.column("slice")[at].as_py())]
        )
        for _, of_file in groupby(rows, key=lambda row: row[0]):
            found, held = [], 0
            for record in stream_records(piece for _, piece in of_file):
                if isinstance(record, str):
                    found.append((None, None, record))
                else:
                    headers, block = record
                    found.append(([{"name": name, "value": value} for name, value in headers], block, None))
                    held += len(block)
                if held > 16 * SLICE or len(found) >= ROWS_AT_ONCE:
                    yield _rows(found)
                    found, held = [], 0
            if found:
                yield _rows(found)

    def _rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    return slices.mapInArrow(run, schema)


def derivatives(responses: DataFrame, key: str | None = None) -> DataFrame:
    """The derived records of rows (headers, block), with the column ``key`` of each if one is named.

    Records that aren't responses give none, and neither do rows without headers; a
    null block counts as empty. A response without an id gets one of its content.
    Repeated responses give repeated records. ``record`` holds the whole record as
    bytes, so that a file of them, one after another, is a WARC file.
    """
    keys = [key] if key else []
    schema = f"{key} long, {RESULT}" if key else RESULT

    def batch(columns: dict[str, list]) -> dict[str, list]:
        rows = [
            made | {k: columns[k][i] for k in keys}
            for i, (headers, block) in enumerate(zip(columns["headers"], columns["block"]))
            for made in derive([(h["name"] or "", h["value"] or "") for h in headers or ()], block or b"")
        ]
        names = [*keys, *(part.split()[0] for part in RESULT.split(", "))]
        return {name: [row[name] for row in rows] for name in names}

    return map_rows(responses.select(*keys, "headers", "block"), batch, schema)
