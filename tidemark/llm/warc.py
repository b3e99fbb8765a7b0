"""Derived WARC records of web pages.

For each response record two records are made, linked to it by ``WARC-Refers-To``: a metadata
record with the source's headers, digests and the identifier of the conversion, and a conversion
record with the page's plain text. Identifiers are name-based, so a task that runs twice makes
the same records.

Derived records are text; :func:`write_warc` writes them with Spark's text writer, the record
separator as line separator, so files are committed as a whole in any file system.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, utf8

#: The date of records whose source has none.
DATE = "1970-01-01T00:00:00Z"
END = "\r\n\r\n"
SPACE_OF_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # names that are URLs
DROPPED = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^<>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I
)
BLOCK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr"
    r"|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^<>]*>",
    re.I,
)
TAG = re.compile(r"</?[a-zA-Z!?][^<>]*>")
CHARSET = re.compile(r"charset=[\"']?([\w.:-]+)", re.I)


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE_OF_NAMES, chr(0).join(parts))}>"


def header(fields: list[tuple[str, str | None]]) -> str:
    """Header lines; fields without value are left out, line breaks in values are encoded."""
    clean = [
        (k, v.replace("\r", "%0D").replace("\n", "%0A")) for k, v in fields if v is not None
    ]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in clean), "\r\n"])


def response(page_id: int | None, url: str | None, body: bytes, date: str = DATE) -> bytes:
    """A response record of a page."""
    digest = sha1(body)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
    block = http.encode() + body
    head = header(
        [
            ("WARC-Type", "response"),
            ("WARC-Record-ID", record_id("response", str(page_id), url or "", digest)),
            ("WARC-Date", date),
            ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", digest),
            ("WARC-Block-Digest", sha1(block)),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block))),
        ]
    )
    return head.encode() + block + END.encode()


@dataclass
class Record:
    """A record: fields by lower-cased name, HTTP head lines, payload."""

    fields: dict[str, str] = field(default_factory=dict)
    http: list[str] = field(default_factory=list)
    block: bytes = b""
    payload: bytes = b""


def parse(raw: bytes) -> Record | None:
    """A record from its bytes; None if it has no WARC header."""
    head, mark, rest = raw.partition(END.encode())
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        return None
    found = Record()
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found.fields[name.strip().lower()] = value.strip()
    size = found.fields.get("content-length", "")
    found.block = rest[: int(size)] if size.isdigit() else rest.removesuffix(END.encode())
    if found.fields.get("content-type", "").startswith("application/http"):
        http, _, found.payload = found.block.partition(END.encode())
        found.http = http.decode("utf-8", "replace").split("\r\n")
    else:
        found.payload = found.block
    return found


def plain_text(page: str) -> str:
    """The text of a page: no scripts, styles, comments or tags; a line for each block."""
    page = TAG.sub("", BLOCK.sub("\n", DROPPED.sub(" ", page)))
    lines = (" ".join(x.split()) for x in html.unescape(page).split("\n"))
    return "\n".join(x for x in lines if x)


def codings(http: list[str], name: str) -> list[str]:
    """The codings that a head's field names, in the order they were applied."""
    lines = (x.partition(":") for x in http[1:])
    told = (v for k, _, v in lines if k.strip().lower() == name)
    return [y for x in told for y in (z.strip().lower() for z in x.split(",")) if y != "identity" and y]


def unchunked(data: bytes) -> bytes | None:
    """A body without its chunk lines, as far as it goes; None if it has none."""
    out, at = [], 0
    while at < len(data):
        end = data.find(b"\r\n", at)
        told = data[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]{1,12}", told):
            return None
        size = int(told, 16)
        out.append(data[end + 2 : end + 2 + size])
        at = end + 2 + size
        if not size:
            break
        if data[at : at + 2] not in (b"\r\n", b"\r", b""):
            return None
        at += 2
    return b"".join(out) if out else None


def inflated(data: bytes, coding: str) -> bytes | None:
    """A body without one content coding; None if that can't be undone.

    A body that lacks the mark of its coding was stored decoded, as crawlers do, and stays.
    """
    try:
        if coding in ("gzip", "x-gzip"):
            out, rest = [], data
            while rest[:2] == b"\x1f\x8b":
                member = zlib.decompressobj(31)
                out.append(member.decompress(rest))
                rest = member.unused_data
            return b"".join(out) if out else data
        if coding == "deflate":
            zlibbed = len(data) > 1 and data[0] & 15 == 8 and int.from_bytes(data[:2], "big") % 31 == 0
            return zlib.decompressobj(15 if zlibbed else -15).decompress(data)
        if coding == "zstd":
            marked = data[:4] == b"\x28\xb5\x2f\xfd"
            return zstandard.ZstdDecompressor().decompressobj().decompress(data) if marked else data
    except (zlib.error, zstandard.ZstdError):
        pass
    return None


def entity(source: Record) -> tuple[bytes, bytes | None]:
    """The payload without its transfer coding, and also without its content codings."""
    body = source.payload
    if "chunked" in codings(source.http, "transfer-encoding"):
        plain = unchunked(body)
        body = body if plain is None else plain
    page: bytes | None = body
    for coding in reversed(codings(source.http, "content-encoding")):
        page = inflated(page, coding) if page else page
    return body, page


def charset_of(http: list[str]) -> str:
    for line in http[1:]:
        if line.lower().startswith("content-type:") and (m := CHARSET.search(line)):
            try:
                "".encode(m[1])
                return m[1]
            except LookupError:
                pass
    return "utf-8"


COLUMNS = {
    "response_id": "string",
    "target_uri": "string",
    "payload_digest": "string",
    "digest_ok": "boolean",
    "metadata_id": "string",
    "metadata_digest": "string",
    "conversion_id": "string",
    "conversion_digest": "string",
    "n_text_chars": "long",
    "metadata_record": "string",
    "conversion_record": "string",
}


def derive(raw: bytes) -> tuple | None:
    """``COLUMNS`` of a response record; None for others, for what is none and for unknown codings."""
    source = parse(raw)
    if source is None or source.fields.get("warc-type", "").lower() != "response":
        return None
    fields = source.fields
    own, uri = fields.get("warc-record-id", ""), fields.get("warc-target-uri")
    body, page = entity(source)
    if page is None:
        return None
    date, digest = fields.get("warc-date", DATE), sha1(source.payload)
    told = fields.get("warc-payload-digest")
    text = plain_text(page.decode(charset_of(source.http), "replace"))
    text = text.encode("utf-8", "replace").decode()
    link = [
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Refers-To", own),
        ("WARC-Refers-To-Target-URI", uri),
        ("WARC-Refers-To-Date", date),
    ]
    conversion, text_digest = record_id("conversion", own), sha1(text.encode())
    records = []
    lines = [
        f"conversion: {conversion}",
        f"source-payload-digest: {told or digest}",
        f"source-block-digest: {fields.get('warc-block-digest') or sha1(source.block)}",
        f"source-content-type: {fields.get('content-type', '')}",
        *(f"source-http: {x}" for x in source.http if x),
    ]
    block = "".join(x + "\r\n" for x in lines)
    metadata, block_digest = record_id("metadata", own), sha1(block.encode())
    for kind, name, mime, content, mark in (
        ("metadata", metadata, "application/warc-fields", block, block_digest),
        ("conversion", conversion, "text/plain; charset=utf-8", text, text_digest),
    ):
        head = header(
            [
                ("WARC-Type", kind),
                ("WARC-Record-ID", name),
                *link,
                ("WARC-Block-Digest", mark),
                ("Content-Type", mime),
                ("Content-Length", str(len(content.encode()))),
            ]
        )
        records.append(head + content)
    return (
        own,
        uri,
        told or digest,
        told in (None, digest) or told == sha1(body),
        metadata,
        block_digest,
        conversion,
        text_digest,
        len(text),
        *records,
    )


def _kind(name: str) -> pa.DataType:
    return {"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64()}[name]


def derivatives(records: DataFrame, id_col: str = "page_id", record_col: str = "record") -> DataFrame:
    """``page_id`` and ``COLUMNS`` for each response record, given as bytes.

    Other records, null and broken ones derive nothing and give no row. Chunks and the content
    codings gzip, deflate and zstd are undone, truncated bodies as far as they go; a response in
    another coding, or damaged inside, gives no row. ``digest_ok`` holds if the payload's digest
    is that of the body as stored or of the body without chunks. Pages are read in the character
    set of their HTTP head, else as UTF-8, with replacement characters for what cannot be read.
    Null ids are passed on; equal rows give equal records; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for own, raw in zip(batch.column(0), batch.column(1), strict=True):
                found = derive(raw.as_py() or b"")
                if found is not None:
                    ids.append(own.as_py())
                    rows.append(found)
            columns = zip(*rows, strict=True) if rows else [()] * len(COLUMNS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    *(pa.array(x, _kind(k)) for x, k in zip(columns, COLUMNS.values(), strict=True)),
                ],
                ["page_id", *COLUMNS],
            )

    kept = records.select(F.col(id_col).cast("long").alias("page_id"), F.col(record_col).alias("record"))
    schema = "page_id long, " + ", ".join(f"{k} {v}" for k, v in COLUMNS.items())
    return arrow_map(kept, run, schema)


def responses(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = DATE,
) -> DataFrame:
    """``page_id, record``: a response record of each page; null pages have an empty payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                response(own.as_py(), url.as_py(), body.as_py(), date)
                for own, url, body in zip(*batch.columns, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.binary())], ["page_id", "record"]
            )

    kept = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        utf8(html_col).alias("html"),
    )
    return arrow_map(kept, run, "page_id long, record binary")


def write_warc(derived: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write derived records as WARC files, a page's metadata record before its conversion."""
    lines = derived.select(F.explode(F.array("metadata_record", "conversion_record")).alias("value"))
    lines.write.option("lineSep", END).option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``fields, block`` of the records of WARC files, a file by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        kind = pa.map_(pa.string(), pa.string())
        for batch in batches:
            for data in batch.column(0):
                raw = data.as_py()
                if raw[:2] == b"\x1f\x8b":
                    raw = gzip.decompress(raw)
                at, found = 0, []
                while at < len(raw):
                    start = raw.index(END.encode(), at) + len(END)
                    head = parse(raw[at:start])
                    stop = start + int(head.fields["content-length"])
                    found.append((list(head.fields.items()), raw[start:stop].decode()))
                    at = stop + len(END)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in found], kind), pa.array([x[1] for x in found], pa.string())],
                    ["fields", "block"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return arrow_map(files.select("content"), run, "fields map<string,string>, block string")
