"""Derived records against a plain reader of records and a plain stripper of tags."""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from html.parser import HTMLParser

import pytest
import zstandard
from cases import key

from tidemark.llm import warc
from tidemark.session import fresh_dir

PAGE = "<html><head><title>Tïtle</title><style>p {}</style></head><body><p>One &amp; two</p><p>three</p></body></html>"
TEXT = "Tïtle\nOne & two\nthree"
#: Tags that begin a line, as the operator's contract has them.
LINES = set(
    "address article aside blockquote body br dd div dl dt footer form h1 h2 h3 h4 h5 h6 head header hr html li "
    "main nav ol p pre section table td th title tr ul".split()
)


class Stripper(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.inside = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "noscript", "template"):
            self.inside += 1
        elif tag in LINES:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "noscript", "template"):
            self.inside -= 1
        elif tag in LINES:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.inside:
            self.out.append(data)


def stripped(page):
    own = Stripper()
    own.feed(page)
    own.close()
    lines = (" ".join(x.split()) for x in "".join(own.out).split("\n"))
    return "\n".join(x for x in lines if x)


def read(data):
    """Records one after the other: head lines, then as many bytes as they tell, then two line ends."""
    out = []
    while data:
        head, data = data.split(b"\r\n\r\n", 1)
        first, *lines = head.decode().split("\r\n")
        assert first == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines)
        size = int(fields["Content-Length"])
        out.append((fields, data[:size]))
        assert data[size : size + 4] == b"\r\n\r\n"
        data = data[size + 4 :]
    return out


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_files_hold_what_a_plain_reader_finds(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    folder = fresh_dir(spark, "warc")
    warc.write_warc(warc.derivatives(warc.responses(pages)), folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).collect()
    records = [x for f in files for x in read(gzip.decompress(bytes(f["content"])))]
    want = [(r["url"], (r["html"] or "")) for r in pages.collect()]
    texts = [(f["WARC-Target-URI"], b.decode()) for f, b in records if f["WARC-Type"] == "conversion"]
    assert sorted(texts) == sorted((url, stripped(page)) for url, page in want)
    for fields, block in records:
        assert fields["WARC-Block-Digest"] == sha1(block)
    linked = {}
    for fields, block in records:
        linked.setdefault(fields["WARC-Refers-To"], {})[fields["WARC-Type"]] = (fields, block.decode())
    assert len(linked) == len(want)
    for pair in linked.values():
        assert f"conversion: {pair['conversion'][0]['WARC-Record-ID']}\r\n" in pair["metadata"][1]
    digests = sorted(b.split("source-payload-digest: ")[1].split("\r\n")[0] for _, b in (p["metadata"] for p in linked.values()))
    assert digests == sorted(sha1(page.encode()) for _, page in want)


def record(body, *lines, told=None):
    block = "\r\n".join(["HTTP/1.1 200 OK", "Content-Type: text/html", *lines, "", ""]).encode() + body
    head = ["WARC/1.0", "WARC-Type: response", "WARC-Record-ID: <urn:x>", f"Content-Length: {len(block)}"]
    head += ["Content-Type: application/http; msgtype=response", *([f"WARC-Payload-Digest: {told}"] if told else [])]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def chunks(body, size=7):
    parts = [body[k : k + size] for k in range(0, len(body), size)]
    return b"".join(b"%x;a=b\r\n%s\r\n" % (len(x), x) for x in parts) + b"0\r\n\r\n"


BODY = PAGE.encode()
RAW = zlib.compressobj(wbits=-15)
CODED = {
    "plain": (BODY, ()),
    "identity": (BODY, ("Content-Encoding: identity",)),
    "gzip": (gzip.compress(BODY, mtime=0), ("Content-Encoding: gzip",)),
    "two members": (gzip.compress(BODY[:50]) + gzip.compress(BODY[50:]), ("content-encoding: x-gzip",)),
    "stored decoded": (BODY, ("Content-Encoding: gzip", "Transfer-Encoding: chunked")),
    "deflate": (zlib.compress(BODY), ("Content-Encoding: deflate",)),
    "raw deflate": (RAW.compress(BODY) + RAW.flush(), ("Content-Encoding: deflate",)),
    "zstd": (zstandard.compress(BODY), ("Content-Encoding: zstd",)),
    "chunked": (chunks(BODY), ("Transfer-Encoding: chunked",)),
    "both": (chunks(gzip.compress(BODY, mtime=0)), ("Transfer-Encoding: Chunked", "Content-Encoding: GZIP")),
    "twice": (gzip.compress(zlib.compress(BODY)), ("Content-Encoding: deflate, gzip",)),
}


@pytest.mark.parametrize("name", CODED)
def test_codings_are_undone(name):
    body, lines = CODED[name]
    found = dict(zip(warc.COLUMNS, warc.derive(record(body, *lines)), strict=True))
    assert found["conversion_record"].split("\r\n\r\n", 1)[1] == TEXT
    assert found["payload_digest"] == sha1(body) and found["digest_ok"]


def test_digests_of_chunked_bodies():
    body, lines = CODED["both"]
    for told, ok in ((sha1(body), True), (sha1(gzip.compress(BODY, mtime=0)), True), (sha1(b"other"), False)):
        found = dict(zip(warc.COLUMNS, warc.derive(record(body, *lines, told=told)), strict=True))
        assert found["digest_ok"] == ok and found["payload_digest"] == told


def test_what_cannot_be_undone_gives_no_row():
    whole = gzip.compress(BODY * 50)
    assert warc.derive(record(BODY, "Content-Encoding: br")) is None
    assert warc.derive(record(whole[:30] + b"\x00" * 40 + whole[70:], "Content-Encoding: gzip")) is None
    cut = warc.derive(record(whole[:-20], "Content-Encoding: gzip"))
    assert cut is not None and "One & two" in cut[-1]


def test_clashing_names_long_pages_and_no_pages(spark):
    schema = "page_id long, url string, html string, record binary, conversion_id string, metadata_record string"
    long = "<p>" + "word &lt; " * 300_000 + "</p>"
    rows = [(1, "u", long, None, "x", None), (1, "u", long, None, "x", None), (None, None, None, b"", None, "y")]
    found = warc.derivatives(warc.responses(spark.createDataFrame(rows, schema))).collect()
    assert len(found) == 3
    texts = sorted(((r["page_id"], r["conversion_record"].split(warc.END, 1)[1]) for r in found), key=key)
    assert texts == sorted([(1, ("word < " * 300_000).strip())] * 2 + [(None, "")], key=key)
    assert warc.derivatives(warc.responses(spark.createDataFrame([], schema))).collect() == []
