"""WARC derivatives: linked metadata and plain-text conversion records of response records.

`responses` builds response records of a table of pages, `derive` turns response records (from anywhere) into a metadata
and a conversion record each. A derived record keeps its source's WARC-Record-ID as WARC-Refers-To, its target URI and
date, and in the metadata's body the source's HTTP status and headers and both its digests; the two derived records name
each other by WARC-Concurrent-To. Digests are SHA-1 in base 32. Ids of derived records are UUIDs computed from the source's id,
its block's digest and the kind, so that a repeated task writes the same records.

The conversion's text is that of the payload without its transfer and content encodings (chunked; gzip, deflate, zstd):
HTML and XML lose their tags, other text stays, and content that isn't text has an empty conversion.

`read` parses WARC files (plain or with a gzip member for each record), `write` writes records as WARC files.

Defined results: a null payload is empty; a response without a header block is all payload; unknown charsets are read as
UTF-8, undecodable bytes replaced; a payload in an unknown or broken encoding isn't text; a null URI stays null; a source
without an id has a null refers_to; repeated responses are derived each for itself; pages equal in key, URL and content are
one response and share its id; records that aren't responses are skipped; extra columns are ignored.
"""

from __future__ import annotations

import base64
import contextlib
import gzip
import hashlib
import html
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from groundplan.llm.frames import key_name, map_arrow, position

NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:groundplan:warc-derivative")
RESPONSE = "record_id string, target_uri string, warc_date string, block binary"
DERIVED = (
    "source string, record_type string, record_id string, refers_to string, concurrent_to string, target_uri string, warc_date string, "
    "content_type string, content_length long, block_digest string, source_block_digest string, source_payload_digest string, block string"
)
_HIDDEN = re.compile(r"<!--|<(/?)(script|style|noscript|template|head)\b", re.I)
_CLOSED = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template", "title")}
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"<]*"|'[^'<]*'|["'])*+)>|<![^<>]*>|<\?[^<>]*>""")
_HREF = re.compile(r"""\b(?:href|src)\s*=\s*(?:"([^"<]*)"|'([^'<]*)'|([^\s"'<>]+))""", re.I)
_REST = re.compile(r"\s*>")
_TITLE = re.compile(r"<title\b", re.I)
_CHARSET = re.compile(r"""charset\s*=\s*["']?([A-Za-z0-9_.:-]+)""", re.I)
_HEX = re.compile(rb"[0-9A-Fa-f]{1,16}")
BLOCKS = frozenset(
    "address article aside blockquote br dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{kind} {source}')}>"


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers in order, payload."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"HTTP/"):
        return "", [], block
    first, *lines = head.decode("latin-1").split("\r\n")
    headers: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in " \t" and headers:
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            headers.append((name.strip(), value.strip()))
    return first, headers, body


def header(headers: list[tuple[str, str]], name: str) -> str:
    """All values of a header, joined."""
    return ", ".join(v for k, v in headers if k.lower() == name)


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if it isn't one."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk has no size")
        written = body[at:end].split(b";")[0].strip()
        if not _HEX.fullmatch(written):
            raise ValueError("a chunk's size is no hexadecimal number")
        size = int(written, 16)
        if not size:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def unpacked(body: bytes, headers: list[tuple[str, str]]) -> bytes | None:
    """The payload without its encodings; None if one is unknown or broken. Crawlers often store bodies decoded already."""
    try:
        if "chunked" in header(headers, "transfer-encoding").lower():
            with contextlib.suppress(ValueError):
                body = unchunked(body)
        for name in reversed([x.strip().lower() for x in header(headers, "content-encoding").split(",")]):
            if name in ("gzip", "x-gzip"):
                body = gzip.decompress(body) if body[:2] == b"\x1f\x8b" else body
            elif name == "deflate":
                try:
                    body = zlib.decompress(body)
                except zlib.error:
                    body = zlib.decompress(body, -zlib.MAX_WBITS)
            elif name == "zstd":
                body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
            elif name not in ("", "identity"):
                return None
    except (OSError, EOFError, zlib.error, zstandard.ZstdError):
        return None
    return body


def text_kind(headers: list[tuple[str, str]], body: bytes) -> str:
    """html, text or '' by the content type; without one, by whether the body has null bytes."""
    kind = header(headers, "content-type").split(";")[0].strip().lower()
    if not kind:
        return "" if b"\0" in body else "html"
    if "html" in kind or kind.endswith(("/xml", "+xml")):
        return "html"
    return "text" if kind.startswith("text/") or kind in ("application/json", "application/javascript") or kind.endswith("+json") else ""


def decode(body: bytes, headers: list[tuple[str, str]]) -> str:
    kind = header(headers, "content-type")
    found = _CHARSET.search(kind) or _CHARSET.search(body[:1024].decode("latin-1"))
    try:
        return body.decode(found[1] if found else "utf-8", "replace")
    except (LookupError, UnicodeError):  # no such encoding, or one that isn't for texts
        return body.decode("utf-8", "replace")


def shown(source: str) -> str:
    """A page without comments, scripts and the like, and the tags of its head, in one scan forward.

    What isn't closed reaches to the end. A tag that never ends is text.
    """
    out, at, pos, ends = [], 0, 0, True
    while m := _HIDDEN.search(source, pos):
        name = (m[2] or "").lower()
        if not name:
            end = source.find("-->", m.end())
            to = end + 3 if end >= 0 else len(source)
        else:
            if m[1]:  # of closing tags, only the head's own
                rest = _REST.match(source, m.end()) if name == "head" else None
                end = rest.end() - 1 if rest else -1
            else:
                end = source.find(">", m.end()) if ends else -1
                ends = end >= 0  # none further on, either
            if end < 0:
                pos = m.end()
                continue
            to = end + 1
            if name != "head":
                closed = _CLOSED[name].search(source, to)
                to = closed.end() if closed else len(source)
        out.append(source[at : m.start()])
        at = pos = to
    return "".join([*out, source[at:]])


def title(source: str) -> str | None:
    """What stands between the first title tag and the next closing one."""
    m = _TITLE.search(source)
    end = source.find(">", m.end()) if m else -1
    closed = _CLOSED["title"].search(source, end + 1) if end >= 0 else None
    return source[end + 1 : closed.start()] if closed else None


def plain_text(source: str) -> str:
    """Visible text: a line for each block, white space collapsed, entities resolved after the tags are gone."""

    def tag(m: re.Match) -> str:
        return "\n" if m[2] and m[2].lower() in BLOCKS else ""

    text = html.unescape(_TAG.sub(tag, shown(re.sub(r"[\t\r\n\f ]+", " ", source))))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def links(source: str) -> list[tuple[str, str]]:
    """(tag, URL) of all tags with href or src, in order."""
    out = []
    for m in _TAG.finditer(shown(source)):
        if m[3] and not m[1] and (h := _HREF.search(m[3])):
            out.append((m[2].lower(), html.unescape(h[1] or h[2] or h[3] or "")))
    return out


def derive_one(source: str | None, uri: str | None, date: str | None, block: bytes) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    status, headers, body = split_http(block)
    of_block, of_body = digest(block), digest(body)
    ids = [record_id(f"{source or f'{date} {uri}'} {of_block}", kind) for kind in ("metadata", "conversion")]
    plain = unpacked(body, headers)
    kind = text_kind(headers, plain) if plain is not None else ""
    page = decode(plain, headers) if kind else ""
    named = title(page) if kind == "html" else None
    found = links(page) if kind == "html" else []
    text = plain_text(page) if kind == "html" else page
    meta = {
        "source": {"WARC-Record-ID": source, "WARC-Target-URI": uri, "WARC-Date": date, "WARC-Block-Digest": of_block, "WARC-Payload-Digest": of_body, "Content-Length": len(block)},
        "http": {"status": status, "headers": [list(h) for h in headers]},
        "html": {"title": None if named is None else " ".join(html.unescape(named).split()), "links": [{"tag": t, "url": u} for t, u in found], "text_characters": len(text)},
    }
    out = []
    for i, (what, mime, content) in enumerate((("metadata", "application/json", json.dumps(meta, ensure_ascii=False)), ("conversion", "text/plain; charset=utf-8", text))):
        raw = content.encode("utf-8", "replace")
        out.append((source, what, ids[i], source, ids[1 - i], uri, date, mime, len(raw), digest(raw), of_block, of_body, raw.decode()))
    return out


def responses(pages: DataFrame, url: str = "url", content: str = "html", key: str = "page_id", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table of pages: key, record_id, target_uri, warc_date, block (an HTTP message)."""
    body = F.encode(F.coalesce(F.col(f"`{content}`").cast("string"), F.lit("")), "UTF-8")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    h = F.md5(F.concat_ws("\u0001", F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), F.sha1(body)))
    name = F.concat(F.lit("<urn:uuid:"), *[x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) for x in ([F.lit("-")] if i else []) + [F.substring(h, a, n)]], F.lit(">"))
    return pages.select(F.col(f"`{key}`").alias(key), name.alias("record_id"), F.col(f"`{url}`").cast("string").alias("target_uri"), F.lit(date).alias("warc_date"), F.concat(F.encode(head, "UTF-8"), body).alias("block"))


def derive(records: DataFrame, key: str | None = None, kind: str | None = None) -> DataFrame:
    """Two records (DERIVED) for each response record.

    `key` names a column to carry along (under the name that key_name says); `kind` names a column with the records' types,
    of which all but responses are skipped (without it, all records are responses).
    """
    if kind:
        records = records.filter(F.lower(F.col(f"`{kind}`")) == "response")
    chosen = records.select(*([F.col(f"`{key}`").alias("_key")] if key else []), "record_id", "target_uri", "warc_date", "block")
    names = [c.split()[0] for c in DERIVED.split(", ")]
    name = key_name(key, names) if key else ""
    head = f"`{name}` {records.schema.fields[position(records, key)].dataType.simpleString()}, " if key else ""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                rows, at = [], []
                for i, (r, u, d, b) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("record_id", "target_uri", "warc_date", "block")), strict=True)):
                    rows += derive_one(r, u, d, b or b"")
                    at += [i, i]
                cols = [pa.array(list(c), pa.int64() if n == "content_length" else pa.string()) for n, c in zip(names, zip(*rows, strict=True), strict=True)]
                yield pa.RecordBatch.from_arrays([*([batch.column("_key").take(pa.array(at))] if key else []), *cols], names=[*([name] if key else []), *names])

    return map_arrow(chosen, run, head + DERIVED)


def serialised(derived: DataFrame) -> DataFrame:
    """One string column: each record's header and block, without the two line ends behind a record."""

    def line(name: str, value) -> F.Column:
        return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")))

    fields = (
        ("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Concurrent-To", "concurrent_to"), ("WARC-Target-URI", "target_uri"),
        ("WARC-Date", "warc_date"), ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length"),
    )
    return derived.select(F.concat(F.lit("WARC/1.0\r\n"), *[line(n, F.col(c)) for n, c in fields], F.lit("\r\n"), F.col("block")).alias("value"))


def write(derived: DataFrame, path: str, compression: str = "none") -> None:
    """Write derived records as WARC files; records are UTF-8, and the line separator is what ends a record."""
    serialised(derived).write.option("lineSep", "\r\n\r\n").option("compression", compression).mode("overwrite").text(path)


def parse_headers(lines: list[bytes]) -> dict[str, str]:
    """Header values by lower-case names."""
    out = {}
    for line in lines:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def content_length(headers: dict[str, str]) -> int | None:
    """The length of a record's block, none written being 0; None if it isn't a number."""
    written = headers.get("content-length") or "0"
    return int(written) if written.isascii() and written.isdigit() and len(written) < 19 else None


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an uncompressed stream; a cut last record ends it."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        lines = []
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            lines.append(line)
        headers = parse_headers(lines)
        size = content_length(headers)
        if size is None:  # a broken record: go on at the next line that opens one
            continue
        block = stream.read(size)
        if len(block) < size:
            return
        yield headers, block


#: What records start with, up to the version's last digit: the separator by which Spark cuts files into records.
_OPENS = b"WARC/1."


class _Joiner:
    """Whole records from the pieces between separators of one file; a record whose content holds the separator is joined again."""

    def __init__(self) -> None:
        self.headers: dict[str, str] | None = None
        self.parts: list[bytes] = []

    def feed(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        waiting = [piece]
        while waiting:
            value = waiting.pop()
            if self.headers is None:
                head, end, block = value.partition(b"\r\n\r\n")
                if not end:
                    continue
                self.headers, self.parts = parse_headers(head.split(b"\r\n")[1:]), [block]
            else:
                self.parts.append(value)
            size = content_length(self.headers)
            if size is None:  # a broken record: what follows it is read anew
                rest, self.headers = self.parts[1:], None
                waiting += rest[::-1]
                continue
            if sum(map(len, self.parts)) + len(_OPENS) * (len(self.parts) - 1) < size:
                continue
            block, headers, rest = _OPENS.join(self.parts), self.headers, self.parts[1:]
            self.headers = None
            if not rest or block[size : size + 4] in (b"\r\n\r\n", b""):
                yield headers, block[:size]
            else:  # the record had been cut short, and what followed were records
                waiting += rest[::-1]

    def close(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """The file ends: a record that isn't whole is dropped, what followed it is read anew."""
        while self.headers is not None:
            rest, self.headers = self.parts[1:], None
            for value in rest:
                yield from self.feed(value)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The response records of WARC files, read through Spark as rows of one record each.

    Plain files are split between tasks, gzip files are streamed; no file is held as a whole. A record that holds the
    separator itself is lost only if Spark splits a plain file within it; a record that a file cuts short is skipped.
    """
    cut = spark.read.option("lineSep", _OPENS.decode()).text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))

    def records(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, str], bytes]]:
        joiner, at = _Joiner(), None
        for batch in it:
            for value, file in zip(batch.column("value").to_pylist(), batch.column("file").to_pylist(), strict=True):
                if file != at:
                    yield from joiner.close()
                    at = file
                yield from joiner.feed(value)
        yield from joiner.close()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for h, block in records(it):
            if h.get("warc-type", "").lower() == "response":
                rows.append((h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-date"), block))
            if len(rows) >= 500:
                yield _response_batch(rows)
                rows = []
        if rows:
            yield _response_batch(rows)

    return map_arrow(cut, run, RESPONSE)


def _response_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([*[pa.array(list(c), pa.string()) for c in cols[:3]], pa.array(list(cols[3]), pa.binary())], names=["record_id", "target_uri", "warc_date", "block"])


def op6_warc_derivatives(spark, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of every page."""
    return derive(responses(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")), "page_id")
