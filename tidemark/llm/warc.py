"""WARC derivatives: metadata and plain-text conversion records of response records.

responses_of() reads the response records of WARC files; response() makes one for a stored page, which has neither
headers nor a date of its own. Each response gives two records that refer to it (WARC-Refers-To): a metadata record
(JSON with the source headers of the record and of HTTP, the response's digests, title, language and links) and a
conversion record (text/plain). Digests are sha1 in base 32, as WARC-Block-Digest and WARC-Payload-Digest have them.
Digests that the source record has are kept and compared, and metadata says whether they hold. Records can be written to
and read from WARC/1.1 bytes, one gzip member each.

Null html counts as an empty payload, a null url as an empty target. Rows are converted one by one, so repeated rows
give repeated records (record ids follow from page_id, url and payload). Other columns don't matter. Work is linear in
the page, unclosed tags included: a tag without an end goes to the end of the page, and an end that was once looked for
in vain is not looked for again.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ._text import small_batches, utf8

DATE = "2024-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
#: What can stand in a head, besides what is hidden with its content.
_IN_HEAD = re.compile(r"\s+|</?(?:meta|link|base)\b[^>]*(?:>|\Z)|<(?:(title|script|style|noscript|template)\b|!--)", re.I)
_HEAD = re.compile(r"<head\b[^>]*(?:>|\Z)", re.I)
_HIDDEN = re.compile(r"<(?:(script|style|noscript|template|title|head)\b|!--)", re.I)
_CLOSE = {k: re.compile(rf"</{k}\s*>", re.I) for k in ("script", "style", "noscript", "template", "title", "head")} | {"": re.compile("-->")}
_BREAK = re.compile(r"</?(?:p|br|div|li|ul|ol|tr|table|h[1-6]|article|section|nav|header|footer|main|aside|blockquote|pre|td|th|dd|dt)\b[^>]*(?:>|\Z)", re.I)
_TAG = re.compile(r"</?[a-zA-Z!?][^>]*(?:>|\Z)")
_TITLE, _TITLE_END = re.compile(r"<title[^>]*(?:>|\Z)", re.I), re.compile(r"</title", re.I)
_HTML, _LANG = re.compile(r"<html\b[^>]*(?:>|\Z)", re.I), re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
_A, _HREF = re.compile(r"<a\b[^>]*(?:>|\Z)", re.I), re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
RECORDS = "page_id long, record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, content_length long, block_digest string, payload_digest string, content string"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, '|'.join(map(str, parts)))}>"


def visible(page: str) -> str:
    """The page with a blank for each script, style, title, comment, head and the like. One without an end goes to the end of the page; a head without one ends before what can't be in it: body, another element, or text."""
    endless: set[str] = set()

    def end_of(kind: str, at: int) -> int:
        close = None if kind in endless else _CLOSE[kind].search(page, at)
        if close:
            return close.end()
        endless.add(kind)
        return len(page)

    out, at = [], 0
    while m := _HIDDEN.search(page, at):
        out += [page[at : m.start()], " "]
        kind = (m[1] or "").lower()
        at = end_of(kind, m.end())
        if kind == "head" and kind in endless:
            at = _HEAD.match(page, m.start()).end()
            while inner := _IN_HEAD.match(page, at):
                hidden = inner[1] is not None or inner[0] == "<!--"
                at = end_of((inner[1] or "").lower(), inner.end()) if hidden else inner.end()
    return "".join([*out, page[at:]])


def plain_text(page: str) -> str:
    """The visible text: without scripts, styles, comments and tags; blocks are lines; white space in lines is one space."""
    t = _TAG.sub("", _BREAK.sub("\n", visible(page)))
    lines = (" ".join(entities.unescape(line).split()) for line in t.split("\n"))
    return "\n".join(line for line in lines if line)


def title_of(page: str) -> str | None:
    start = _TITLE.search(page)
    end = start and _TITLE_END.search(page, start.end())
    return " ".join(entities.unescape(page[start.end() : end.start()]).split()) if end else None


def links_of(page: str, base: str) -> list[str]:
    """What the a elements refer to, joined to base."""
    out = []
    for tag in _A.finditer(page):
        m = _HREF.search(tag[0])
        if m is None:
            continue
        href = entities.unescape(next(x for x in m.groups() if x is not None))
        try:
            out.append(urljoin(base, href))
        except ValueError:
            out.append(href)
    return out


def response(page_id, url: str, payload: bytes, date: str = DATE) -> dict:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return {"record_id": record_id("response", page_id, url, hashlib.sha1(payload).hexdigest()), "target_uri": url, "date": date, "http": http, "payload": payload}


def headers_of(http: bytes) -> tuple[str, dict[str, str]]:
    """Status line and headers; of a name that is there more than once the values are joined."""
    status, *lines = http.decode("latin-1").strip().split("\r\n")
    out: dict[str, str] = {}
    for line in lines:
        k, _, v = line.partition(":")
        k, v = k.strip(), v.strip()
        out[k] = f"{out[k]}, {v}" if k in out else v
    return status, out


def _unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            n = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return body
        if not n:
            break
        out.append(body[end + 2 : end + 2 + n])
        at = end + 4 + n
    return b"".join(out)


def page_of(payload: bytes, headers: dict[str, str]) -> str:
    """The payload as text, without transfer and content codings; what can't be decoded is replaced."""
    low = {k.lower(): v for k, v in headers.items()}
    if "chunked" in low.get("transfer-encoding", "").lower():
        payload = _unchunked(payload)
    coding = low.get("content-encoding", "").lower()
    if coding in ("gzip", "x-gzip", "deflate"):
        try:
            payload = zlib.decompressobj(47).decompress(payload)  # as far as it goes
        except zlib.error:
            pass
    named = _CHARSET.search(low.get("content-type", "")) or _CHARSET.search(payload[:1024].decode("latin-1"))
    try:
        return payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derived(r: dict) -> list[dict]:
    """The metadata and the conversion record of one response."""
    status, headers = headers_of(r["http"])
    page = page_of(r["payload"], headers)
    payload_digest, block_digest = digest(r["payload"]), digest(r["http"] + r["payload"])
    envelope = {"record_id": r["record_id"], "target_uri": r["target_uri"], "date": r["date"], "block_digest": block_digest, "payload_digest": payload_digest, "payload_length": len(r["payload"])}
    if r.get("warc"):
        envelope["warc"] = r["warc"]
        envelope["digests_hold"] = all(r["warc"].get(k, v) == v for k, v in (("WARC-Block-Digest", block_digest), ("WARC-Payload-Digest", payload_digest)))
    html = _HTML.search(page)
    lang = html and _LANG.search(html[0])
    meta = {"envelope": envelope, "http": {"status": status, "headers": headers}, "html": {"title": title_of(page), "lang": lang[1] if lang else None, "links": links_of(page, r["target_uri"])}}
    out = []
    for kind, content_type, content in (("metadata", "application/json", json.dumps(meta, ensure_ascii=False, sort_keys=True)), ("conversion", "text/plain", plain_text(page))):
        block = content.encode("utf-8", "replace")
        out.append(
            {
                "record_type": kind,
                "record_id": record_id(kind, r["record_id"]),
                "refers_to": r["record_id"],
                "target_uri": r["target_uri"],
                "date": r["date"],
                "content_type": content_type,
                "content_length": len(block),
                "block_digest": digest(block),
                "payload_digest": payload_digest,
                "content": content,
            }
        )
    return out


def to_bytes(record: dict) -> bytes:
    """A record as WARC/1.1, one gzip member."""
    block = record["content"].encode("utf-8", "replace")
    fields = {
        "WARC-Type": record["record_type"],
        "WARC-Record-ID": record["record_id"],
        "WARC-Refers-To": record["refers_to"],
        "WARC-Target-URI": record["target_uri"],
        "WARC-Date": record["date"],
        "WARC-Block-Digest": record["block_digest"],
        "WARC-Payload-Digest": record["payload_digest"],
        "Content-Type": record["content_type"],
        "Content-Length": str(len(block)),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", mtime=0)


def read_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names as standard spells them, whatever their case) and block of each record of a stream, plain or of gzip members; one record is held at a time."""
    stream = stream if hasattr(stream, "peek") else io.BufferedReader(stream)
    if stream.peek(2)[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        fields: dict[str, str] = {}
        last = None
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[:1] in " \t" and last:
                fields[last] += " " + text.strip()
                continue
            name, _, value = text.partition(":")
            last = _STANDARD.get(name.strip().lower(), name.strip())
            fields[last] = value.strip()
        n = int(fields["Content-Length"])
        block = stream.read(n)
        if len(block) < n:
            raise ValueError(f"a record of {n} bytes ends after {len(block)}")
        yield fields, block


#: Names of fields as the standard spells them.
_NAMES = ("WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Date", "WARC-Block-Digest", "WARC-Payload-Digest", "Content-Type", "Content-Length")
_STANDARD = {n.lower(): n for n in _NAMES}


def from_bytes(data: bytes) -> Iterator[dict]:
    """Records, as to_bytes() takes them, of gzip members that follow each other."""
    for f, block in read_records(io.BytesIO(data)):
        yield {
            "record_type": f["WARC-Type"],
            "record_id": f["WARC-Record-ID"],
            "refers_to": f.get("WARC-Refers-To"),
            "target_uri": f.get("WARC-Target-URI"),
            "date": f["WARC-Date"],
            "content_type": f.get("Content-Type"),
            "content_length": len(block),
            "block_digest": f.get("WARC-Block-Digest"),
            "payload_digest": f.get("WARC-Payload-Digest"),
            "content": block.decode("utf-8", "replace"),
        }


def responses_in(data: bytes) -> Iterator[dict]:
    """The response records of a file's bytes, as derived() takes them."""
    for f, block in read_records(io.BytesIO(data)):
        if f.get("WARC-Type", "").lower() != "response" or not f.get("Content-Type", "").lower().startswith("application/http"):
            continue
        head, mark, payload = block.partition(b"\r\n\r\n")
        yield {"record_id": f["WARC-Record-ID"], "target_uri": f.get("WARC-Target-URI", "").strip("<>"), "date": f.get("WARC-Date"), "http": head + mark, "payload": payload, "warc": f}


_COLUMNS = [c.split()[0] for c in RECORDS.split(", ")]
_KINDS = {"long": pa.int64(), "string": pa.string()}


def _table(records: list[tuple[int | None, dict]]) -> pa.RecordBatch:
    rows = [[i if n == "page_id" else r[n] for i, r in records] for n in _COLUMNS]
    return pa.RecordBatch.from_arrays([pa.array(x, _KINDS[c.split()[1]]) for x, c in zip(rows, RECORDS.split(", "), strict=True)], _COLUMNS)


def derivatives_of_files(spark: SparkSession, path: str, held: int = 64) -> DataFrame:
    """RECORDS (page_id null) for the response records of the WARC files under path, in any store that Spark reads. A file is one row, so files should be of some hundred MB at most; its records are read one by one and handed on `held` at a time."""

    def convert(batches):
        for batch in batches:
            for data in batch.column(0):
                made = []
                for r in responses_in(data.as_py()):
                    made += [(None, d) for d in derived(r)]
                    if len(made) >= 2 * held:
                        yield _table(made)
                        made = []
                yield _table(made)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(convert, RECORDS)


def members(records: DataFrame) -> DataFrame:
    """record_id and member: each record of RECORDS as a gzip member of WARC/1.1, to be put one after the other in files."""

    def write(batches):
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([r["record_id"] for r in rows], pa.string()), pa.array([to_bytes(r) for r in rows], pa.binary())], ["record_id", "member"])

    return records.select(*_COLUMNS).mapInArrow(write, "record_id string, member binary")


def derivatives(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = DATE) -> DataFrame:
    """RECORDS: two rows per row of pages, by way of its response record."""
    def convert(batches):
        for batch in small_batches(batches, 1 << 20):
            pages_ = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True)
            yield _table([(i, r) for i, u, payload in pages_ for r in derived(response(i, u or "", payload, date))])

    return pages.selectExpr(f"CAST({page_id} AS long) AS page_id", f"{url} AS url", f"{html} AS text").mapInArrow(convert, RECORDS)
