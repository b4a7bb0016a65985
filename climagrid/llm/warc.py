"""Derivatives of archived responses: linked metadata and plain-text conversion records.

``response_records`` makes a response record of each page, as a crawler would have stored it;
``derivatives`` reads response records back and writes, for each of them, a metadata
record and a conversion record. Both name the response in WARC-Refers-To, keep its target and its date,
carry the digest of their own block, and the metadata record keeps the response's HTTP
headers, payload digest and links. Everything is done row by row inside Arrow batches of bounded bytes; nothing is shuffled. Pages are
read in one pass, so that time grows with their length whatever tags they open and never close.

Defined results: a NULL url is written as ``about:blank``, a NULL or empty page gives an empty payload and an empty text;
equal rows give equal records; identifiers are name-based UUIDs of target, id and payload, so reruns agree. A record that
cannot be read back gets a metadata record with the error and no conversion. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html as html_entities
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from climagrid.llm.common import bound_batches

CRLF = b"\r\n"
DATE = "1970-01-01T00:00:00Z"
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-records")
_HIDDEN = re.compile(r"<(script|style|noscript|template|head)\b", re.I)
_CLOSE = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template", "head", "title")}
_TITLE = re.compile(r"<title\b", re.I)
_BLOCK = re.compile(
    r"</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|article|section|header|footer|nav|main|aside|blockquote|pre|form|hr)\b", re.I
)
_TAG_START = re.compile(r"<[!/?a-zA-Z]")
_ANCHOR = re.compile(r"<a\b", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_BARE = re.compile(r"[^\s>]+")
_BREAKS = re.compile(r"[\r\n]+")
# Single spaces stay as they are, so most words cost no replacement.
_SPACES = re.compile(r"[ \t\r\f\v\xa0]{2,}|[\t\r\f\v\xa0]")


def one_line(value: str) -> str:
    return _BREAKS.sub(" ", value) if "\n" in value or "\r" in value else value


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, chr(0).join(map(str, parts)))}>"


def build_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC/1.1 record; header values lose line breaks."""
    lines = ["WARC/1.1"] + [f"{k}: {one_line(v)}" for k, v in headers]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode()
    return head + CRLF * 2 + block + CRLF * 2


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block; raises ValueError when the record is malformed."""
    head, found, rest = data.partition(CRLF * 2)
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(headers.get("content-length", "-1"))
    if not 0 <= length <= len(rest) or rest[length:] != CRLF * 2:
        raise ValueError("Content-Length does not match the block")
    return headers, rest[:length]


def parse_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP response."""
    head, _, payload = block.partition(CRLF * 2)
    lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
    return lines[0], pairs, payload


class _Places:
    """Where something next occurs in a page. Questions must ascend; what was found or missed is not looked for again."""

    def __init__(self, page: str):
        self.page, self.known = page, {}

    def after(self, what: str | re.Pattern, start: int) -> tuple[int, int] | None:
        """Begin and end of the first occurrence from ``start``."""
        found = self.known.get(what, (-1, -1))
        if found is not None and found[0] < start:
            if isinstance(what, str):
                at = self.page.find(what, start)
                found = (at, at + len(what)) if at >= 0 else None
            else:
                match = what.search(self.page, start)
                found = match.span() if match else None
            self.known[what] = found
        return found


def visible(page: str) -> str:
    """The page without tags: hidden parts become a space, block tags a line break. One pass from left to right."""
    places, out, at = _Places(page), [], 0
    while True:
        tag = places.after(_TAG_START, at)
        if tag is None:
            break
        begin = tag[0]
        out.append(page[at:begin])
        if page.startswith("<!--", begin):
            closed = places.after("-->", begin + 4)
            if closed:
                out.append(" ")
                at = closed[1]
                continue
        end = places.after(">", begin)
        if end is None:
            at = begin
            break
        hidden = _HIDDEN.match(page, begin)
        closed = hidden and places.after(_CLOSE[hidden[1].lower()], end[1])
        if closed:
            out.append(" ")
            at = closed[1]
        else:
            if _BLOCK.match(page, begin):
                out.append("\n")
            at = end[1]
    out.append(page[at:])
    return "".join(out)


def title_of(page: str) -> str:
    """What stands in the first title element, without tags."""
    tag = _TITLE.search(page)
    end = page.find(">", tag.end()) if tag else -1
    closed = _CLOSE["title"].search(page, end) if end >= 0 else None
    return html_entities.unescape(visible(page[end + 1 : closed.start()])) if closed else ""


def links_of(page: str) -> list[str]:
    """The targets of the anchors, in order. One pass from left to right."""
    places, out, at = _Places(page), [], 0
    while True:
        anchor = places.after(_ANCHOR, at)
        if anchor is None:
            return out
        end = places.after(">", anchor[1])
        stop = end[0] if end else len(page)
        name = places.after(_HREF, anchor[1])
        if name is None:
            return out
        if name[0] >= stop:
            at = stop  # none up to there, so none for anchors inside
            continue
        at = name[1]
        quote = page[at : at + 1]
        closed = places.after(quote, at + 1) if quote in ("\"", "'") and quote else None
        bare = None if closed else _BARE.match(page, at)
        if closed:
            out.append(page[at + 1 : closed[0]])
            at = closed[1]
        elif bare:
            out.append(bare[0])
            at = bare.end()


def plain_text(page: str) -> tuple[str, str]:
    """Title and visible text: hidden parts go, block tags break lines, entities are resolved once."""
    body = visible(page)
    body = html_entities.unescape(body) if "&" in body else body
    lines = (line.strip() for line in _SPACES.sub(" ", body).split("\n"))
    return " ".join(title_of(page).split()), "\n".join(line for line in lines if line)


def response_of(page_id: object, url: str | None, page: str | None) -> tuple[str, bytes]:
    """Identifier and bytes of the response record of one page."""
    payload = (page or "").encode("utf-8", "surrogatepass")
    target = url or "about:blank"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    name = record_id("response", target, page_id, digest(payload))
    return name, build_record(
        [
            ("WARC-Type", "response"), ("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", target),
            ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(http)),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        http,
    )


FIELDS = "record_type string, record_id string, refers_to string, target_uri string, source_digest string, block_digest string"
SCHEMA = f"page_id long, {FIELDS}, content string, record binary"


def derive(page_id: object, data: bytes) -> list[tuple]:
    """The metadata and conversion records of one response record."""
    try:
        headers, block = parse_record(data)
        if headers.get("warc-type") != "response":
            raise ValueError("not a response")
        status, fields, payload = parse_http(block)
        source_digest = digest(payload)
        if headers.get("warc-payload-digest", source_digest) != source_digest:
            raise ValueError("payload digest does not match")
    except ValueError as error:
        body = f"error: {error}\r\n".encode()
        name = record_id("metadata", page_id, digest(data))
        record = build_record([("WARC-Type", "metadata"), ("WARC-Record-ID", name), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], body)
        return [(page_id, "metadata", name, None, None, digest(data), digest(body), body.decode(), record)]
    refers, target, date = headers.get("warc-record-id", ""), headers.get("warc-target-uri", ""), headers.get("warc-date", DATE)
    page = payload.decode("utf-8", "replace")
    title, text = plain_text(page)
    links = [html_entities.unescape(x) for x in links_of(page)]
    conversion, described = record_id("conversion", refers), record_id("metadata", refers)

    lines = [("status", status), *((f"http-{k.lower()}", v) for k, v in fields), ("payload-digest", source_digest)]
    lines += [("title", title), ("converted-to", conversion), *(("outlink", x) for x in links)]
    body = "".join(f"{k}: {one_line(v)}\r\n" for k, v in lines)
    out = []
    for kind, name, other, content_type, content in (
        ("metadata", described, conversion, "application/warc-fields", body),
        ("conversion", conversion, described, "text/plain; charset=utf-8", text),
    ):
        data = content.encode("utf-8", "replace")
        record = build_record(
            [
                ("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", date), ("WARC-Target-URI", target),
                ("WARC-Refers-To", refers), ("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", date),
                ("WARC-Concurrent-To", other), ("WARC-Payload-Digest" if kind == "conversion" else "WARC-Source-Digest", source_digest if kind == "metadata" else digest(data)),
                ("WARC-Block-Digest", digest(data)), ("Content-Type", content_type),
            ],
            data,
        )
        out.append((page_id, kind, name, refers, target, source_digest, digest(data), content, record))
    return out


def response_records(pages: DataFrame) -> DataFrame:
    """(page_id, record): a response record of each page."""

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [None if pd.isna(x) else int(x) for x in batch["page_id"]]
            rows = [response_of(i, u, h)[1] for i, u, h in zip(ids, batch["url"], batch["html"])]
            yield pd.DataFrame({"page_id": pd.array(ids, "Int64"), "record": rows})

    bound_batches(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInPandas(convert, "page_id long, record binary")


def derivatives(responses: DataFrame) -> DataFrame:
    """Metadata and conversion records of (page_id, record) rows, as fields and as bytes."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                row
                for i, data in zip(batch["page_id"], batch["record"])
                for row in derive(None if pd.isna(i) else int(i), bytes(data or b""))
            ]
            frame = pd.DataFrame(rows, columns=names)
            yield frame.assign(page_id=pd.array(frame["page_id"], "Int64"))

    bound_batches(responses.sparkSession)
    return responses.select("page_id", "record").mapInPandas(convert, SCHEMA)
