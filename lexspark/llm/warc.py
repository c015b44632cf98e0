"""WARC derivatives: from each response a metadata record and a plain-text conversion record, linked to it.

A response is a row (id, target URI, date, HTTP header block, body). Its record id is derived from its content, so a
task that runs twice writes the same records. Both derivatives name the response in ``WARC-Refers-To`` and repeat its
target URI, date and digests; the metadata record also lists the HTTP headers, the title and the outgoing links.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
#: Names of the columns of a record, in order, with Spark types.
RECORD = "page_id long, record_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, content_length long, block_digest string, payload_digest string, source_headers string, block string"

_TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)\b")
#: Ends of elements whose content is no text.
_CLOSERS = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "title")}
#: Elements that end a line of text.
BLOCKS = frozenset("address article aside blockquote body br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split())
_TITLE = re.compile(r"<title\b", re.I)
_LINK = re.compile(r"<a\b", re.I)
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"[ \t\r\f\v]+")


def digest(data: bytes, algorithm: str = "sha256") -> str:
    """A labelled digest: sha1 in base 32, as is usual in WARC files, others in lower-case hex."""
    raw = hashlib.new(algorithm, data)
    return f"{algorithm}:" + (base64.b32encode(raw.digest()).decode() if algorithm == "sha1" else raw.hexdigest())


def record_id(*parts: str) -> str:
    """A name-based UUID (version 8) over the parts."""
    x = hashlib.sha256("\x00".join(parts).encode()).hexdigest()
    return f"<urn:uuid:{x[:8]}-{x[8:12]}-8{x[13:16]}-{'89ab'[int(x[16], 16) % 4]}{x[17:20]}-{x[20:32]}>"


class _Finder:
    """Searches for one thing at places that only go forward, so that all searches together take one pass."""

    def __init__(self, search: Callable[[int], tuple[int, int] | None]):
        self.search, self.found, self.asked = search, None, -1

    def __call__(self, at: int) -> tuple[int, int] | None:
        if self.asked < 0 or self.found is not None and self.found[0] < at:
            self.found = self.search(at)
        self.asked = at
        return self.found


def _ends(markup: str, what: str | re.Pattern) -> _Finder:
    if isinstance(what, str):
        return _Finder(lambda at: (x, x + len(what)) if (x := markup.find(what, at)) >= 0 else None)
    return _Finder(lambda at: m.span() if (m := what.search(markup, at)) else None)


def _tokens(markup: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, name of the tag or empty) of each token of markup: a comment, an element whose content is no text, a
    tag or a declaration. What never ends is no token. One pass, whatever the page."""
    bracket, comment = _ends(markup, ">"), _ends(markup, "-->")
    closers = {name: _ends(markup, _CLOSERS[name]) for name in ("script", "style")}
    at = markup.find("<")
    while at >= 0:
        end, name = None, ""
        if markup.startswith("<!--", at):
            end = comment(at + 4)
        elif tag := _TAG.match(markup, at):
            name = tag[1].lower()
            end = bracket(tag.end())
            if end and name in closers and markup[at + 1] != "/":
                if whole := closers[name](end[1]):
                    end, name = whole, ""
        if end is None and markup.startswith(("<!", "<?"), at):
            end = bracket(at + 2)
        if end:
            yield at, end[1], name
        at = markup.find("<", end[1] if end else at + 1)


def _without_markup(markup: str, breaks: frozenset[str] = frozenset()) -> str:
    out, at = [], 0
    for start, end, name in _tokens(markup):
        out += [markup[at:start], "\n" if name in breaks else ""]
        at = end
    return "".join(out) + markup[at:]


def plain_text(markup: str) -> str:
    """The text of a page: markup gone, block elements on lines of their own, entities decoded, blanks and empty lines
    folded. What a browser would not show (comments, scripts, styles) is left out."""
    lines = (_SPACE.sub(" ", line).strip(" ") for line in html.unescape(_without_markup(markup, BLOCKS)).split("\n"))
    return "\n".join(line for line in lines if line)


def page_title(markup: str) -> str:
    """The text of the first title; empty if that does not end, as then no later one does."""
    opens = _TITLE.search(markup)
    start = markup.find(">", opens.end()) + 1 if opens else 0
    closes = _CLOSERS["title"].search(markup, start) if start else None
    return " ".join(html.unescape(_without_markup(markup[start : closes.start()])).split()) if closes else ""


def page_links(markup: str) -> list[str]:
    """The targets of links as written, entities decoded and line ends gone, each once and in order."""
    out, at, href = {}, 0, None
    bracket = _ends(markup, ">")
    while link := _LINK.search(markup, at):
        at = link.end()
        limit = (bracket(at) or (len(markup),))[0]
        if href is None or href.start() < at:
            href = _HREF.search(markup, at)
            if href is None:
                break
        if href.start() < limit:
            at = href.end()
            if target := " ".join(html.unescape(href[1] or href[2] or href[3] or "").split()):
                out[target] = None
        else:
            at = limit
    return list(out)


def _one_line(value: str) -> str:
    return " ".join(value.split())


def serialize(record: dict, extra: tuple[tuple[str, str], ...] = ()) -> bytes:
    """The bytes of a record as they stand in a WARC file."""
    block = record["block"].encode("utf-8")
    fields = [("WARC-Type", record["record_type"]), ("WARC-Record-ID", record["record_id"]), ("WARC-Refers-To", record["refers_to"]), ("WARC-Target-URI", record["target_uri"]), ("WARC-Date", record["warc_date"]), ("WARC-Block-Digest", record["block_digest"]), ("WARC-Source-Payload-Digest", record["payload_digest"]), *extra, ("Content-Type", record["content_type"]), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields if v)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields, block) of each record of a WARC file, plain or with a gzip member for each record. A cut-off
    record raises ValueError."""
    data = gzip.decompress(data) if data.startswith(b"\x1f\x8b") else data
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
        fields = {name.strip(): value.strip() for name, colon, value in (line.partition(":") for line in lines) if colon}
        if len(fields) < len(lines) or not fields.get("Content-Length", "").isdecimal():
            raise ValueError(f"the header of the record at byte {at} is malformed")
        size = int(fields["Content-Length"])
        if data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut off")
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 8 + size


def _records(page_id: int | None, uri: str | None, date: str | None, headers: str | None, body: str | None, algorithm: str) -> Iterator[dict]:
    uri, date, headers, body = uri or "", date or "", headers or "", body or ""
    payload = digest(body.encode("utf-8"), algorithm)
    source = record_id("response", uri, date, headers, payload)
    named = [x.split(":", 1) for x in headers.replace("\r", "").split("\n")[1:] if ":" in x]
    facts = [("title", page_title(body)), *((f"http-{k.strip().lower()}", _one_line(v)) for k, v in named), *(("outlink", x) for x in page_links(body))]
    for kind, content_type, block in (("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in facts if v)), ("conversion", "text/plain; charset=UTF-8", plain_text(body))):
        data = block.encode("utf-8")
        yield {"page_id": page_id, "record_type": kind, "record_id": record_id(kind, source), "refers_to": source, "target_uri": uri, "warc_date": date, "content_type": content_type, "content_length": len(data), "block_digest": digest(data, algorithm), "payload_digest": payload, "source_headers": headers, "block": block}


def derive(responses: DataFrame, algorithm: str = "sha256") -> DataFrame:
    """Two records (columns ``RECORD``) for each row of ``responses`` (page_id, uri, warc_date, headers, body).

    ``refers_to`` is the id of the response and ``payload_digest`` the digest of its body, so a reader can check what a
    derivative was made from. Rows are converted one by one, without a shuffle; batches hold the memory down.

    Nulls count as empty strings (a null page_id stays null). An empty body gives an empty conversion record. Rows that
    repeat uri, date, headers and body are one response: their records carry equal ids, once for each row. Further
    columns are ignored, and an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                rows = [r for cells in zip(*(c.to_pylist() for c in batch.slice(start, 500).columns)) for r in _records(*cells, algorithm)]
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (x.split() for x in RECORD.split(", "))])
    columns = [F.col("page_id").cast("long"), *(F.col(c).cast("string") for c in ("uri", "warc_date", "headers", "body"))]
    return responses.select(*columns).mapInArrow(run, RECORD)


def responses(pages: DataFrame, warc_date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """``pages`` (page_id, url, html) as responses: one crawl date and the header block that the table stands for."""
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("\r\n"))
    return pages.select("page_id", F.col("url").alias("uri"), F.lit(warc_date).alias("warc_date"), headers.alias("headers"), F.col("html").alias("body"))


def write_warc(records: DataFrame, path: str) -> None:
    """Writes the bytes of ``records`` as rows (page_id, record), a gzip member for each record.

    Spark has no sink for raw bytes. The cells of a file, put one behind the other, are a WARC file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([r["page_id"] for r in rows], pa.int64()), pa.array([gzip.compress(serialize(r), mtime=0) for r in rows], pa.binary())], ["page_id", "record"])

    records.mapInArrow(run, "page_id long, record binary").write.parquet(path)
