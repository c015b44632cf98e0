import hashlib
import random
import re
import time

import pytest

from lexspark.llm import warc

HTML = """<!DOCTYPE html><html><head><title>A &amp; <b>B</b></title><style>p{x:y}</style><script>var t="</p>";</script></head>
<body><!-- no <p>text</p> --><h1>Hi&nbsp;there</h1><p>one<br>two  three&lt;x&gt;</p><a class=q href="/a?x=1&amp;y=2">in</a><a HREF='http://b.example/'>out</a><a href=/c>c</a><a href="/c">again</a></body></html>"""


def test_text_title_links():
    assert warc.plain_text(HTML) == "A & B\nHi\xa0there\none\ntwo three<x>\ninoutcagain"
    assert warc.page_title(HTML) == "A & B"
    assert warc.page_links(HTML) == ["/a?x=1&y=2", "http://b.example/", "/c"]
    assert warc.plain_text("") == "" and warc.plain_text("a < b") == "a < b"


# What the scanner means, as patterns; they take quadratic time on pages whose tags never end.
MARKUP = re.compile(r"<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>|</?([a-zA-Z][a-zA-Z0-9]*)\b[^>]*>|<[!?][^>]*>", re.S | re.I)
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
LINK = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.S | re.I)
PIECES = ["<!--", "-->", "<!", "<?", "<script", "<SCRIPT>", "</script>", "</script >", "<style>", "</style", "<title", "<title>", "</title>", "<a ", "<a", "<A\n", "href", "href=", ' href="', " href='", '"', "'", "x", "é", "_", "1", ">", "<", " ", "/", "<br>", "<p a=b>", "</p>", "ahref=q"]


def test_scanner_is_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        page = "".join(rng.choices(PIECES, k=rng.randrange(1, 14)))
        assert warc._without_markup(page, warc.BLOCKS) == MARKUP.sub(lambda m: "\n" if (m[2] or "").lower() in warc.BLOCKS else "", page), page
        title = TITLE.search(page)
        assert warc.page_title(page) == (" ".join(MARKUP.sub("", title[1]).split()) if title else ""), page
        assert warc.page_links(page) == list(dict.fromkeys(x for m in LINK.finditer(page) if (x := " ".join((m[1] or m[2] or m[3] or "").split())))), page


@pytest.mark.parametrize("piece", ["<!--", "<script>", "<script", "<style>", "<title>", "<title", "<a ", "<a>", "<a href=", "<a href='", "<a href ", "</script ", "<!", "<", "&", "&#", "<p>x", "<a x>", "<a href=y>", "href=", "-->", "<a " + "a" * 50])
def test_long_pages_take_linear_time(piece):
    page, begun = piece * (5_000_000 // len(piece)), time.process_time()
    warc.plain_text(page), warc.page_title(page), warc.page_links(page)
    assert time.process_time() - begun < 20


def test_malformed_headers():
    good = b"WARC/1.1\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    assert list(warc.parse(good.replace(b": ", b":"))) == list(warc.parse(good)) == [({"Content-Length": "1"}, b"x")]
    for head in (b"WARC/1.1\r\nContent-Length 1\r\n\r\nx\r\n\r\n", b"WARC/1.1\r\nContent-Length: -1\r\n\r\nx\r\n\r\n", b"WARC/1.1\r\nA: b\r\n\r\n\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.parse(head))


def test_records(spark, tmp_path):
    rows = [(1, "http://a.example/", HTML, "z"), (2, None, None, "z"), (None, "http://a.example/", HTML, "z"), (3, "http://l.example/", "<p>" + "long " * 200_000, "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    out = [r.asDict() for r in warc.derive(warc.responses(pages)).collect()]
    assert len(out) == 8
    for r in out:
        block = r["block"].encode()
        assert r["content_length"] == len(block) and r["block_digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
    one = {r["record_type"]: r for r in out if r["page_id"] == 1}
    assert one["metadata"]["refers_to"] == one["conversion"]["refers_to"] != one["metadata"]["record_id"] != one["conversion"]["record_id"]
    assert one["conversion"]["payload_digest"] == "sha256:" + hashlib.sha256(HTML.encode()).hexdigest()
    assert one["conversion"]["block"] == warc.plain_text(HTML)
    assert "http-content-type: text/html; charset=UTF-8\r\n" in one["metadata"]["block"] and "outlink: /c\r\n" in one["metadata"]["block"]
    again = [r for r in out if r["page_id"] is None]
    assert {r["record_id"] for r in again} == {r["record_id"] for r in one.values()}
    assert [r["block"] for r in out if r["page_id"] == 2 and r["record_type"] == "conversion"] == [""]
    assert warc.derive(warc.responses(pages.limit(0))).collect() == []

    data = b"".join(warc.serialize(r) for r in out)
    back = list(warc.parse(data))
    assert [(f["WARC-Record-ID"], b.decode()) for f, b in back] == [(r["record_id"], r["block"]) for r in out]
    assert all(int(f["Content-Length"]) == len(b) and f["WARC-Refers-To"] == r["refers_to"] for (f, b), r in zip(back, out))
    warc.write_warc(warc.derive(warc.responses(pages)), str(tmp_path / "w"))
    cells = [bytes(r.record) for r in spark.read.parquet(str(tmp_path / "w")).collect()]
    assert sorted(f["WARC-Record-ID"] for f, _ in warc.parse(b"".join(cells))) == sorted(r["record_id"] for r in out)
    with pytest.raises(ValueError):
        list(warc.parse(data[:-30]))


def test_digest_labels():
    assert warc.digest(b"", "sha1") == "sha1:3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
