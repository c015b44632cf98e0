import random
import re
import time

import pytest

from lexspark.functions import markup

#: The clean-up by patterns, which are quadratic on unclosed markers.
PATTERNS = (
    (re.compile(r"<!--.*?-->", re.S), " "),
    (re.compile(r"<ref[^>]*>.*?</ref>", re.S | re.I | re.A), " "),
    (re.compile(r"<[^>]+>", re.S), " "),
    (re.compile(r"\{\{.*?\}\}", re.S), " "),
    (re.compile(r"\[\[([^|\]]+)\|([^\]]+)\]\]"), r"\2"),
    (re.compile(r"\[\[([^\]]+)\]\]"), r"\1"),
    (re.compile(r"\[https?://[^\s\]]+(?:\s+([^\]]+))?\]", re.A), lambda m: m[1] or ""),
    (re.compile("'''"), ""),
    (re.compile("''"), ""),
)
STEPS = (lambda t: markup.drop_between(t, "<!--", "-->"), markup.drop_references, markup.drop_tags, lambda t: markup.drop_between(t, "{{", "}}"), markup.label_links, markup.plain_links, markup.web_links, lambda t: t.replace("'''", ""), lambda t: t.replace("''", ""))
PARTS = ["<!--", "-->", "<!-->", "<ref", "<REF name=a>", "</ref>", "</Ref>", "<", ">", "<>", "<br/>", "{{", "}}", "{", "}", "[[", "]]", "[", "]", "|", "[http://", "[https://a", "http", " ", "\n", "\x0b", "é", "'", "''", "x", "yz", "[[a|b]]", "[[c]]", "[http://u  l]", "İ"]


@pytest.mark.parametrize("seed", range(40))
def test_scanners_equal_the_patterns(seed):
    pick = random.Random(seed)
    for _ in range(400):
        text = "".join(pick.choices(PARTS, k=pick.randrange(1, 25)))
        for (pattern, by), step in zip(PATTERNS, STEPS):
            assert step(text) == pattern.sub(by, text), (text, pattern.pattern)
            text = step(text)


@pytest.mark.parametrize(
    "unit, closing",
    [("<!--", ""), ("<ref>", ""), ("<ref", ""), ("<ref ", "</ref>"), ("<", ""), ("{{", ""), ("[[", ""), ("[", "a]]"), ("[[", "]"), ("[[a|b", ""), ("[[a|b", "]x"), ("[[|", "]]"), ("[http://a", ""), ("[http://a ", ""), ("[http://a ", "x"), ("[http://", "]"), ("[https://a\n", "]"), ("<>", ""), ("]]", ""), ("}}", ""), ("<!-->", "")],
)
def test_five_megabytes_without_an_end_take_seconds(unit, closing):
    text = unit * (5_000_000 // len(unit)) + closing
    start = time.perf_counter()
    markup.clean_markup(text)
    assert time.perf_counter() - start < 5


def test_columns(spark):
    rows = spark.createDataFrame([(0, None), (1, ""), (2, "plain և"), (3, "a<!-- x -->b [[c|d]] {{t}} '''e''' [http://x y z]"), (4, "<ref>r</ref>և")], "k int, t string")
    got = {r.k: r.c for r in rows.select("k", markup.clean_wikitext(rows.t).alias("c")).collect()}
    assert got == {0: None, 1: "", 2: "plain եւ", 3: "a b d   e y z", 4: " եւ"}


def test_texts_in_slices():
    import tracemalloc

    import pyarrow as pa

    # Arrow in and out: of a batch of 30 MB in two-byte characters only a slice is Python's at a time
    texts = pa.array([None if i % 100 == 7 else f"<b>{'տ' * 5000} {i}</b> [[a|b]] և" for i in range(3000)])
    tracemalloc.start()
    out = markup._cleaned.func(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 10_000_000 and out.null_count == 30
    assert out[8].as_py() == markup.clean_markup(texts[8].as_py()) and out[7].as_py() is None and len(out) == 3000
    assert markup._cleaned.func(pa.array([], pa.string())).to_pylist() == []
