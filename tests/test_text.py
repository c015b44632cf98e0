import html
import re
import unicodedata
from html.parser import HTMLParser
from urllib.parse import quote

from pyspark.sql import functions as F

from lexspark.functions import markup
from lexspark.functions import text as T


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.o for r in rows.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_strip_and_lines(spark):
    odd = ["", " a ", "\t\x1c\x85 x y　\n", "a\x0bb", "​x", "\xa0", "a\r\nb\n\nc", "\n", "a ", "x\x1ey\x0cz"]
    assert column(spark, odd, T.strip) == [s.strip() for s in odd]
    assert column(spark, odd, T.split_lines) == [s.splitlines() for s in odd]


def test_parse_int(spark):
    values = ["1", " 12 ", "+5", "-7", "1_000", "1__0", "_1", "1_", "", "x", "3.7", None, "0012"]

    def python(s):
        try:
            return int(s)
        except (TypeError, ValueError):
            return None

    assert column(spark, values, T.parse_int) == [python(s) for s in values]


def test_html(spark):
    values = [None, "", "a &amp; b", "&lt;b&gt;x&lt;/b&gt;", "<p>one</p><p>two</p>", "AT&T", "a <b", "&eacute;&#233;&#xe9;", "x < y > z", "<!-- c -->t<script>s</script>", "a\n\n b"]
    assert column(spark, values, T.strip_html) == [re.sub("<[^>]+>", "", html.unescape(s or "")) for s in values]

    class Parser(HTMLParser):
        def handle_data(self, data):
            self.out = getattr(self, "out", "") + data

    def parsed(s):
        p = Parser()
        p.feed(s or "")
        return re.sub(r"\s+", " ", getattr(p, "out", "")).strip()

    assert column(spark, values, T.strip_html_parsed) == [parsed(s) for s in values]
    assert parsed("AT&T") == "" and parsed("a <b") == "a"


def test_suffixes(spark):
    values = ["years_NOUN", "foo_bar", "foo_XYZ", "foo_noun", "_NOUN", "a_b_VERB", "plain", "x_", "plus_ADV", " y_ADJ ", "z_A", "z_ABCDEFG", "w_É"]

    assert column(spark, values, T.strip_query_suffix) == ["years", "foo_bar", "foo_XYZ", "foo", "_NOUN", "a_b", "plain", "x_", "plus", " y_ADJ ", "z_A", "z_ABCDEFG", "w_É"]
    assert column(spark, values, T.normalize_term) == ["years", "foo_bar", "foo", "foo_noun", "", "a_b", "plain", "x_", "plus", "y", "z_A", "z_ABCDEFG", "w_É"]


def test_url_title(spark):
    values = ["a b", "a+b*~c", "100%", "a%20b", "a%20b%", "été/x?y#z", "", "%zz"]
    want = [v if "%" in v and not re.search("%(?![0-9A-Fa-f]{2})", v) else quote(v, safe="") for v in values]
    assert column(spark, values, T.url_title) == want == [T.url_title_plain(v) for v in values]


def test_case(spark):
    values = ["hello World", "ÉTÉ", "x", "", "ab CD"]
    assert column(spark, values, T.upper_first) == [v[:1].upper() + v[1:] for v in values]
    assert column(spark, values, T.capitalize) == [v.capitalize() for v in values]
    assert column(spark, ["Old French", "anglo-norman"], T.lang_tag) == ["OLD_FRENCH", "ANGLO_NORMAN"]


def test_titles(spark):
    assert column(spark, ["﻿ տուն​ ", None], T.normalize_title) == ["տուն", None]
    assert column(spark, ["և", "տուն"], T.normalized_length) == [2, 4]


def test_wikitext(spark):
    cases = {
        "a<!-- x\ny -->b": "a b",
        "<REF name=a>x</ref>y": " y",
        "{{a{{b}}c}}": " c}}",
        "[[a|b]] [[c]] [http://x y z] [http://x]": "b c y z ",
        "'''b''' ''i'' ''''": "b i '",
        "և": "եւ",
        "<ref/>gone</ref>z": " z",
    }
    assert column(spark, list(cases), markup.clean_wikitext) == list(cases.values())
    assert column(spark, ["Տուն տունեւ ab տո երկարաբառություն"], T.armenian_words) == [["տուն", "տունեւ"]]


def test_small_ones(spark):
    assert column(spark, ["[[հինգ]]ից a,b"], T.tokenize_words) == [["հինգ", "ից", "a", "b"]]
    assert column(spark, ["word, x", "a-b", " lead", "x:y", "tab\tz", ""], T.first_word_form) == ["word", "a", "", "x", "tab", ""]
    assert column(spark, [3, 241, 12345, 123456], lambda c: T.apply_boost(c, F.lit(True)), "long") == [30000, 24100, 12345, 123456]
    assert column(spark, ["w 12,N,d", "w x,N", "w", "a b 3,T"], T.line_count) == [12, 0, 0, 0]
    assert column(spark, ["w 12,N,d", "w"], T.line_word) == ["w", ""]
    assert column(spark, ["a,b,c", "x"], T.make_dictionary_line) == ["a b,c", "x"]
    assert column(spark, ['{"POS":"NN,"features":"x"}'], T.repair_pos_quote) == ['{"POS":"NN","features":"x"}']
    assert column(spark, ["שָׁ", None], T.nfc) == [unicodedata.normalize("NFC", "שָׁ"), None]


def test_braces():
    cases = {"a{{b}}c": "ac", "foo {{bar {{baz}} qux}} zip": "foo  zip", "a{{b": "a", "a}}b": "ab", "{{a}}}}b{{": "b", "{a}{{{b}}}c": "{a}}c", "{{{{x}}y": "", "": ""}
    assert {t: T.remove_braces(t) for t in cases} == cases
