"""Text functions over columns. Everything is built in, except where a comment names a reason for Arrow."""

from __future__ import annotations

import html
import re
import unicodedata
from html.parser import HTMLParser
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: The parts of speech that a query suffix may name.
UD_TAGS = ("NOUN", "VERB", "ADJ", "ADV", "PROPN", "PRON", "DET", "ADP", "CONJ", "SCONJ", "CCONJ", "NUM", "PART", "INTJ", "AUX")
#: What Python's ``str.strip`` takes away.
WHITE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Where Python's ``str.splitlines`` breaks.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def strip(c: Column) -> Column:
    """White space of Unicode off both ends; Spark's ``trim`` only knows the space."""
    return F.btrim(c, F.lit(WHITE))


def split_lines(c: Column) -> Column:
    """The lines of a text; a break at its end opens no line, an empty text has none."""
    parts = F.split(c, LINE_BREAK, -1)
    return F.when(c == "", F.array().cast("array<string>")).when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def parse_int(c: Column) -> Column:
    """A decimal integer with a sign, padding and single underscores between digits; null if it is none."""
    s = strip(c)
    return F.when(s.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.replace(s, F.lit("_"), F.lit("")).try_cast("bigint"))


@F.pandas_udf(StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    """Entities of HTML; Spark has no function for the table of names."""
    return s.map(lambda x: html.unescape(x) if x and "&" in x else x, na_action="ignore")


def strip_html(c: Column) -> Column:
    """Entities first, then whatever looks like a tag; so written-out tags go as well. Null gives an empty text."""
    return F.regexp_replace(F.coalesce(html_unescape(c), F.lit("")), "<[^>]+>", "")


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def parsed_text(markup: str | None) -> str:
    """Text nodes of a parser that is fed but never closed, white space folded.

    What the parser still holds back at the end (after an ``&`` or ``<`` that may go on) is lost.
    """
    if not markup:
        return ""
    parser = _Text()
    parser.feed(markup)
    return " ".join("".join(parser.parts).split())


@F.pandas_udf(StringType())
def strip_html_parsed(s: pd.Series) -> pd.Series:
    """``parsed_text`` by Arrow batches: tokenising HTML is beyond a regular expression."""
    return s.map(lambda x: parsed_text(x) if isinstance(x, str) else "")


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Canonical composition; Spark has no function for it."""
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def strip_query_suffix(token: Column) -> Column:
    """``years_NOUN`` to ``years``: a known tag of any case after the last underscore, if something is before it."""
    return F.regexp_replace(token, rf"(?is)^(.+)_({'|'.join(UD_TAGS)})$", "$1")


def normalize_term(term: Column) -> Column:
    """Strips, then takes off the last underscore and two to six capitals after it, even if nothing is left."""
    return F.regexp_replace(strip(F.coalesce(term, F.lit(""))), r"(?s)^(.*)_\p{Lu}{2,6}$", "$1")


def url_title(word: Column) -> Column:
    """Percent-encoded but for unreserved characters; unchanged if each ``%`` already starts an escape."""
    plain = F.replace(F.replace(F.replace(F.url_encode(word), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    return F.when(word.contains("%") & ~word.rlike("%(?![0-9A-Fa-f]{2})"), word).otherwise(plain)


def url_title_plain(word: str) -> str:
    """The same for a single string."""
    return word if "%" in word and not re.search("%(?![0-9A-Fa-f]{2})", word) else quote(word, safe="")


def upper_first(c: Column) -> Column:
    """The first character in upper case, the rest as it is."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.substr(c, F.lit(2)))


def capitalize(c: Column) -> Column:
    """The first character in upper case, the rest in lower case."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def lang_tag(c: Column) -> Column:
    return F.translate(F.upper(c), " -", "__")


def normalize_title(c: Column) -> Column:
    """Without byte-order marks and zero-width spaces, stripped."""
    return strip(F.translate(c, "﻿​", ""))


def normalized_length(c: Column) -> Column:
    """Characters, the Armenian ligature ew counted as two."""
    return F.char_length(F.replace(c, F.lit("և"), F.lit("եւ")))


def armenian_words(c: Column, least: int = 4, most: int = 7) -> Column:
    """Lower-case runs of Armenian letters, of 4 to 7 letters whatever wider window is asked for."""
    words = F.transform(F.regexp_extract_all(c, F.lit("([Ա-Ֆա-ֆ]+)"), F.lit(1)), F.lower)
    return F.filter(words, lambda w: F.char_length(w).between(max(least, 4), min(most, 7)))


#: White space and Latin punctuation, which separate words.
WORD_SPLIT = r"""[ \t\r\n\f\x0b!"#$%&'()*+,\-./:;<=>?@\[\]^_`{|}~]+"""


def tokenize_words(c: Column) -> Column:
    return F.filter(F.split(c, WORD_SPLIT), lambda w: w != "")


def first_word_form(line: Column) -> Column:
    """What stands before the first space, tab, full stop, comma, colon or hyphen."""
    return F.regexp_extract(line, r"^([^ \t.,:-]*)", 1)


def apply_boost(count: Column, boosted: Column) -> Column:
    """Digits padded on the right with zeros to five, for boosted words with fewer."""
    s = count.cast("string")
    return F.when(boosted & (F.char_length(s) < 5), F.rpad(s, 5, "0")).otherwise(s).cast("bigint")


def line_word(line: Column) -> Column:
    """The word of a dictionary line: up to its first space."""
    return F.when(line.contains(" "), F.substring_index(line, " ", 1)).otherwise("")


def line_count(line: Column) -> Column:
    """The count of a dictionary line ``word count,tag,definition``; 0 if there is none."""
    rest = F.when(line.contains(" "), F.regexp_extract(line, "(?s)^[^ ]* (.*)$", 1))
    return F.coalesce(parse_int(F.substring_index(rest, ",", 1)), F.lit(0).cast("bigint"))


def make_dictionary_line(line: Column) -> Column:
    """The first comma becomes a space."""
    return F.regexp_replace(line, "^([^,]*),", "$1 ")


def repair_pos_quote(line: Column) -> Column:
    """Puts the missing quote behind the value of ``"POS"`` of a broken record."""
    return F.regexp_replace(line, '"POS":"([^"]*),"', '"POS":"$1","')


def remove_braces(text: str) -> str:
    """A text without what stands in double braces, nested or not; unclosed ones take the rest, stray ends go."""
    out, depth, at = [], 0, 0
    for m in re.finditer(r"\{\{|\}\}", text):
        if not depth:
            out.append(text[at : m.start()])
        depth = depth + 1 if m[0] == "{{" else max(0, depth - 1)
        at = m.end()
    if not depth:
        out.append(text[at:])
    return "".join(out)
