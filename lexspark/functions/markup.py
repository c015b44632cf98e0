"""Clean-up of wiki text in time linear in the text, whatever is left unclosed in it.

Patterns with lazy middles look for the end of each opening marker anew; a text of openings without an end costs them the
square of its length. The scanners here go over a text once for each kind of markup: an end that is found is kept until
the scan has passed it, and once there is none, no later opening is tried.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Capitals of ASCII as small letters: lengths and places stay.
_SMALL = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: What separates a link's address from its label, or ends it.
_ADDRESS_END = re.compile(r"[ \t\n\x0b\f\r\]]")
_BLANKS = re.compile(r"[ \t\n\x0b\f\r]*")


def drop_between(text: str, start: str, end: str, by: str = " ") -> str:
    """``text`` with ``by`` for each ``start`` and what follows up to the next ``end``, that included."""
    out, at = [], 0
    while (s := text.find(start, at)) >= 0 and (e := text.find(end, s + len(start))) >= 0:
        out += [text[at:s], by]
        at = e + len(end)
    return "".join([*out, text[at:]])


def drop_references(text: str) -> str:
    """A blank for each reference: ``<ref``, anything up to ``>``, and on to ``</ref>``, in capitals or not."""
    small, out, at = text.translate(_SMALL), [], 0
    while (s := small.find("<ref", at)) >= 0 and (g := small.find(">", s + 4)) >= 0 and (e := small.find("</ref>", g + 1)) >= 0:
        out += [text[at:s], " "]
        at = e + 6
    return "".join([*out, text[at:]])


def drop_tags(text: str) -> str:
    """A blank for each ``<`` with at least one character before the next ``>``."""
    out, at, look = [], 0, 0
    while (s := text.find("<", look)) >= 0 and (e := text.find(">", s + 1)) >= 0:
        if e == s + 1:  # "<>" is no tag
            look = e
            continue
        out += [text[at:s], " "]
        at = look = e + 1
    return "".join([*out, text[at:]])


def label_links(text: str) -> str:
    """``[[target|label]]`` becomes its label: the target has no ``|``, neither has a ``]``."""
    out, at, look, bar, end = [], 0, 0, -1, -1
    while (s := text.find("[[", look)) >= 0:
        if end < s + 2 and (end := text.find("]", s + 2)) < 0:
            break
        if bar < s + 2 and (bar := text.find("|", s + 2)) < 0:
            break
        if bar == s + 2:  # no target; the next bracket may begin a link that has one
            look = s + 1
        elif bar + 1 < end and text.startswith("]]", end):
            out += [text[at:s], text[bar + 1 : end]]
            at = look = end + 2
        else:  # no opening before this bracket can do better
            look = end + 1
    return "".join([*out, text[at:]])


def plain_links(text: str) -> str:
    """``[[target]]`` becomes its target."""
    out, at, look, end = [], 0, 0, -1
    while (s := text.find("[[", look)) >= 0:
        if end < s + 2 and (end := text.find("]", s + 2)) < 0:
            break
        if end == s + 2:
            look = s + 1
        elif text.startswith("]]", end):
            out += [text[at:s], text[s + 2 : end]]
            at = look = end + 2
        else:
            look = end + 1
    return "".join([*out, text[at:]])


def web_links(text: str) -> str:
    """``[http://address label]`` becomes its label, or nothing without one."""
    out, at, look, stop, end = [], 0, 0, -1, -1
    while (s := text.find("[http", look)) >= 0:
        look = s + 1
        begin = s + 8 if text.startswith("://", s + 5) else s + 9 if text.startswith("s://", s + 5) else -1
        if begin < 0:
            continue
        if stop < begin:
            found = _ADDRESS_END.search(text, begin)
            if not found:
                break
            stop = found.start()
        if stop == begin:
            continue
        if text[stop] == "]":
            label, last = "", stop
        else:
            if end < stop and (end := text.find("]", stop)) < 0:
                break
            after = _BLANKS.match(text, stop, end).end()
            if after == end and end - stop == 1:
                continue  # a single blank is no label
            label, last = text[min(after, end - 1) : end], end
        out += [text[at:s], label]
        at = look = last + 1
    return "".join([*out, text[at:]])


def clean_markup(text: str) -> str:
    """Comments, references, tags, templates, links and quotes out of a wiki text, in this order."""
    text = drop_tags(drop_references(drop_between(text, "<!--", "-->")))
    text = web_links(plain_links(label_links(drop_between(text, "{{", "}}"))))
    return text.replace("'''", "").replace("''", "")


#: Texts that are Python's at a time.
_HELD = 256


@F.arrow_udf(StringType())
def _cleaned(s: pa.Array) -> pa.Array:
    done = []
    for at in range(0, len(s), _HELD):
        done.append(pa.array([None if x is None else clean_markup(x) for x in s.slice(at, _HELD).to_pylist()], pa.string()))
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def clean_wikitext(c: Column) -> Column:
    """``clean_markup`` of a column, and the ligature ew spelt out. Texts without any marker stay with the JVM; the others
    go to Python by Arrow batches, as no built-in function remembers that an end is missing."""
    marked = c.rlike(r"<|\{\{|\[|''")
    return F.replace(F.when(marked, _cleaned(F.when(marked, c))).otherwise(c), F.lit("և"), F.lit("եւ"))
