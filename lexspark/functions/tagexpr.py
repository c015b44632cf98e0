"""A small language of conditions on tagged words, compiled to a column.

``NOUN & !([e$] | RARE)``: tags are capitals, digits and underscores; ``[...]`` is a regular expression that is looked
for in the word; ``!`` binds closest, then ``&``, then ``|``; both associate to the left. An empty expression is true.
Logic has two values: a missing tag, word or set of tags is false, so its negation is true.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


class TagExpressionError(ValueError):
    """The expression cannot be read."""


_TOKEN = re.compile(r"\s*(?:(?P<tag>[A-Z0-9_]+)|\[(?P<regex>[^\]]*)\]|(?P<op>[!&|()]))")


@dataclass(frozen=True)
class Token:
    kind: str
    text: str
    at: int


def tokens(expression: str) -> list[Token]:
    out, at = [], 0
    expression = expression.rstrip()
    while at < len(expression):
        m = _TOKEN.match(expression, at)
        if not m:
            raise TagExpressionError(f"unexpected text at {at}: {expression[at:at + 10]!r}")
        out.append(Token(m.lastgroup, m[m.lastgroup], m.start(m.lastgroup)))
        at = m.end()
    return out


def java_regex(pattern: str) -> str:
    """The pattern for the JVM, which then takes ``\\w``, ``\\b`` and ``\\s`` by Unicode as Python does."""
    try:
        re.compile(pattern)
    except re.error as e:
        raise TagExpressionError(f"bad regular expression [{pattern}]: {e}") from e
    if re.search(r"\(\?\(", pattern):
        raise TagExpressionError(f"conditional groups are not supported: [{pattern}]")
    pattern = re.sub(r"\(\?P<([A-Za-z]\w*)>", r"(?<\1>", pattern)
    pattern = re.sub(r"\(\?P=([A-Za-z]\w*)\)", r"\\k<\1>", pattern)
    return "(?U)" + pattern.replace(r"\Z", r"\z")


#: How strongly binary operators bind.
_BINDS = {"|": 1, "&": 2}


def compile_expression(expression: str, tags: Column, word: Column) -> Column:
    """The condition over an array of tags (see ``tag_set``) and a word; never null."""
    stream = tokens(expression)
    if not stream:
        return F.lit(True)
    at = 0

    def fail(what: str):
        where = f"at {stream[at].at}: {stream[at].text!r}" if at < len(stream) else "at the end"
        raise TagExpressionError(f"{what} {where}")

    def operand() -> Column:
        nonlocal at
        if at >= len(stream):
            fail("something is missing")
        token = stream[at]
        if token.kind == "tag":
            at += 1
            return F.coalesce(F.array_contains(tags, token.text), F.lit(False))
        if token.kind == "regex":
            at += 1
            return F.coalesce(word.rlike(java_regex(token.text)), F.lit(False))
        if token.text == "!":
            at += 1
            return ~operand()
        if token.text == "(":
            at += 1
            inner = climb(1)
            if at >= len(stream) or stream[at].text != ")":
                fail("a ) is missing")
            at += 1
            return inner
        return fail("a tag, a pattern, ! or ( is missing")

    def climb(least: int) -> Column:
        nonlocal at
        left = operand()
        while at < len(stream) and stream[at].kind == "op" and _BINDS.get(stream[at].text, 0) >= least:
            op = stream[at].text
            at += 1
            right = climb(_BINDS[op] + 1)
            left = left & right if op == "&" else left | right
        return left

    out = climb(1)
    if at < len(stream):
        fail("an operator is missing")
    return out


def tag_set(part_of_speech: Column, tags: Column) -> Column:
    """The part of speech and the tags, trimmed, in capitals, without empty ones."""
    every = F.concat(F.array(F.coalesce(part_of_speech, F.lit(""))), F.coalesce(tags, F.array().cast("array<string>")))
    return F.filter(F.transform(every, lambda t: F.upper(F.trim(F.coalesce(t, F.lit(""))))), lambda t: t != "")
