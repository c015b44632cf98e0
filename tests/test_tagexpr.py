import random
import re

import pytest
from pyspark.sql import functions as F

from lexspark.functions.tagexpr import TagExpressionError, compile_expression, tag_set

ROWS = [("apple", "noun", [" rare", "X_1"]), ("bear", "VERB", []), ("cede", None, None), (None, "ADJ", ["RARE", ""]), ("été", "ADV", ["PLURAL"])]


def python(expression, word, tags):
    """By Python's own operators, whose precedence is the same."""
    parts = re.findall(r"[A-Z0-9_]+|\[[^\]]*\]|[!&|()]", expression)
    code = " ".join({"!": "not", "&": "and", "|": "or"}.get(p, p if p in "()" else f"t({p!r})") for p in parts)
    t = lambda p: bool(word is not None and re.search(p[1:-1], word)) if p[0] == "[" else p in tags
    return bool(eval(code, {"t": t})) if parts else True


def check(spark, expressions):
    rows = spark.createDataFrame(ROWS, "word string, pos string, tags array<string>")
    columns = [compile_expression(e, tag_set(F.col("pos"), F.col("tags")), F.col("word")).alias(f"c{i}") for i, e in enumerate(expressions)]
    got = rows.select(*columns).collect()
    for (word, pos, tags), r in zip(ROWS, got):
        have = {x.strip().upper() for x in [pos or "", *(tags or [])]} - {""}
        assert list(r) == [python(e, word, have) for e in expressions], (word, expressions)


def test_examples(spark):
    check(spark, ["NOUN", "!NOUN & !VERB", "NOUN | VERB & RARE", "(NOUN | VERB) & RARE", "![e$]", "[^b.*r$]|RARE", "", "!!ADJ", "X_1&[a]", r"[\w{3}$]"])


def test_random(spark):
    rng = random.Random(5)

    def make(depth):
        kind = rng.randrange(5) if depth else 0
        if kind == 0:
            return rng.choice(["NOUN", "VERB", "RARE", "PLURAL", "[e]", "[^a]", "[r$]"])
        if kind == 1:
            return "!" + make(depth - 1)
        if kind == 2:
            return f"({make(depth - 1)})"
        return f"{make(depth - 1)} {'&|'[kind - 3]} {make(depth - 1)}"

    # Python's "not" binds looser than its place here next to & only in chains that parentheses rule out
    check(spark, [make(4) for _ in range(60)])


@pytest.mark.parametrize("bad", ["noun", "NOUN VERB", "NOUN &", "& NOUN", "(NOUN", "NOUN)", "[a", "()", "!", "[(]", "NOUN ! VERB"])
def test_errors(bad):
    with pytest.raises(TagExpressionError):
        compile_expression(bad, F.lit(None), F.lit(None))
