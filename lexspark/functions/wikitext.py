"""Parts of speech and descriptions out of the text of dictionary pages.

Pages are edited line by line in an order that later steps depend on, which columns cannot express; one Arrow function
takes a page's text to its sections. Everything around it (titles, redirects, lengths, outcomes) is built in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import relational as R
from lexspark.operators.lexicon import POS_WEIGHTS

# The parts of speech of templates and headers, and the words that page structure is told by.
POS_MAP = {"-hy-ած-": "ADJ", "-hy-մակ-": "ADV", "-hy-գո-": "NOUN", "-hy-գոյ-": "NOUN", "-hy-բայ-": "VERB", "-hy-նբ-": "VERB", "-hy-չբ-": "VERB", "-hy-կր-": "VERB", "-hy-դեր-": "PRON", "-hy-թվ-": "NUM", "-hy-կապ-": "ADP", "-hy-շաղ-": "CONJ", "-hy-ձա-": "INTJ", "-hy-մաս-": "MOD", "-hy-եղբ-": "MOD", "-hy-հատ-": "PLC", "-hy-հպվ-": "ABBR", "-hy-բնձ-": "NAT", "-hy-անվ-": "NOML"}
NAME_POS = {"Ածական": "ած", "Գոյական": "գո", "Մակբայ": "մակ", "Դերանուն": "դեր", "Բայ": "բայ", "Թվական": "թվ", "Կապ": "կապ", "Շաղկապ": "շաղ", "Ձայնարկություն": "ձա", "Վերաբերական": "մաս"}
ETYMOLOGY = "Ստուգաբանություն"
PHRASE, NOMINAL = "-hy-բաց-", "-hy-անվ-"
_TEMPLATE = re.compile(r"\{\{(-hy-[^}-]+-)\}\}")
_HEADER = re.compile(r"(=+)\s*([^=]+?)\s*\1\s*")
_LETTER = re.compile("[Ա-Ֆա-և]")
_LINK = re.compile(r"\[\[([^|\]]+)(?:\|([^]]+))?\]\]")
_WORDS = re.compile(T.WORD_SPLIT)
TITLE = "^[Ա-Ֆա-և]+$"


@dataclass(frozen=True)
class Rules:
    """What a run of the extractor may be told."""

    pos_map: dict[str, str] = field(default_factory=lambda: POS_MAP)
    weights: dict[str, int] = field(default_factory=lambda: POS_WEIGHTS)
    names: dict[str, str] = field(default_factory=lambda: NAME_POS)
    filter_words: tuple[str, ...] = ()
    trigger_words: tuple[str, ...] = ()
    skip_steps: tuple[str, ...] = ()


def word_list(value: str | None) -> tuple[str, ...]:
    """The trimmed, non-empty parts of a list with commas."""
    return tuple(p for p in map(str.strip, (value or "").split(",")) if p)


def clean_bullet(line: str) -> str:
    """The text of a line that begins with ``#``: templates gone, links by their label, punctuation off the ends."""
    body = line.lstrip()
    if body[:1] != "#":
        return ""
    body = _LINK.sub(lambda m: m[2] or m[1], T.remove_braces(body[1:]))
    return body.strip(" \t\r\n,;:()[]").strip()


def describe(lines: list[str], rules: Rules) -> str:
    """The chosen bullet of a section: of those left by the filter words the first without a trigger word, or the last."""
    cleaned = [c for c in map(clean_bullet, lines) if c]
    has = lambda text, words: not set(words).isdisjoint(_WORDS.split(text)) if words else False
    left = [c for c in cleaned if not has(c, rules.filter_words)]
    return next((c for c in left if not has(c, rules.trigger_words)), left[-1] if left else "")


def spans(lines: list[str], stops: tuple[str, ...]) -> Iterator[tuple[str, int, int]]:
    """(key, start, end) of the lines behind each line with a part-of-speech template, up to the next such line or one
    that begins with one of ``stops``. Only the first template of a line counts."""
    heads = [(i, m[1]) for i, line in enumerate(lines) if (m := _TEMPLATE.search(line))]
    for (i, key), (following, _) in zip(heads, [*heads[1:], (len(lines), "")]):
        yield key, i + 1, next((j for j in range(i + 1, following) if lines[j].lstrip().startswith(stops)), following)


REGION, SECTION = ("==",), ("==", "* ")


def headers_to_templates(lines: list[str], rules: Rules) -> list[str]:
    """Headers that name a part of speech become its template."""
    found = ((line, _HEADER.fullmatch(line.strip())) for line in lines)
    return [f"{{{{-hy-{rules.names[m[2].strip()]}-}}}}" if m and m[2].strip() in rules.names else line for line, m in found]


def etymology_first(lines: list[str], rules: Rules) -> list[str]:
    """An etymology header behind the first part of speech moves before it, and all others go."""
    is_etymology = lambda line: line.lstrip().startswith("=") and ETYMOLOGY in line
    first = next((i for i, line in enumerate(lines) if _TEMPLATE.search(line)), None)
    where = next((i for i, line in enumerate(lines) if is_etymology(line)), None)
    if first is None or where is None or where < first:
        return lines
    return [*(x for x in lines[:first] if not is_etymology(x)), f"=={ETYMOLOGY}==", *(x for x in lines[first:] if not is_etymology(x))]


def bullets(lines: list[str], rules: Rules) -> list[str]:
    """List marks become ``# ``; a region without any gets one before each line with an Armenian letter."""
    out = list(lines)

    def marked(line: str) -> str:
        body = line.lstrip()
        return f"{line[: len(line) - len(body)]}# {body[2:]}" if body.startswith(("* ", "- ")) else line

    def numbered(line: str) -> str:
        body = line.lstrip()
        return line if body.startswith("==") or not _LETTER.search(line) else f"{line[: len(line) - len(body)]}# {line.strip()}"

    for _, a, b in list(spans(out, REGION)):
        region = [marked(x) for x in out[a:b]]
        out[a:b] = region if any(x.lstrip().startswith("#") for x in region) else [numbered(x) for x in region]
    return out


def phrases(lines: list[str], rules: Rules) -> list[str]:
    """Phrase sections join the described section of the largest weight, or become nominal if there is none.

    Known behaviour that is kept: the sections are taken out at the places they had before descriptions were added, so
    if they stand behind that section, as many lines at their end survive as were added, and as many before them go.
    """
    regions = [(key, a, b, describe(lines[a:b], rules)) for key, a, b in spans(lines, REGION)]
    own = [r for r in regions if r[0] == PHRASE]
    if not own:
        return lines
    hosts = [r for r in regions if r[0] in rules.pos_map and r[0] != PHRASE and r[3]]
    if not hosts:
        return [line.replace(f"{{{{{PHRASE}}}}}", f"{{{{{NOMINAL}}}}}") for line in lines]
    host = max(hosts, key=lambda r: rules.weights.get(rules.pos_map[r[0]], 0))
    out = [*lines[: host[2]], *(f"# {r[3]}" for r in own if r[3]), *lines[host[2] :]]
    for _, a, b, _ in sorted(own, key=lambda r: -r[1]):
        del out[a - 1 if a and PHRASE in out[a - 1] else a : b]
    return out


#: Steps before sections are read, in order, by name.
STEPS = {"pp0": headers_to_templates, "pp1": etymology_first, "pp2": bullets, "pp3": phrases}


def page_sections(text: str, rules: Rules) -> tuple[list[tuple[str, bool, str, str]], list[str]]:
    """((key, mapped, tag, description) of each section, every key of the text) after all steps."""
    for name, step in STEPS.items():
        if name not in rules.skip_steps and (lines := text.splitlines()):
            changed = step(lines, rules)
            text = text if changed is lines else "\n".join(changed)
    lines = text.splitlines()
    sections = [(key, key in rules.pos_map, rules.pos_map.get(key, key), describe(lines[a:b], rules) if key in rules.pos_map else "") for key, a, b in spans(lines, SECTION)]
    return sections, _TEMPLATE.findall(text)


def trace(text: str, rules: Rules = Rules()) -> list[tuple[str, str]]:
    """(step, text after it) of a page, for looking into one word."""
    out = [("input", text)]
    for name, step in STEPS.items():
        if name not in rules.skip_steps:
            text = "\n".join(step(text.splitlines(), rules))
            out.append((name, text))
    return out


def traced(pages: DataFrame, words: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(title, nth, step, text): ``trace`` of the pages (title, text) whose title is among ``words`` (title)."""

    @F.pandas_udf("array<struct<step:string,text:string>>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [{"step": a, "text": b} for a, b in trace(t or "", rules)])

    found = pages.join(words.select("title").distinct(), "title", "left_semi")
    return found.select("title", F.posexplode(run("text")).alias("nth", "s")).select("title", "nth", "s.step", "s.text")


SECTIONS = "sections array<struct<ord:int,key:string,mapped:boolean,tag:string,desc:string>>, keys array<string>"


def sections_of(text: Column, rules: Rules) -> Column:
    """struct<sections, keys> of a page's text."""

    @F.pandas_udf(SECTIONS)
    def run(s: pd.Series) -> pd.DataFrame:
        pages = [page_sections(t or "", rules) for t in s]
        names = ("ord", "key", "mapped", "tag", "desc")
        return pd.DataFrame({"sections": [[dict(zip(names, (i, *x))) for i, x in enumerate(p)] for p, _ in pages], "keys": [k for _, k in pages]})

    return run(text)


def classify_pages(pages: DataFrame, rules: Rules = Rules(), skip: tuple[str, ...] = (), least: int = 4, most: int = 9) -> DataFrame:
    """(title, outcome, tag, reason, sections) of each page (title, text) that has an outcome or is not Armenian.

    In this order: no title: ignored; not Armenian; on the skip list; no text; a redirect; a length out of the window:
    ignored; described sections: extracted; no keys: no tag; no mapped section: the first key; else: no desc.
    """
    rows = pages.where("title is not null").select(T.normalize_title(F.col("title")).alias("title"), F.coalesce("text", F.lit("")).alias("text"))
    armenian = F.col("title").rlike(TITLE)
    early = F.when(~armenian, "not Armenian").when(F.col("title").isin(*skip) if skip else F.lit(False), "skipped").when(F.col("text") == "", "no text").when(F.col("text").rlike("(?i)#REDIRECT"), "REDIRECT").when(~T.normalized_length(F.col("title")).between(least, most), "length")
    rows = rows.withColumn("early", early).where("early is null or early != 'length'")
    # only pages that pass the built-in tests go to Python
    rows = rows.withColumn("found", sections_of(F.when(F.col("early").isNull(), F.col("text")), rules))
    sections, keys = F.col("found.sections"), F.col("found.keys")
    described = F.filter(sections, lambda s: s["mapped"] & (s["desc"] != ""))
    mapped = F.filter(sections, lambda s: s["mapped"])
    first_key = F.try_element_at(keys, F.lit(1))
    late = F.when(F.size(described) > 0, "extracted").when(F.size(keys) == 0, "no tag").when(F.size(mapped) == 0, first_key).otherwise("no desc")
    reason = F.when(F.col("early") == "no text", "no tag").otherwise(F.coalesce("early", late))
    tag = F.when(F.col("early").isNotNull() | (F.size(described) > 0) | (F.size(keys) == 0), "").when(F.size(mapped) == 0, first_key).otherwise(F.try_element_at(mapped, F.lit(1))["tag"])
    outcome = F.when(F.col("early") == "not Armenian", "other").when(F.col("early").isNull() & (F.size(described) > 0), "extracted").otherwise("filtered")
    return rows.select("title", outcome.alias("outcome"), tag.alias("tag"), reason.alias("reason"), F.when(F.col("early").isNull(), described).alias("sections"))


def extracted(classified: DataFrame, single: bool = False, weights: dict[str, int] = POS_WEIGHTS) -> DataFrame:
    """(word, ord, tag, definition) of extracted pages; with ``single`` a page's section of the largest weight only."""
    rows = classified.where("outcome = 'extracted'").select(F.col("title").alias("word"), F.explode("sections").alias("s")).select("word", F.col("s.ord").alias("ord"), F.col("s.tag").alias("tag"), F.col("s.desc").alias("definition"))
    if not single:
        return rows
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    weighed = rows.withColumn("w", -F.coalesce(F.try_element_at(table, F.col("tag")), F.lit(0)))
    return R.dedupe_first(weighed, "word", ["w", "ord"]).drop("w")


def rejected(classified: DataFrame) -> DataFrame:
    """(word, tag, filter, definition): the log of pages that gave nothing."""
    return classified.where("outcome = 'filtered'").select(F.col("title").alias("word"), "tag", F.col("reason").alias("filter"), F.lit("").alias("definition"))


def page_counters(classified: DataFrame) -> DataFrame:
    return classified.agg(F.sum(F.when(F.col("outcome") == "extracted", F.size("sections")).otherwise(0)).alias("extracted"), F.count_if(F.col("outcome") == "filtered").alias("filtered"), F.count_if(F.col("outcome") == "other").alias("not_armenian"), F.count_if(F.col("reason") == "REDIRECT").alias("redirects"))
