"""Tags of a word's entries, as one array expression over the entries of a word and part of speech.

A rule is a tag, the part of speech it holds for (or any) and the condition. Texts are cleaned and lowered once, in
``prepared``; all rules are substring tests over them, so the whole table is evaluated within a projection.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions import text as T

DEFINITION = "struct<definition:string,examples:array<string>,parsedExamples:array<struct<example:string>>,labels:array<string>,gloss:string,text:string>"
ENTRY = f"struct<partOfSpeech:string,language:string,etymology_text:string,etymology:string,description:string,romanization:string,definitions:array<{DEFINITION}>>"

# Words that grammar tags, origins and registers are told by.
GRAMMAR_WORDS = ("form", "inflection", "inflected", "declension", "conjugation", "plural", "singular", "nominative", "genitive", "dative", "accusative", "instrumental", "prepositional", "locative", "vocative", "ablative", "partitive", "masculine", "feminine", "neuter", "common", "comparative", "superlative", "past", "present", "future", "imperfect", "perfect", "pluperfect", "participle", "gerund", "infinitive", "subjunctive", "imperative", "conditional", "first", "second", "third(?:-person)?", "person")
GRAMMAR_FOLLOWERS = [w for w in GRAMMAR_WORDS if w not in ("declension", "conjugation")]
OF_WORDS = ("of", "de", "del", "della", "di", "da", "du", "des", "dos", "das", "do", "von", "van")
LANGUAGES = ["latin", "greek", "french", "old french", "middle french", "german", "old english", "anglo-norman", "spanish", "italian", "portuguese", "arabic", "hebrew", "aramaic", "persian", "sanskrit", "russian", "ukrainian", "polish", "czech", "dutch", "swedish", "norwegian", "danish", "japanese", "chinese", "korean"]
REGISTERS = ["archaic", "obsolete", "slang", "informal", "rare", "offensive", "dialectal", "poetic"]
GENDERS = {"masculine": "MASC", "feminine": "FEM", "neuter": "NEUT", "common": "COMMON_GENDER"}
OBLIQUE = ["genitive", "dative", "accusative", "instrumental", "prepositional", "locative", "vocative"]
VERB_FORMS = [
    (["past participle"], ["PAST_PART", "INFLECTED_FORM"]),
    (["present participle"], ["PRES_PART", "INFLECTED_FORM"]),
    (["past tense", "preterite"], ["PAST", "INFLECTED_FORM"]),
    (["imperative"], ["IMP", "INFLECTED_FORM"]),
    (["third-person singular", "3rd-person singular", "3rd person singular"], ["3PS", "INFLECTED_FORM"]),
    (["subjunctive"], ["SUBJ", "INFLECTED_FORM"]),
    (["infinitive"], ["INF"]),
    (["form of", "inflection of", "conjugation of", "conjugated form of"], ["FORM_OF", "INFLECTED_FORM"]),
]
CYRILLIC_VERB_FORMS = [
    (["infinitive of"], ["INFINITIVE", "INFLECTED_FORM"]),
    (["past tense of", "past form of"], ["PAST", "INFLECTED_FORM"]),
    (["present tense of", "present form of"], ["PRESENT", "INFLECTED_FORM"]),
    (["future tense of", "future form of"], ["FUTURE", "INFLECTED_FORM"]),
    (["imperative of", "imperative form of"], ["IMPERATIVE", "INFLECTED_FORM"]),
    (["present active participle"], ["PARTICIPLE", "PRES_PART", "INFLECTED_FORM"]),
    (["past active participle"], ["PARTICIPLE", "PAST_PART", "INFLECTED_FORM"]),
    (["present passive participle"], ["PARTICIPLE", "PRES_PASS_PART", "INFLECTED_FORM"]),
    (["past passive participle"], ["PARTICIPLE", "PAST_PASS_PART", "INFLECTED_FORM"]),
    (["adverbial participle", "gerund of"], ["GERUND", "INFLECTED_FORM"]),
    (["perfective of", "perfective form of"], ["PERFECTIVE"]),
    (["imperfective of", "imperfective form of"], ["IMPERFECTIVE"]),
]
CLEANSE_VERB_FORMS = [
    (["past participle", "participe passé", "partizip ii"], ["PAST_PART", "INFLECTED_FORM"]),
    (["present participle", "gerund", "participe présent", "partizip i"], ["PRES_PART", "INFLECTED_FORM"]),
    (["past tense", "preterite", "prétérit", "imparfait"], ["PAST", "INFLECTED_FORM"]),
    (["third-person singular", "3rd-person singular", "3rd person singular"], ["3PS", "INFLECTED_FORM"]),
    (["imperative"], ["IMP", "INFLECTED_FORM"]),
    (["infinitive"], ["INF"]),
    (["subjunctive"], ["SUBJ", "INFLECTED_FORM"]),
    (["form of", "inflection of", "conjugation of", "conjugated form of"], ["FORM_OF", "INFLECTED_FORM"]),
]
CLEANSE_PLURALS = ["plural of", "plural form of", "plurals of", "pluriel de", "plural von", "plural de", "forma plural"]
#: A phrase of grammar words before a word for "of".
DERIVATIVE = rf"(?iU)\b(?:{'|'.join(GRAMMAR_WORDS)})\b(?:\s+\b(?:{'|'.join(GRAMMAR_FOLLOWERS)})\b)*\s+(?:{'|'.join(OF_WORDS)})\s+"


def _any(texts: Column, *needles: str) -> Column:
    """Some text contains some needle. ``texts`` is one string of all of them: a plain search, compiled by Spark."""
    return F.coalesce(_contains(texts, needles), F.lit(False))


#: Stands between texts that are searched together.
MARK = "\x1e"


def _contains(t: Column, needles: tuple[str, ...] | list[str]) -> Column:
    out = t.contains(needles[0])
    for n in needles[1:]:
        out = out | t.contains(n)
    return out


def _tags(rules: list[tuple[str, Column]], *more: Column) -> Column:
    """Sorted distinct tags whose condition holds, and those of the arrays ``more``."""
    held = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(t)) for t, c in rules]))
    return F.array_sort(F.array_distinct(F.concat(held, *more)))


def _forms(table: list, texts: Column, only: Column) -> list[tuple[str, Column]]:
    return [(tag, only & _any(texts, *needles)) for needles, tags in table for tag in tags]


def prepared(frame: DataFrame, entries: str = "entries") -> DataFrame:
    """Adds ``_raw`` (definitions), ``_defs`` (texts of the definitions, an array) and, each as one string with a mark
    between texts that no needle has, ``_html`` (raw definitions), ``_def`` and ``_blob`` (all texts of the entries).

    Texts are stripped of HTML and lowered. Entities need Python only where a text has an ampersand; other strings go
    through the built-in path.
    """
    e = F.coalesce(F.col(entries), F.array().cast(f"array<{ENTRY}>"))
    raw = F.flatten(F.transform(e, lambda x: F.coalesce(x["definitions"], F.array().cast(f"array<{DEFINITION}>"))))
    others = F.flatten(F.transform(e, lambda x: F.array(x["etymology_text"], x["etymology"], x["description"])))
    frame = frame.withColumn("_entries", e).withColumn("_raw", F.filter(raw, lambda d: d.isNotNull()))
    joined = F.concat(F.transform("_raw", lambda d: d["definition"]), others, F.flatten(F.transform("_raw", lambda d: F.array(d["gloss"], d["text"]))))
    # one string for all texts of a row, so that entities are decoded by a single Arrow call
    frame = frame.withColumn("_n", F.size("_raw")).withColumn("_all", T.html_unescape(F.array_join(F.transform(joined, lambda t: F.translate(F.coalesce(t, F.lit("")), MARK, " ")), MARK)))
    cleaned = F.transform(F.split("_all", MARK, -1), lambda t: F.lower(F.regexp_replace(t, "<[^>]+>", "")))
    frame = frame.withColumn("_texts", cleaned)
    frame = frame.withColumn("_defs", F.slice("_texts", 1, F.col("_n"))).withColumn("_def", F.array_join("_defs", MARK)).withColumn("_blob", F.array_join("_texts", MARK))
    frame = frame.withColumn("_labels", F.flatten(F.transform("_raw", lambda d: F.transform(F.coalesce(d["labels"], F.array().cast("array<string>")), lambda x: F.lower(T.strip(x))))))
    return frame.withColumn("_html", F.array_join(F.transform("_raw", lambda d: F.coalesce(d["definition"], F.lit(""))), MARK)).drop("_all")


def _examples(raw: str = "_raw") -> Column:
    return F.exists(raw, lambda d: (F.coalesce(F.size(d["examples"]), F.lit(0)) > 0) | (F.coalesce(F.size(d["parsedExamples"]), F.lit(0)) > 0))


def _with_marks(frame: DataFrame, same_language: Column | None = None) -> DataFrame:
    """Adds ``_marks``: for each definition with a text 1 if it is a grammatical form with a link to its language, else 0;
    with ``same_language`` only of entries in that language. A column of its own, as rules use it several times."""

    def hits(e: Column) -> Column:
        lang = F.lower(F.concat(F.lit("#"), T.strip(F.coalesce(e["language"], F.lit("")))))
        texts = F.filter(F.transform(F.coalesce(e["definitions"], F.array().cast(f"array<{DEFINITION}>")), lambda d: d["definition"]), lambda t: F.coalesce(t != "", F.lit(False)))
        return F.transform(texts, lambda t: F.when((lang != "#") & F.lower(t).contains(lang) & F.regexp_replace(t, "<[^>]+>", "").rlike(DERIVATIVE), 1).otherwise(0))

    entries = F.col("_entries")
    if same_language is not None:
        entries = F.filter(entries, lambda e: (T.strip(F.coalesce(e["language"], F.lit(""))) == same_language) & (same_language != ""))
    return frame.withColumn("_marks", F.flatten(F.transform(entries, hits)))


def _coverage() -> list[tuple[str, Column]]:
    """LIKELY_DERIVATIVE if all marks are 1, MAYBE if some are."""
    some = F.array_contains("_marks", 1)
    return [("LIKELY_DERIVATIVE", some & ~F.array_contains("_marks", 0)), ("MAYBE_DERIVATIVE", some & F.array_contains("_marks", 0))]


def _number(pos: Column) -> Column:
    """Plural or singular of nouns: the first definition that says either decides, plural first."""
    plural, singular = ("plural of", "plural form of"), ("singular of", "singular form of")
    said = F.try_element_at(F.filter("_defs", lambda t: _contains(t, plural + singular)), F.lit(1))
    which = F.when(pos == "NOUN", F.when(_contains(said, plural), "PLURAL").when(said.isNotNull(), "SINGULAR"))
    return F.array_compact(F.array(which))


def _origin() -> list[tuple[str, Column]]:
    blobs = F.col("_blob")
    return [("LOANWORD", _any(blobs, "borrowed from", "loanword from")), ("EPONYM", _any(blobs, "named after", "eponym"))]


def _languages() -> Column:
    """FROM_, VIA_ and COGNATE_ tags of the languages that are named behind such a word: one search for all of them, as
    no language begins another one's name and no such word is within one."""
    found = F.regexp_extract_all("_blob", F.lit(f"((?:from|via|cognate with|cognate to) (?:{'|'.join(LANGUAGES)}))"), F.lit(1))
    kind = lambda x: F.when(x.startswith("from"), "FROM_").when(x.startswith("via"), "VIA_").otherwise("COGNATE_")
    return F.transform(found, lambda x: F.concat(kind(x), F.translate(F.upper(F.regexp_replace(x, "^(from|via|cognate with|cognate to) ", "")), " -", "__")))


def _register() -> list[tuple[str, Column]]:
    return [(r.upper(), F.coalesce(F.array_contains("_labels", r), F.lit(False)) | _any(F.col("_def"), r)) for r in REGISTERS]


def _morphology() -> list[tuple[str, Column]]:
    defs = F.col("_def")
    return [("COMPOUND", _any(defs, "compound of")), ("PREFIXED", _any(defs, "prefix")), ("SUFFIXED", _any(defs, "suffix"))]


def _foreign() -> list[tuple[str, Column]]:
    raw = F.col("_html")
    return [("TRANSLITERATED", F.exists("_entries", lambda e: F.coalesce(T.strip(e["romanization"]) != "", F.lit(False)))), ("FOREIGN_TERM", _any(raw, "<i>", "</i>"))]


def _cyrillic(word: Column, pos: Column, combined: bool) -> Column:
    """Case, number, gender, degree and verb forms of Cyrillic words; ``combined`` joins case and number in one tag."""
    every, defs, on = F.col("_defs"), F.col("_def"), F.coalesce(word.rlike("[Ѐ-ӿ]"), F.lit(False))
    singular, plural = _any(defs, "singular of", "singular form of"), _any(defs, "plural of", "plural form of")
    nominative = _any(defs, "nominative singular of")
    oblique = F.exists(every, lambda t: t.contains(" of") & _contains(t, OBLIQUE))
    if combined:
        out = [("NOMINATIVE_SINGULAR", nominative), ("NON_NOMINATIVE_SINGULAR", ~nominative & oblique & singular), ("NON_NOMINATIVE_PLURAL", ~nominative & oblique & plural), ("SINGULAR", ~nominative & ~oblique & singular), ("PLURAL", ~nominative & ~oblique & plural)]
    else:
        out = [("SINGULAR", singular), ("PLURAL", plural), ("NON_NOMINATIVE", oblique)]
    of = lambda *words: F.exists(every, lambda t: t.contains(" of") & _contains(t, words))
    out += [(tag, of(f"{g} ")) for g, tag in GENDERS.items()]
    out += [("COMPARATIVE", pos.isin("ADJ", "ADV") & of("comparative")), ("SUPERLATIVE", pos.isin("ADJ", "ADV") & of("superlative")), ("SHORT_FORM", (pos == "ADJ") & _any(defs, "short form of", "short adjective form of"))]
    out += _forms(CYRILLIC_VERB_FORMS, defs, pos == "VERB")
    none = F.array().cast("array<string>")
    return F.when(on, F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(t)) for t, c in out]))).otherwise(none)


def tag_words(frame: DataFrame, combined_case: bool = True) -> DataFrame:
    """``frame`` (word, part_of_speech, entries) with ``tags``: those of every rule family, sorted, each once."""
    ready = _with_marks(prepared(frame))
    word, pos = F.col("word"), F.col("part_of_speech")
    rules = [("HAS_EXAMPLE", _examples()), *_coverage(), *_forms(VERB_FORMS, F.col("_def"), pos == "VERB"), *_origin(), *_register(), *_morphology(), *_foreign()]
    return ready.withColumn("tags", _tags(rules, _number(pos), _languages(), _cyrillic(word, pos, combined_case))).drop("_labels", "_marks", "_entries", "_raw", "_n", "_texts", "_defs", "_def", "_blob", "_html")


def _without_html(entry: dict | None) -> dict | None:
    """An entry with the texts of its definitions stripped: the definition, examples (texts, or the texts of an object)
    and the ``example`` of parsed examples. All other fields and items stay."""
    text = lambda x: T.parsed_text(x) if isinstance(x, str) else x

    def fields(x: dict, *names: str) -> dict:
        return {k: text(v) if not names or k in names else v for k, v in x.items()}

    def items(xs, *names: str):
        return xs if xs is None else [fields(x, *names) if isinstance(x, dict) else text(x) for x in xs]

    def definition(d):
        if not isinstance(d, dict):
            return d
        out = fields(d, "definition")
        return out | {k: items(out[k], *names) for k, names in (("examples", ()), ("parsedExamples", ("example",))) if k in out}

    if not isinstance(entry, dict) or entry.get("definitions") is None:
        return entry
    return entry | {"definitions": [definition(d) for d in entry["definitions"]]}


def strip_definitions(frame: DataFrame, column: str = "entries") -> DataFrame:
    """``frame`` with the definitions of its entries free of HTML, in the structure that the column has. Arrow, as the
    tokeniser of ``strip_html_parsed`` works on texts anywhere in it."""

    @F.pandas_udf(frame.schema[column].dataType)
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda entries: None if entries is None else [_without_html(e) for e in entries])

    return frame.withColumn(column, run(column))


def has_transclusion(entries: str = "entries") -> Column:
    """Some raw definition was transcluded; no rule uses it."""
    raw = F.flatten(F.transform(entries, lambda e: F.transform(F.coalesce(e["definitions"], F.array().cast(f"array<{DEFINITION}>")), lambda d: F.coalesce(d["definition"], F.lit("")))))
    return _any(F.array_join(raw, MARK), "mw:Transclusion")


def by_part_of_speech(words: DataFrame) -> DataFrame:
    """(word, frequency, part_of_speech, entries): the entries of a word by part of speech, in capitals, in order.

    The entries of a row are grouped within the row, so nothing is shuffled. Entries without a part of speech are UNKNOWN.
    """
    pos = lambda e: F.when(F.coalesce(e["partOfSpeech"], F.lit("")) == "", "UNKNOWN").otherwise(F.upper(e["partOfSpeech"]))
    present = F.filter("entries", lambda e: e.isNotNull())
    kinds = F.array_sort(F.array_distinct(F.transform(present, pos)))
    exploded = words.withColumn("part_of_speech", F.explode(kinds))
    return exploded.withColumn("entries", F.filter(present, lambda e: pos(e) == F.col("part_of_speech"))).select("word", "frequency", "part_of_speech", "entries")


def distinct_upper(c: Column) -> Column:
    """Parts of speech in capitals in the order they are first seen."""
    return F.array_distinct(F.filter(F.transform(c, lambda p: F.upper(T.strip(F.coalesce(p, F.lit(""))))), lambda p: p != ""))


def cleanse_tags(frame: DataFrame) -> DataFrame:
    """``frame`` with ``positions`` and ``tags`` of all entries of a word together, by the rules of the older tool.

    Nouns without a sign of the plural are SINGULAR; derivative coverage only counts entries in the language of the first.
    """
    ready = prepared(frame).withColumn("positions", distinct_upper(F.transform("_entries", lambda e: e["partOfSpeech"])))
    defs, has = F.col("_def"), lambda p: F.array_contains("positions", p)
    language = T.strip(F.coalesce(F.try_element_at("_entries", F.lit(1))["language"], F.lit("")))
    ready = _with_marks(ready, language)
    plural = _any(defs, *CLEANSE_PLURALS)
    rules = [("HAS_EXAMPLE", _examples()), *_coverage(), ("PLURAL", has("NOUN") & plural), ("SINGULAR", has("NOUN") & ~plural), *_forms(CLEANSE_VERB_FORMS, defs, has("VERB"))]
    return ready.withColumn("tags", _tags(rules)).drop("_labels", "_marks", "_entries", "_raw", "_n", "_texts", "_defs", "_def", "_blob", "_html")
