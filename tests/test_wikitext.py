from lexspark.functions import wikitext as W

RULES = W.Rules()

PAGE = """==Հայերեն==
=== Գոյական ===
* առաջին [[իմաստ|իմաստը]] {{t|{{x}}}};
# երկրորդ
==Ստուգաբանություն==
text
{{-hy-բայ-}}
գործողություն
no letters 123
* [[նոր]]ը
=== Այլ ===
# not a part
"""


def sections(text, rules=RULES):
    return W.page_sections(text, rules)


def test_clean_bullet():
    assert W.clean_bullet("  # [[foo|bar]] {{x {{y}} z}} baz,;") == "bar  baz"
    assert W.clean_bullet("#: note") == "note" and W.clean_bullet("no") == "" and W.clean_bullet("#{{only}}") == ""
    assert W.clean_bullet("# open {{ rest") == "open"


def test_describe():
    lines = ["# a x", "text", "# b y", " # c", "## d"]
    assert W.describe(lines, RULES) == "a x"
    assert W.describe(lines, W.Rules(filter_words=("x",))) == "b y"
    assert W.describe(lines, W.Rules(trigger_words=("x", "y"))) == "c"
    assert W.describe(lines[:3], W.Rules(trigger_words=("x", "y"))) == "b y"
    assert W.describe(lines[:3], W.Rules(filter_words=("x", "y"))) == ""
    assert W.word_list(" a, ,b ") == ("a", "b") and W.word_list(None) == ()


def test_steps():
    assert W.headers_to_templates(["== Գոյական ==", "===Այլ===", " =Բայ= ", "==Բայ="], RULES) == ["{{-hy-գո-}}", "===Այլ===", "{{-hy-բայ-}}", "==Բայ="]
    lines = ["a", "{{-hy-գո-}}", "x", "==Ստուգաբանություն==", "y", "=== Ստուգաբանություն 2 ==="]
    assert W.etymology_first(lines, RULES) == ["a", "==Ստուգաբանություն==", "{{-hy-գո-}}", "x", "y"]
    assert W.etymology_first(lines[2:], RULES) == lines[2:]
    early = ["==Ստուգաբանություն==", "{{-hy-գո-}}"]
    assert W.etymology_first(early, RULES) == early
    assert W.bullets(["{{-hy-գո-}}", " * ա", "- b", "c", "==", "* d"], RULES) == ["{{-hy-գո-}}", " # ա", "# b", "c", "==", "* d"]
    assert W.bullets(["{{-hy-գո-}}", " ա ", "b", "", "== x"], RULES) == ["{{-hy-գո-}}", " # ա", "b", "", "== x"]


def test_phrases_keep_the_known_shift():
    before = ["{{-hy-բաց-}}", "# p", "{{-hy-գո-}}", "# n"]
    assert W.phrases(before, RULES) == ["{{-hy-գո-}}", "# n", "# p"]
    after = ["{{-hy-գո-}}", "# n", "{{-hy-բաց-}}", "# p", "# q", "== e"]
    # the added line shifts the phrase section down by one: its template and "# p" go, "# q" survives
    assert W.phrases(after, RULES) == ["{{-hy-գո-}}", "# n", "# p", "# q", "== e"]
    alone = ["{{-hy-բաց-}}", "# p"]
    assert W.phrases(alone, RULES) == ["{{-hy-անվ-}}", "# p"]


def test_page():
    found, keys = sections(PAGE)
    # the second header is a template of its own name; the etymology went before the first part of speech
    assert [(k, m, t) for k, m, t, _ in found] == [("-hy-գո-", True, "NOUN"), ("-hy-բայ-", True, "VERB")]
    assert found[0][3] == "առաջին իմաստը"
    assert found[1][3] == "նորը"
    assert keys == ["-hy-գո-", "-hy-բայ-"]
    raw, _ = sections(PAGE, W.Rules(skip_steps=("pp0", "pp1", "pp2", "pp3")))
    assert [(k, d) for k, _, _, d in raw] == [("-hy-բայ-", "")]
    assert sections("") == ([], [])


def test_classification_order(spark):
    pages = [("x-word", "{{-hy-գո-}}\n# ա"), (None, "x"), ("տուն", None), ("բառ", "# ա"), ("բոզի", "{{-hy-գո-}}\n# ա"), ("գործ", "#ReDirect [[x]]"), ("գործող", "{{-hy-գո-}}\n# ա\n{{-hy-անվ-}}\n# բ"), ("գործիք", "{{-hy-ուր-}}\n# ա"), ("գործին", "{{-hy-ած-}}\nxyz"), ("﻿գործեր​", "no keys")]
    frame = spark.createDataFrame(pages, "title string, text string")
    out = W.classify_pages(frame, skip=("բոզի", "բառ"))
    got = {r.title: (r.outcome, r.tag, r.reason) for r in out.collect()}
    assert got == {
        "x-word": ("other", "", "not Armenian"),
        "տուն": ("filtered", "", "no tag"),
        "բառ": ("filtered", "", "skipped"),
        "բոզի": ("filtered", "", "skipped"),
        "գործ": ("filtered", "", "REDIRECT"),
        "գործող": ("extracted", "", "extracted"),
        "գործիք": ("filtered", "-hy-ուր-", "-hy-ուր-"),
        "գործին": ("filtered", "ADJ", "no desc"),
        "գործեր": ("filtered", "", "no tag"),
    }
    assert [(r.word, r.tag, r.definition) for r in W.extracted(out).orderBy("ord").collect()] == [("գործող", "NOUN", "ա"), ("գործող", "NOML", "բ")]
    assert [(r.tag, r.definition) for r in W.extracted(out, single=True).collect()] == [("NOML", "բ")]
    assert W.rejected(out).count() == 7
    assert W.page_counters(out).first().asDict() == {"extracted": 2, "filtered": 7, "not_armenian": 1, "redirects": 1}


def test_trace():
    steps = W.trace("== Գոյական ==\n* ա")
    assert [n for n, _ in steps] == ["input", "pp0", "pp1", "pp2", "pp3"] and steps[1][1] == "{{-hy-գո-}}\n* ա" and steps[3][1] == "{{-hy-գո-}}\n# ա"
