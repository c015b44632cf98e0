import bz2
import json

import pytest
from pyspark.sql import functions as F

from lexspark.functions import tagging
from lexspark.sources import readers, writers
from lexspark.streaming import filters


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_indexed_lines(spark, tmp_path):
    path = put(tmp_path / "a.txt", "\n".join(f"l{i}" for i in range(500)))
    assert [(r.line, r.row_idx) for r in readers.indexed_lines(spark, path).orderBy("row_idx").collect()] == [(f"l{i}", i) for i in range(500)]


def test_indexed_files(spark, tmp_path):
    for name, n in (("a", 3), ("b", 400), ("c", 50)):
        put(tmp_path / name, "".join(f"{name}{i:04d}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        got = [r.line for r in readers.indexed_lines(spark, str(tmp_path)).orderBy("row_idx").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted(got) and len(got) == 453
    assert readers.indexed_lines(spark, put(tmp_path / "none", "")).collect() == []


def test_candidates(spark, tmp_path):
    path = put(tmp_path / "c.csv", "Word,freq\n a , 1_0 ,x\nb\n,5\nc,x\nterm_frequency,9\nd_NOUN,7\ne,3\nff,9\n")
    lines = readers.indexed_lines(spark, path)
    assert [(r.word, r.frequency) for r in readers.dump_candidates(lines).orderBy("row_idx").collect()] == [("a", 10), ("term_frequency", 9), ("d_NOUN", 7), ("e", 3), ("ff", 9)]
    assert [(r.word, r.frequency) for r in readers.cleanse_candidates(lines, 4, 1, 3).orderBy("row_idx").collect()] == [("a", 10), ("d", 7)]


def test_validated_records(spark):
    entry = {"partOfSpeech": "Noun", "definitions": [{"definition": "d", "examples": ["x"]}], "other": 1}
    good = [{"word": " w ", "frequency": 3, "entries": [entry]}, {"word": "x", "frequency": "12", "entries": []}, {"word": "y", "frequency": 3.7, "entries": [entry, entry]}, {"word": "z", "frequency": "3.7a", "entries": []}, {"word": "q", "entries": []}]
    bad = ["", "{broken", json.dumps({"word": "", "entries": []}), json.dumps({"word": "a", "entries": "no"}), json.dumps({"word": "a"})]
    lines = spark.createDataFrame([(s,) for s in [*map(json.dumps, good), *bad]], "line string")
    assert [(r.word, r.frequency, len(r.entries)) for r in readers.validated_records(lines).collect()] == [("w", 3, 1), ("x", 12, 0), ("y", 3, 2), ("z", 0, 0), ("q", 0, 0)]


def test_ragged(spark, tmp_path):
    data = [("w", 1, "NOUN", ["A", "B,C"]), ('q"x', 2, "VERB", []), ("é", 3, "ADJ", ["T"])]
    frame = spark.createDataFrame(data, "word string, frequency long, part_of_speech string, tags array<string>")
    line = writers.ragged_line(F.col("word"), F.col("frequency"), F.col("part_of_speech"), F.col("tags"))
    writers.write_lines(frame, line, str(tmp_path / "t"), [F.col("frequency")])
    back = readers.tagged_rows(readers.indexed_lines(spark, str(tmp_path / "t")), header=False)
    assert sorted(tuple(r)[:4] for r in back.collect()) == sorted(data)
    assert readers.tagged_rows(readers.indexed_lines(spark, put(tmp_path / "h", "word,f,p,tags...\na,1,N,T\n\nb,2,N\n"))).count() == 2
    assert frame.select(writers.validated_line(F.col("word"), F.col("frequency"), F.array(F.lit("N"), F.lit("V")), F.array().cast("array<string>")).alias("l")).first().l == "w,1,N,V,"


@pytest.mark.parametrize("packed", [False, True])
def test_wiki_pages(spark, tmp_path, packed):
    xml = '<mediawiki xmlns="http://x/"><page><title>տուն</title><revision><text xml:space="preserve">{{-hy-գո-}}\n# ա &amp; բ</text></revision></page><page><title>x</title><revision><text/></revision></page></mediawiki>'
    path = tmp_path / ("d.xml.bz2" if packed else "d.xml")
    path.write_bytes(bz2.compress(xml.encode()) if packed else xml.encode())
    assert [(r.title, r.text) for r in readers.wiki_pages(spark, str(path)).collect()] == [("տուն", "{{-hy-գո-}}\n# ա & բ"), ("x", None)]


def test_config_files(spark, tmp_path):
    lines = readers.indexed_lines(spark, put(tmp_path / "p", "# c\n-hy-ած-  ADJ\nX 5 7 # t\nONE\n"))
    assert [tuple(r) for r in readers.key_values(lines).collect()] == [("-hy-ած-", "ADJ"), ("X", "7")]
    names = readers.indexed_lines(spark, put(tmp_path / "n", "Ածական,ած\n#x,y\nԹվական, թվ\na,b,c\n,z\n"))
    assert [tuple(r) for r in readers.name_values(names).collect()] == [("Ածական", "ած"), ("Թվական", "թվ")]
    assert [r.word for r in readers.comma_list(spark, put(tmp_path / "s", " a, b\n,c c,\n")).collect()] == ["a", "b", "c c"]
    assert sorted(r.word for r in readers.boost_words(spark, put(tmp_path / "b1", "A b,c\nd")).collect()) == ["a", "b", "c", "d"]
    assert sorted(r.word for r in readers.boost_words(spark, put(tmp_path / "b2", "word,n\nA,1\nB,2\n")).collect()) == ["a", "b"]


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("VALIDATED", "a", 4, 1), ("RETRY", "b", 5, 9), ("RETRY", "c", 5, 3)], "outcome string, word string, len int, n int")
    writers.write_outcomes(rows, str(tmp_path / "o"))
    writers.write_outcomes(rows, str(tmp_path / "o"), append=True)
    assert spark.read.json(str(tmp_path / "o")).groupBy("outcome").count().orderBy("outcome").collect() == [("RETRY", 4), ("VALIDATED", 2)]
    writers.write_lines(rows, F.col("word"), str(tmp_path / "d"), [-F.col("n")], by="len")
    assert [r.value for r in spark.read.text(str(tmp_path / "d/len=5")).collect()] == ["b", "c"]
    writers.write_split(rows, "n", 3, str(tmp_path / "s"))
    assert spark.read.csv(str(tmp_path / "s/side=more")).count() == 2
    writers.write_table(rows, str(tmp_path / "t"), tabs=True)
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "t")).count() == 3


def test_union_by_time(spark, tmp_path):
    import os

    for name, t in (("b", 100), ("a", 200)):
        put(tmp_path / name, name)
        os.utime(tmp_path / name, (t, t))
    got = readers.union_by_time(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert [r.line for r in got.orderBy("source_ord", "row_idx").collect()] == ["b", "a"]


def test_morph_tokens(spark, tmp_path):
    token = {"id": 1, "form": "f", "lemma": "l", "POS": "p", "features": "NN"}
    path = put(tmp_path / "m.jsonl", json.dumps({"batch": 1}) + "\n" + json.dumps({"sentences": [{"sentence_id": 0, "tokens": [token, token]}]}) + "\n")
    assert readers.morph_tokens(spark, path).count() == 2


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in/a.csv", "word,f,p,tags\nhouse,3,NOUN,RARE\nrun,2,VERB\n")
    rows = filters.filtered(filters.tagged_stream(spark, str(tmp_path / "in")), "NOUN & RARE")
    for more in (None, "mouse,1,NOUN,RARE\n"):
        if more:
            put(tmp_path / "in/b.csv", more)
        filters.start(rows, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r.word for r in spark.read.json(str(tmp_path / "out")).collect()) == ["house", "mouse"]


def entry(*definitions, pos="VERB", language="English", **more):
    return {"partOfSpeech": pos, "language": language, "definitions": [{"definition": d} if isinstance(d, str) else d for d in definitions], **more}


CASES = [
    ("слова", [entry("genitive singular of сло́во", pos="noun")], {"NOUN": ["NON_NOMINATIVE_SINGULAR", "SINGULAR"]}),
    ("слово", [entry("nominative singular of x, plural of y", pos="noun")], {"NOUN": ["NOMINATIVE_SINGULAR", "PLURAL"]}),
    ("делал", [entry("masculine past tense of делать", "imperfective of сделать")], {"VERB": ["IMPERFECTIVE", "INFLECTED_FORM", "MASC", "PAST", "PERFECTIVE"]}),
    ("лучше", [entry("comparative degree of хороший", pos="adj")], {"ADJ": ["COMPARATIVE"]}),
    ("works", [entry('<a href="#English">plural of</a> work', pos="noun"), entry("third-person singular of <i>work</i>", {"definition": "x", "examples": ["e"]}, pos="verb")], {"NOUN": ["LIKELY_DERIVATIVE", "PLURAL"], "VERB": ["3PS", "FOREIGN_TERM", "HAS_EXAMPLE", "INFLECTED_FORM"]}),
    ("x", [entry("y", {"definition": "z", "labels": [" Slang "]}, pos=None, etymology_text="Borrowed from Old French, from french", romanization=" r ")], {"UNKNOWN": ["FROM_FRENCH", "FROM_OLD_FRENCH", "LOANWORD", "SLANG", "TRANSLITERATED"]}),
    ("none", [entry(pos="noun")], {"NOUN": []}),
]


def test_tags(spark):
    rows = spark.createDataFrame([(json.dumps({"word": w, "frequency": 1, "entries": e}),) for w, e, _ in CASES], "line string")
    got = {}
    for r in tagging.tag_words(tagging.by_part_of_speech(readers.validated_records(rows))).collect():
        got.setdefault(r.word, {})[r.part_of_speech] = r.tags
    assert got == {w: t for w, _, t in CASES}
    old = {r.word: r.tags for r in tagging.tag_words(tagging.by_part_of_speech(readers.validated_records(rows)), combined_case=False).where("word = 'слова'").collect()}
    assert old == {"слова": ["NON_NOMINATIVE", "SINGULAR"]}


def test_commands(spark, tmp_path, capsys):
    from lexspark.__main__ import main

    def lines(path):
        return [r.line for r in readers.indexed_lines(spark, str(path)).orderBy("row_idx").collect()]

    src = put(tmp_path / "l.txt", "1 Haus 5 x\n2 haus 3\n3 Ei 9\n4 wälder 2\n5 a1b2 3\n")
    main(["clean_leipzig", src, str(tmp_path / "clean")])
    assert lines(tmp_path / "clean") == ["haus,5,x", "wälder,2"]
    counted = put(tmp_path / "c.csv", "a,5\nb, 3\nc\nd,x\n")
    main(["split", counted, str(tmp_path / "c"), "4"])
    assert lines(tmp_path / "c-more-4.csv") == ["a,5"] and lines(tmp_path / "c-less-4.csv") == ["b, 3", "c", "d,x"]
    with pytest.raises(SystemExit):
        main(["split", counted, str(tmp_path / "c"), "0"])
    main(["freq", counted, str(tmp_path / "f"), "3"])
    assert lines(tmp_path / "f") == ["a,5", "b, 3"]
    put(tmp_path / "x-VALIDATED.csv", "new\n"), put(tmp_path / "y-VALIDATED.csv", "old\n")
    import os

    os.utime(tmp_path / "y-VALIDATED.csv", (100, 100))
    main(["combine_valid", str(tmp_path / "*"), str(tmp_path / "all")])
    assert lines(tmp_path / "all") == ["old", "new"]
    dictionary = put(tmp_path / "dictionary-4.txt", "abcd 9,N,x\n\nbcde 8,N,y\ncdef 7,N,z\ndefg 6,N,\n")
    main(["answers", dictionary, "25", "50", put(tmp_path / "ignore", "BCDE\n")])
    assert lines(tmp_path / "answers-4.txt") == ["cdef 7,N,z"]
    main(["split_wordforms", dictionary, str(tmp_path / "w"), "de, fg,q"])
    assert capsys.readouterr().out.splitlines()[-4:] == ["de - 1 records", "fg - 1 records", "q - 0 records", "rest - 3 records"]
    token = {"id": 2, "form": "f", "lemma": "l", "POS": "p", "features": "gen=M"}
    tokens = put(tmp_path / "t.jsonl", json.dumps({"sentences": [{"sentence_id": 0, "tokens": [token, token | {"id": 1, "lemma": 'q"'}]}]}))
    main(["morph_csv", tokens, str(tmp_path / "m")])
    assert "".join(f.read_text(encoding="utf-8") for f in sorted((tmp_path / "m").glob("part-*"))) == '\ufefflemma,POS,gender,number,person,tense\n"q""","p","M","","",""\n"l","p","M","","",""\n'
    put(tmp_path / "R2c.csv", ""), put(tmp_path / "c-VALIDATED.jsonl", "")
    main(["clean", str(tmp_path), "c"])
    assert not (tmp_path / "R2c.csv").exists() and not (tmp_path / "c-VALIDATED.jsonl").exists() and (tmp_path / "c.csv").exists()
    assert main(["no such"]) == 2


def test_dump_of_many_files(spark, monkeypatch):
    from lexspark.plans import files

    monkeypatch.setattr(files, "_DUMPED", 100)
    n = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    path = files._dump(spark, "/root/testdata/sf0.001")
    whole = [r.value for r in spark.read.text(path, wholetext=True).collect()]
    assert len(whole) == -(-n // 100) and max(s.count("<page>") for s in whole) < 200
    assert all(s.startswith("<mediawiki>\n<page>") and s.endswith("</page>\n</mediawiki>\n") for s in whole)
    assert readers.wiki_pages(spark, path).count() == n


def test_lists_in_splits(spark, tmp_path):
    text = ",".join(f" w{i}\n x" if i % 3 else f"\r\n\tw{i}  " for i in range(2000)) + ",,\n"
    listed, words = put(tmp_path / "l", text), put(tmp_path / "w", text.replace(" x", " X\n"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        for rows, expected in ((readers.comma_list(spark, listed), [w.strip() for w in text.split(",") if w.strip()]), (readers.boost_words(spark, words), {*text.replace(",", " ").split()})):
            assert sorted(r.word for r in rows.collect()) == sorted(expected)
        assert readers.comma_list(spark, listed).rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
