import bz2
import csv
import io
import random
import re
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from lexspark.sources import readers, writers


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of a few hundred bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


# ---- tables with line breaks in fields


def table(seed: int, n: int) -> str:
    pick = random.Random(seed)
    out = io.StringIO()
    out.write("word,tag,definition,odd\n" if seed % 2 else 'tag,"odd\nname",word,definition\n')
    w = csv.writer(out, lineterminator="\n" if seed % 3 else "\r\n", quoting=csv.QUOTE_ALL if seed % 4 == 0 else csv.QUOTE_MINIMAL)
    for _ in range(n):
        w.writerow(["".join(pick.choices(["a", "é", ",", '"', "\n", "\n\n", "x y", "'"], k=pick.randrange(1, 9))) + "." for _ in range(4)])
        if pick.random() < 0.1:
            out.write("\n")
    return out.getvalue()


@pytest.mark.parametrize("seed", range(8))
def test_records_equal_the_csv_module(small_splits, tmp_path, seed):
    texts = [table(seed, 60), table(seed, 1), table(seed, 0)]
    for name, text in zip("abc", texts):
        (tmp_path / f"{name}.csv").write_text(text, newline="")
    got = readers.tagged_tables(small_splits, str(tmp_path)).orderBy("row_idx").collect()
    want = [(r["word"], r["tag"], r["definition"]) for t in texts for r in csv.DictReader(io.StringIO(t, newline=""))]
    assert [(r.word, r.tag, r.definition) for r in got] == want
    assert [r.row_idx for r in got] == list(range(len(want)))


def test_one_file_is_read_in_several_splits(small_splits, tmp_path):
    (tmp_path / "t.csv").write_text('word,definition\n' + "".join(f'w{i},"line {i}\nmore ""{i}"""\n' for i in range(100)))
    rows = readers.csv_records(small_splits, str(tmp_path / "t.csv"))
    assert small_splits.read.option("lineSep", "\n").text(str(tmp_path / "t.csv")).rdd.getNumPartitions() > 5
    assert [r.record for r in rows.orderBy("row_idx").collect()] == [f'w{i},"line {i}\nmore ""{i}"""' for i in range(100)]


def test_a_field_longer_than_a_split(small_splits, tmp_path):
    long = "\n".join(f"line {i}" for i in range(300))
    (tmp_path / "t.csv").write_text(f'word,definition\na,"{long}"\nb,c\n\n\nd,\n')
    got = readers.tagged_tables(small_splits, str(tmp_path / "t.csv")).orderBy("row_idx").collect()
    assert [(r.word, r.definition, r.row_idx) for r in got] == [("a", long, 0), ("b", "c", 1), ("d", None, 2)] or [(r.word, r.definition, r.row_idx) for r in got] == [("a", long, 0), ("b", "c", 1), ("d", "", 2)]


# ---- elements by name


DUMP = """<?xml version="1.0"?><mediawiki xmlns:a="u"><page><title>no text here</title>
<text xml:space="preserve" note="a &gt; b">one &lt;b&gt; &amp;lt; &#1330;&#x561; \r\n two</text><text/><text a='/' /><alttext
 x="1">alt</alttext><context>  </context><texts>none</texts></page>
<text>before<b>bold</b>after</text><text></text><text><!-- note -->kept <![CDATA[<raw> & &amp;]]> end</text><a:subtext>prefixed</a:subtext>
<x.text-text>dotted</x.text-text><text>%s</text></mediawiki>"""


def wanted(text: str) -> list[tuple[str, str]]:
    names = {"{u}subtext": "a:subtext"}
    return sorted((names.get(e.tag, e.tag), e.text) for e in ET.fromstring(text.encode()).iter() if e.tag.endswith("text") and e.text)


def test_element_texts_equal_the_parser(small_splits, tmp_path):
    text = DUMP % ("long " * 400)
    (tmp_path / "d.xml").write_text(text, newline="")
    (tmp_path / "e.xml.bz2").write_bytes(bz2.compress(text.encode()))
    for name in ("d.xml", "e.xml.bz2"):
        got = readers.element_texts(small_splits, str(tmp_path / name))
        assert sorted((r.tag, r.text) for r in got.collect()) == wanted(text)


def test_elements_are_read_in_one_scan(spark, tmp_path):
    (tmp_path / "d.xml").write_text(DUMP % "x")
    plan = readers.element_texts(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan|Scan text", plan)) <= 2 and plan.count("Location") == 1


def test_many_elements_over_many_splits(small_splits, tmp_path):
    (tmp_path / "d.xml").write_text("<r>" + "\n".join(f"<p><text>t{i}</text><n>{i}</n></p>" for i in range(500)) + "</r>")
    assert sorted(r.text for r in readers.element_texts(small_splits, str(tmp_path)).collect()) == sorted(f"t{i}" for i in range(500))


def test_a_closing_tag_in_a_comment_is_refused(spark, tmp_path):
    (tmp_path / "d.xml").write_text("<r><text>a<!-- </b> --></text></r>")
    with pytest.raises(Exception, match="closing tag"):
        readers.element_texts(spark, str(tmp_path)).collect()


# ---- runs that append


def buckets(spark, lo, hi):
    outcome = F.element_at(F.array(*map(F.lit, ("VALIDATED", "HARD", "NONEXISTENT", "REJECTED"))), (F.col("id") % 4 + 1).cast("int"))
    return spark.range(lo, hi).repartition(5).select(outcome.alias("outcome"), F.concat(F.lit("t"), "id").alias("token"), F.col("id").alias("frequency"), F.concat(F.lit("w"), "id").alias("word"), F.array(F.lit("NOUN")).alias("positions"), F.array().cast("array<string>").alias("tags"), F.col("id").alias("row_idx"))


def test_twenty_runs_are_read_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "PIECE", 7)
    for run in range(20):
        paths = writers.write_buckets(buckets(spark, 40 * run, 40 * run + 40), str(tmp_path), "x.csv", "csv", order="row_idx")
    for outcome, path in paths.items():
        lines = [r.line for r in readers.indexed_lines(spark, path).orderBy("row_idx").collect()]
        k = ["VALIDATED", "HARD", "NONEXISTENT", "REJECTED"].index(outcome)
        assert lines == [f"w{i},{i},NOUN," if k == 0 else f"t{i},{i}" for i in range(k, 800, 4)]


def test_appended_lines_are_in_order_by_run(spark, tmp_path):
    path = str(tmp_path / "lines")
    for run in range(12):
        rows = spark.range(100 * run, 100 * run + 100).repartition(4)
        writers.write_lines(rows, F.col("id").cast("string"), path, [F.col("id")], append=True)
    assert [r.line for r in readers.indexed_lines(spark, path).orderBy("row_idx").collect()] == [str(i) for i in range(1200)]


def test_buckets_are_one_write_and_replace_unless_they_append(spark, tmp_path):
    asked = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def slow(x):
        asked.add(1)
        return x

    rows = buckets(spark, 0, 40).withColumn("outcome", slow("outcome"))
    writers.write_buckets(rows, str(tmp_path), "x.csv", "csv", append=False)
    paths = writers.write_buckets(rows, str(tmp_path), "x.csv", "csv", append=False, order="row_idx")
    assert asked.value == 80  # each row once a run
    assert sum(spark.read.text(p).count() for p in paths.values()) == 40
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_writing")]


def test_empty_buckets_can_be_read_and_runs_are_never_shared(spark, tmp_path):
    paths = writers.write_buckets(buckets(spark, 0, 1), str(tmp_path), "x.csv", "csv")
    assert {o: spark.read.text(p).count() for o, p in paths.items()} == {"VALIDATED": 1, "HARD": 0, "NONEXISTENT": 0, "REJECTED": 0}
    assert [writers.claimed_run(spark, f"{tmp_path}/r", True)[-6:] for _ in range(3)] == ["000000", "000001", "000002"]


# ---- JSON records


def test_good_parts_of_records_are_kept(spark):
    lines = [
        '{"word": " a ", "frequency": 2.9, "entries": [5, "x", {"partOfSpeech": "n", "definitions": [7, {"definition": "d", "examples": ["e", 1], "labels": "no list"}]}, null]}',
        '{"word": "b", "frequency": "7", "entries": [{"definitions": {"definition": "no list"}, "language": "x", "more": 1}]}',
        '{"word": "c", "entries": {}}',
        '{"word": ["d"], "entries": []}',
        '[{"word": "e", "entries": []}]',
        '{"word": "f", "frequency": true, "entries": []}',
        '{"word": "g", "entries": [',
        "",
    ]
    rows = readers.validated_records(spark.createDataFrame([(x,) for x in lines], "line string"))
    got = {r.word: r for r in rows.collect()}
    assert {w: r.frequency for w, r in got.items() if not w.startswith("[")} == {"a": 2, "b": 7, "f": 0}
    a = got["a"].entries
    assert a[0] is None and a[1] is None and a[3] is None and a[2].partOfSpeech == "n" and a[2].definitions[0] is None
    assert a[2].definitions[1].definition == "d" and a[2].definitions[1].examples == ["e", "1"] and a[2].definitions[1].labels is None
    assert got["b"].entries[0].language == "x" and got["b"].entries[0].definitions is None
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") <= 1


# ---- lines of any number of fields


def test_fields_equal_the_csv_module(spark):
    pick = random.Random(9)
    lines = ["".join(pick.choices(['"', '""', ",", "a", "é", " ", "'", "b"], k=pick.randrange(1, 14))) for _ in range(3000)]
    lines += ['"', '""', '"""', '"a', 'a"b,c"d', '"a"b"c,d', ',"",', '"' + "x" * 20000, "," * 3000]
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, line string").repartition(4)
    got = {r.i: r.f for r in rows.select("i", readers.ragged_fields(F.col("line")).alias("f")).collect()}
    assert got == {i: next(csv.reader([x])) for i, x in enumerate(lines)}
