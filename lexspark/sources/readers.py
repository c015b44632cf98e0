"""Readers: text formats to tables. Lines come with ``row_idx``, their place in the input, where order matters."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from lexspark.functions import tagging
from lexspark.functions import text as T
from lexspark.operators import relational as R


#: Splits of an input up to which their table is broadcast.
SPLITS = 100_000


def located(rows: DataFrame, *columns: Column | str) -> DataFrame:
    """Columns of rows that come from files, and where each row stands: for ``in_file_order``."""
    return rows.select(*columns, F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_s"), F.col("_metadata.file_modification_time").alias("_t"), F.monotonically_increasing_id().alias("_m"))


def in_file_order(rows: DataFrame, by_time: bool = False) -> DataFrame:
    """``located`` rows with ``row_idx``, numbers from 0 without gaps by file name and place in the file, and
    ``source_ord``, the number of the file; with ``by_time`` the oldest file is the first.

    Rows of a split have consecutive ids, so a count by split gives every row its number, however splits are dealt to
    tasks: nothing is sorted but a table of a row for each split.
    """
    file = ["_t", "_f"] if by_time else ["_f"]
    splits = rows.groupBy("_t", "_f", "_s").agg(F.min("_m").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(*file, "_s").rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select("_f", "_s", "_first", F.coalesce(before, F.lit(0)).alias("_before"), (F.dense_rank().over(Window.orderBy(*file)) - 1).alias("source_ord"))
    offsets = F.broadcast(offsets) if rows.rdd.getNumPartitions() <= SPLITS else offsets
    own = [c for c in rows.columns if c not in ("_f", "_s", "_t", "_m")]
    return rows.join(offsets, ["_f", "_s"]).select(*own, (F.col("_before") + F.col("_m") - F.col("_first")).alias("row_idx"), "source_ord")


def indexed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, row_idx): numbers from 0 without gaps, by file name and place in the file."""
    return in_file_order(located(spark.read.text(path), F.col("value").alias("line"))).drop("source_ord")


def number_rows(rows: DataFrame, order: str, out: str = "row_idx") -> DataFrame:
    return R.running(rows, order, {out: (F.lit(1).cast("long"), "sum")})


def dump_candidates(lines: DataFrame) -> DataFrame:
    """(word, frequency, row_idx): lines split at every comma, without headers and lines that lack a word or number."""
    line = T.strip(F.col("line"))
    parts = F.transform(F.split(line, ",", -1), T.strip)
    rows = lines.select(line.alias("line"), parts.alias("p"), "row_idx").where(~F.lower("line").rlike("^(word|term),")).where("size(p) >= 2")
    return rows.select(F.col("p")[0].alias("word"), T.parse_int(F.col("p")[1]).alias("frequency"), "row_idx").where("word != '' and frequency is not null")


def cleanse_candidates(lines: DataFrame, least_frequency: int | None = None, least: int | None = None, most: int | None = None) -> DataFrame:
    """(word, frequency, line, row_idx): reads up to the first frequency below the least one; words by normalised length."""
    line = T.strip(F.col("line"))
    rows = lines.select(line.alias("line"), F.split(line, ",", 3).alias("p"), "row_idx").where(~F.col("line").contains("term_frequency")).where("size(p) >= 2")
    rows = rows.withColumn("frequency", T.parse_int(F.col("p")[1])).where("frequency is not null")
    if least_frequency is not None:
        rows = R.prefix_until(rows, "row_idx", F.col("frequency") < least_frequency)
    rows = rows.withColumn("word", T.normalize_term(F.col("p")[0]))
    size = F.char_length("word")
    right = (size >= least if least is not None else F.lit(True)) & (size <= most if most is not None else F.lit(True))
    return rows.where(right).select("word", "frequency", "line", "row_idx")


def ngram_top(table: DataFrame, year: int = 2019, n: int = 50_000, suffixes: Sequence[str] = ("NOUN", "VERB", "ADV", "ADJ"), letters: str = r"\p{L}", least: int = 4, most: int = 7) -> DataFrame:
    """(term, term_frequency): the most frequent terms of a year with a word of so many letters and a known suffix.

    ``table`` has (term, years array<struct<year, term_frequency>>).
    """
    rows = table.select("term", F.explode("years").alias("y")).where(F.col("y.year") == year)
    right = F.lit(False)
    for s in suffixes:
        right = right | F.col("term").rlike(f"^{letters}{{{least},{most}}}_{s}$")
    return rows.where(right).select("term", F.col("y.term_frequency").alias("term_frequency")).orderBy(F.desc("term_frequency"), "term").limit(n)


def variant_as(v: Column, kind: DataType) -> Column:
    """A variant as a type of structs, arrays and strings, each part on its own: what is of another kind is null, and what
    stands beside it is kept."""
    if isinstance(kind, StructType):
        fields = [variant_as(F.try_variant_get(v, f"$.{f.name}", "variant"), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(F.schema_of_variant(v).startswith("OBJECT"), F.struct(*fields))
    if isinstance(kind, ArrayType):
        return F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: variant_as(x, kind.elementType))
    return F.try_variant_get(v, "$", kind.simpleString())


def validated_records(lines: DataFrame) -> DataFrame:
    """(word, frequency, entries) of JSON lines. Broken lines, words that are blank and entries that are no list go; an item
    of the list that is no object is a null, and a field of another kind is, too.

    A frequency may be a number (cut to an integer) or a string of digits; anything else is 0. A line is parsed once, into
    a variant that all fields are taken from.
    """
    entries = StructType.fromDDL(f"entries array<{tagging.ENTRY}>")["entries"].dataType
    got = lambda name, kind: F.try_variant_get("v", f"$.{name}", kind)
    # exploded, as Spark would put the parser into each condition on a field otherwise
    rows = lines.where(T.strip(F.col("line")) != "").select(F.explode(F.array(F.try_parse_json("line"))).alias("v"))
    rows = rows.select(T.strip(F.coalesce(got("word", "string"), F.lit(""))).alias("word"), got("frequency", "string").alias("frequency"), got("entries", "array<variant>").alias("items"))
    rows = rows.where((F.col("word") != "") & F.col("items").isNotNull())
    number = F.coalesce(T.parse_int(F.col("frequency")), F.when(F.col("frequency").rlike(r"^-?[0-9]+\.[0-9]+$"), F.col("frequency").try_cast("double").cast("bigint")), F.lit(0).cast("bigint"))
    return rows.select("word", number.alias("frequency"), F.transform("items", lambda x: variant_as(x, entries.elementType)).alias("entries"))


#: A field behind a comma: in quotes with what follows them, in quotes that are not closed, or plain.
_FIELD = r',(?:"([^"]*+(?:""[^"]*+)*+)"([^,]*+)|"([^"]*+(?:""[^"]*+)*+)$|([^,]*+))'


def csv_fields(line: Column) -> Column:
    """The fields of a line by the usual rules of quotes, as many as there are: a quote opens only a field that it begins, is
    doubled within, and what is not closed goes on to the end. Of a field's four parts all but one or two are empty."""
    parts = [F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(i)).alias(f"p{i}") for i in range(1, 5)]
    single = lambda c: F.replace(c, F.lit('""'), F.lit('"'))
    return F.transform(F.arrays_zip(*parts), lambda p: F.concat(single(p["p1"]), p["p2"], single(p["p3"]), p["p4"]))


def ragged_fields(line: Column) -> Column:
    """Fields of a line of any number; lines without a quote are split at commas."""
    return F.when(line.contains('"'), csv_fields(line)).otherwise(F.split(line, ",", -1))


def tagged_rows(lines: DataFrame, header: bool = True) -> DataFrame:
    """(word, frequency, part_of_speech, tags, row_idx) of lines with any number of tags.

    With ``header`` the first line is one, whatever it holds. Empty lines go.
    """
    rows = lines.where("row_idx > 0") if header else lines
    rows = rows.where("line != ''").withColumn("f", ragged_fields(F.col("line")))
    at = lambda i: F.coalesce(F.try_element_at("f", F.lit(i)), F.lit(""))
    tags = F.when(F.size("f") > 3, F.slice("f", 4, F.greatest(F.size("f") - 3, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    return rows.select(at(1).alias("word"), T.parse_int(at(2)).alias("frequency"), at(3).alias("part_of_speech"), tags.alias("tags"), "row_idx")


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """(title, text) of the pages of a dump; compressed dumps are read as they are."""
    schema = "title string, revision struct<text:struct<_VALUE:string>>"
    rows = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    return rows.select("title", F.col("revision.text._VALUE").alias("text"))


#: A start tag whose name ends with "text", and what it holds up to the next tag: characters, comments and CDATA sections.
_TEXT_ELEMENT = r"""<((?:[\w.-]+:)?[\w.-]*text)(?:\s(?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+)?+(?<!/)>([^<]*+(?:<!(?:--(?s:.*?)-->|\[CDATA\[(?s:.*?)\]\]>)[^<]*+)*+)"""
_MARKED = re.compile(r"<!--.*?-->|<!\[CDATA\[(.*?)\]\]>|&#x([0-9A-Fa-f]+);|&#([0-9]+);|&(lt|gt|amp|quot|apos);", re.S)
_NAMED = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}


def _marked_text(s: str) -> str:
    """Comments out, CDATA sections and references spelt out."""

    def spelt(m: re.Match) -> str:
        if m[4]:
            return _NAMED[m[4]]
        return chr(int(m[2], 16)) if m[2] else chr(int(m[3])) if m[3] else m[1] or ""

    return _MARKED.sub(spelt, s)


@F.pandas_udf(StringType())
def _marked_texts(s: pd.Series) -> pd.Series:
    return s.map(_marked_text, na_action="ignore")


def xml_text(c: Column) -> Column:
    """The characters of an element's content: line ends as line feeds, references by name in the JVM; what has a section, a
    comment or a numbered reference goes to Python, as Spark has no function for code points beyond Latin-1."""
    plain = F.regexp_replace(c, "\r\n?", "\n")
    odd = c.contains("<") | c.contains("&#")
    named = plain
    for name in ("lt", "gt", "quot", "apos", "amp"):  # the ampersand last: what it makes is no reference
        named = F.replace(named, F.lit(f"&{name};"), F.lit(_NAMED[name]))
    return F.when(odd, _marked_texts(F.when(odd, plain))).otherwise(named)


def element_texts(spark: SparkSession, path: str) -> DataFrame:
    """(tag, text): the text before the first child of every element whose name ends with ``text``, whatever its prefix, if
    there is any.

    One scan: records end where a tag is closed, so a large file is many tasks, and an element's text is in one record with
    its start tag. A comment or CDATA section that holds a closing tag itself is cut by this, and raises an error.
    """
    records = spark.read.option("lineSep", "</").text(path)
    last = lambda start, end: F.locate(end, F.substring_index("value", start, -1)) == 0
    cut = F.coalesce((F.col("value").contains("<!--") & last("<!--", "-->")) | (F.col("value").contains("<![CDATA[") & last("<![CDATA[", "]]>")), F.lit(False))
    whole = F.when(cut, F.raise_error(F.lit("a comment or CDATA section that holds a closing tag")).cast("string")).otherwise(F.col("value"))
    found = records.where(F.col("value").contains("text")).select(whole.alias("value"))
    found = found.select(F.explode(F.arrays_zip(F.regexp_extract_all("value", F.lit(_TEXT_ELEMENT), F.lit(1)).alias("tag"), F.regexp_extract_all("value", F.lit(_TEXT_ELEMENT), F.lit(2)).alias("text"))).alias("e"))
    return found.select("e.tag", xml_text(F.col("e.text")).alias("text")).where("text != ''")


def key_values(lines: DataFrame, exact: bool = False) -> DataFrame:
    """(key, value): the first and last field of a line, comments out; with ``exact`` lines of two fields only."""
    f = F.filter(F.split(F.regexp_replace("line", "#.*$" if not exact else "^#.*$", ""), r"\s+"), lambda x: x != "")
    rows = lines.select(f.alias("f")).where("size(f) = 2" if exact else "size(f) >= 2")
    return rows.select(F.col("f")[0].alias("key"), F.element_at("f", -1).alias("value"))


def name_values(lines: DataFrame) -> DataFrame:
    """(key, value) of lines of two trimmed parts with a comma between."""
    p = F.transform(F.split("line", ",", -1), T.strip)
    return lines.where(~T.strip(F.col("line")).startswith("#")).select(p.alias("p")).where("size(p) = 2 and p[0] != '' and p[1] != ''").select(F.col("p")[0].alias("key"), F.col("p")[1].alias("value"))


def comma_list(spark: SparkSession, path: str) -> DataFrame:
    """(word): files split at commas only; line ends are blanks. A record is what stands between commas, so that a large file
    is many tasks."""
    words = spark.read.option("lineSep", ",").text(path)
    return words.select(T.strip(F.col("value")).alias("word")).where("word != ''")


def boost_words(spark: SparkSession, path: str) -> DataFrame:
    """(word), lower case: the column ``word`` of tables if the first line names it, else words between blanks or commas."""
    first = spark.read.text(path).limit(1).collect()
    if first and "word" in first[0].value.strip().split(",", 1)[0].lower():
        rows = spark.read.option("header", True).csv(path).select("word")
    else:
        rows = spark.read.text(path).select(F.explode(F.split("value", r"[\s,]+")).alias("word"))
    return rows.select(F.lower(T.strip(F.col("word"))).alias("word")).where("word != ''").distinct()


def union_by_time(spark: SparkSession, *paths: str) -> DataFrame:
    """(line, row_idx, source_ord): lines of several files, the oldest file first."""
    return in_file_order(located(spark.read.text(list(paths)), F.col("value").alias("line")), by_time=True)


def morph_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(sentence_id, id, form, lemma, POS, features) of JSON objects with sentences; others are left out."""
    token = "struct<id:bigint,form:string,lemma:string,POS:string,features:string>"
    rows = spark.read.schema(f"sentences array<struct<sentence_id:bigint,tokens:array<{token}>>>").json(path)
    return rows.where("sentences is not null").select(F.explode("sentences").alias("s")).select("s.sentence_id", F.explode("s.tokens").alias("t")).select("sentence_id", "t.*")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, row_idx): the records of tables with a header each, with numbers from 0 by file name and place; quoted fields
    may have line breaks, and a large file is many tasks.

    A line goes on with the record before it if the number of quotes before it is odd. Each split counts its quotes; a
    table of a row for each split tells whether it begins within quotes, and how many records are before it. Blank lines
    between records go. Lines end with a line feed, with or without a carriage return.
    """
    lines = located(spark.read.option("lineSep", "\n").text(path), F.col("value").alias("line")).drop("_t")
    lines = lines.withColumn("_q", (F.regexp_count("line", F.lit('"')) % 2).cast("long")).withColumn("_blank", F.col("line").isin("", "\r"))
    split, above = Window.partitionBy("_f", "_s"), Window.partitionBy("_f", "_s").orderBy("_m")
    upto = above.rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("_q").over(upto), F.lit(0)) % 2  # as if the split began outside of quotes

    # what each split holds if it begins outside (0) or within (1) quotes; only narrow columns move
    sides = lines.select("_f", "_s", "_m", "_q", "_blank").withColumn("_odd", odd).groupBy("_f", "_s").agg(F.sum("_q").alias("quotes"), *(F.count_if((F.col("_odd") == i) & ~F.col("_blank")).alias(f"n{i}") for i in (0, 1)))
    file = Window.partitionBy("_f").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_f", "_s").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    splits = sides.withColumn("_in", before("quotes", file) % 2).withColumn("n", F.when(F.col("_in") == 0, F.col("n0")).otherwise(F.col("n1")))
    splits = splits.withColumn("_above", before("n", file)).withColumn("_head", (F.col("_above") == 0).cast("long"))
    splits = splits.withColumn("_before", before(F.col("n") - F.least("_head", "n"), every)).select("_f", "_s", "_in", "_above", "_head", "_before")
    splits = F.broadcast(splits) if lines.rdd.getNumPartitions() <= SPLITS else splits

    # the record of each line: one that begins here, or the last one begun, be it in another split
    placed = lines.withColumn("_odd", odd).join(splits, ["_f", "_s"])
    begins = ((F.col("_odd") + F.col("_in")) % 2 == 0) & ~F.col("_blank")
    placed = placed.withColumn("_on", (F.col("_odd") + F.col("_in")) % 2).withColumn("_nth", F.sum(begins.cast("long")).over(above.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.where((F.col("_on") == 1) | ~F.col("_blank")).where(F.col("_above") + F.col("_nth") > 1)  # a file's first record is its header
    placed = placed.withColumn("row_idx", F.col("_before") + F.col("_nth") - 1 - F.col("_head"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_s", "_m", "line"))), lambda x: x["line"]), "\n")
    whole = placed.groupBy("row_idx").agg(joined.alias("record"))
    return whole.select(F.regexp_replace("record", "\r$", "").alias("record"), "row_idx")


def tagged_tables(spark: SparkSession, *paths: str, multi_line: bool = True) -> DataFrame:
    """(word, tag, definition, source_ord, row_idx) of tables with a header, in the order they are named. Fields in quotes
    may have line breaks; without ``multi_line`` none has, and lines need not be put together."""
    frames = []
    for path in paths:
        table = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
        wanted = [F.col(c) if c in table.columns else F.lit(None).cast("string").alias(c) for c in ("word", "tag", "definition")]
        if multi_line:
            schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in table.columns)
            fields = csv_records(spark, path).select(F.from_csv("record", F.lit(schema), {"escape": '"'}).alias("f"), "row_idx")
            frames.append(fields.select("f.*", "row_idx").select(*wanted, "row_idx"))
        else:
            frames.append(in_file_order(located(table, *wanted)).drop("source_ord"))
    return R.chained(*frames)


def dictionary_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, row_idx) without lines of white space."""
    return indexed_lines(spark, path).where(T.strip(F.col("line")) != "")


def word_forms(lines: DataFrame) -> DataFrame:
    """``lines`` with the word that each begins with."""
    return lines.withColumn("word", T.first_word_form(F.col("line")))


def game_config(spark: SparkSession, path: str) -> DataFrame:
    """A language's configuration: one row with the keyboard's layout, a map of actions, and messages."""
    schema = "menu string, flag string, layout array<array<string>>, actions map<string,struct<label:string,position:string,row:int>>, winMessage string, helpTip string"
    return spark.read.schema(schema).option("multiLine", True).json(path)
