"""Registered queries over readers and sinks, which write to the shared folder and read back, and over rules that the test
tables have no data for: their rows are made from keys."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from itertools import chain, islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions import tagging, wikitext
from lexspark.functions import text as T
from lexspark.operators import lexicon, lookup, morph
from lexspark.operators import relational as R
from lexspark.plans import catalogue as C
from lexspark.plans import views as V
from lexspark.plans.catalogue import query
from lexspark.sources import live, readers, writers
from lexspark.streaming import filters


def _folder(spark: SparkSession, name: str) -> str:
    return f"{R.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _orders(spark, d) -> DataFrame:
    return V.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"))


def _pick(values: list[str | None], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (n % len(values) + 1).cast("int"))


def _sql_list(values: list[str | None]) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


def _sql_pick(values: list[str | None], n: str) -> str:
    return f"{_sql_list(values)}[({n}) % {len(values)} + 1]"


def _written(spark, rows: DataFrame, line: Column, name: str, order: Column | None = None) -> str:
    path = _folder(spark, name)
    writers.write_lines(rows, line, path, [order] if order is not None else None)
    return path


# ---- sinks, read back


def _classified(spark, d, words: DataFrame | None = None):
    """Words (token, frequency and others; those of lex) with the outcome of a look-up, and what validated rows are made of."""
    words = V.lex(spark, d).select(F.concat("word", F.lit("_NOUN")).alias("token"), "frequency") if words is None else words
    entry = F.struct(F.lit("noun").alias("partOfSpeech"), F.array(F.struct(F.concat(F.lit("d "), F.col("word")).alias("definition"))).alias("definitions"))
    return lookup.classify(words, C._snapshot(spark, d)).withColumns({"entries": F.array(entry), "positions": F.array(F.lit("NOUN")), "tags": F.array(F.lit("A"), F.lit("B"))})


_SQL_OUTCOME = "CASE frequency % 5 WHEN 1 THEN 'NONEXISTENT' WHEN 3 THEN 'RETRY' ELSE CASE WHEN frequency % 2 = 0 THEN 'VALIDATED' ELSE 'REJECTED' END END"


@query(f"""WITH {V.SQL_LEX}, c AS (SELECT word, frequency, {_SQL_OUTCOME} AS outcome FROM lex)
  SELECT CASE outcome WHEN 'VALIDATED' THEN 'words-VALIDATED.jsonl' WHEN 'RETRY' THEN 'Rwords.csv' WHEN 'NONEXISTENT' THEN 'Nwords.csv' ELSE 'words-REJECTED.csv' END AS bucket,
    CASE outcome WHEN 'VALIDATED' THEN word ELSE word || '_NOUN' END AS word, frequency, CASE outcome WHEN 'VALIDATED' THEN 'd ' || word END AS definition FROM c""")
def bucket_files(spark, d):
    """The four buckets of the dump tool, written twice (the second replaces the first) and read"""
    folder = _folder(spark, "buckets")
    for _ in range(2):
        paths = writers.write_buckets(_classified(spark, d), folder, "/in/words.CSV")
    name = lambda o: F.lit(paths[o].rsplit("/", 1)[1]).alias("bucket")
    valid = readers.validated_records(readers.indexed_lines(spark, paths["VALIDATED"]))
    out = valid.select(name("VALIDATED"), "word", "frequency", F.col("entries")[0]["definitions"][0]["definition"].alias("definition"))
    for outcome in ("RETRY", "NONEXISTENT", "REJECTED"):
        rows = readers.dump_candidates(readers.indexed_lines(spark, paths[outcome]))
        out = out.unionByName(rows.select(name(outcome), "word", "frequency", F.lit(None).cast("string").alias("definition")))
    return out


@query(f"""WITH {V.SQL_LEX}, c AS (SELECT word, frequency, {_SQL_OUTCOME} AS outcome FROM lex),
  b AS (SELECT CASE outcome WHEN 'VALIDATED' THEN 'words-VALIDATED.csv' WHEN 'RETRY' THEN 'Rwords.csv' WHEN 'NONEXISTENT' THEN 'Nwords.csv' ELSE 'words-REJECTED.csv' END AS bucket, frequency % 3 AS run, word,
    CASE outcome WHEN 'VALIDATED' THEN word || ',' || frequency || ',NOUN,A,B' ELSE word || '_NOUN,' || frequency END AS line FROM c)
  SELECT bucket, line, row_number() OVER (PARTITION BY bucket ORDER BY run, word) - 1 AS nth FROM b""")
def bucket_files_cleanse(spark, d):
    """The buckets of the other tool; a first run is cleaned away, then three runs append in order"""
    folder = _folder(spark, "buckets")
    source = _written(spark, V.lex(spark, d), F.concat(F.col("word"), F.lit("_NOUN,"), F.col("frequency").cast("string")), "candidates", F.col("word"))
    words = readers.dump_candidates(readers.indexed_lines(spark, source)).withColumnRenamed("word", "token")
    rows = _classified(spark, d, words).withColumn("outcome", F.when(F.col("outcome") == "RETRY", "HARD").otherwise(F.col("outcome")))
    writers.write_buckets(rows, folder, "words.csv", "csv", order="row_idx")
    writers.clean(spark, folder, "words")
    for run in range(3):
        paths = writers.write_buckets(rows.where(F.col("frequency") % 3 == run), folder, "words.csv", "csv", order="row_idx")
    out = None
    for path in paths.values():
        lines = readers.indexed_lines(spark, path).select(F.lit(path.rsplit("/", 1)[1]).alias("bucket"), "line", F.col("row_idx").alias("nth"))
        out = lines if out is None else out.unionByName(lines)
    return out


_SQL_NTH = "row_number() OVER (PARTITION BY len ORDER BY count DESC, line) - 1 AS nth"


@query(f"WITH {C.SQL_COMBINE}, l AS (SELECT length(word) AS len, count, word || ' ' || count || ',' || tag || ',' || definition AS line FROM combined) SELECT len, {_SQL_NTH}, line FROM l")
def dictionary_files(spark, d):
    """A folder for each length, whose files have the lines in order"""
    folder = _folder(spark, "dictionaries")
    writers.write_lines(lexicon.dictionary_lines(C._combined(spark, d)), F.col("line"), folder, [-F.col("count"), F.col("line")], by="len")
    rows = readers.in_file_order(readers.located(spark.read.text(folder), F.col("value").alias("line"), F.col("len").cast("int").alias("len")))
    first = rows.groupBy("len").agg(F.min("row_idx").alias("first"))
    return rows.join(first, "len").select("len", (F.col("row_idx") - F.col("first")).alias("nth"), "line")


@query(f"""WITH {C.SQL_COMBINE}, l AS (SELECT word, count, word || ' ' || count || ',' || tag || ',' || definition AS line, row_number() OVER (ORDER BY count DESC, word) - 1 AS i, count(*) OVER () AS n FROM combined WHERE length(word) = 6),
  s AS (SELECT * FROM l WHERE i >= floor(n * 10 / 100.0) AND i < floor(n * 10 / 100.0) + floor(n * 25 / 100.0)) SELECT 'answers-6.txt' AS file, row_number() OVER (ORDER BY i) - 1 AS nth, line FROM s WHERE NOT word LIKE '%s'""")
def answers_file(spark, d):
    """Answers beside their dictionary"""
    lines = lexicon.dictionary_lines(C._combined(spark, d)).where("len = 6")
    order = [F.desc("count"), F.asc("line")]
    answers = lexicon.answers(lines, order, 10, 25, V.lex(spark, d).where("word like '%s'").select("word"))
    path = writers.write_answers(answers, [-F.col("count"), F.col("line")], f"{_folder(spark, 'game')}/dictionary-6.txt")
    return readers.indexed_lines(spark, path).select(F.lit(path.rsplit("/", 1)[1]).alias("file"), F.col("row_idx").alias("nth"), "line")


_SUFFIXES = ["er", "ing", "s", "zzz"]


@query(f"""WITH {V.SQL_LEX}, l AS (SELECT word || ['.x', ' 3', ',b', ''][frequency % 4 + 1] AS line, CASE WHEN word LIKE '%er' THEN 'er' WHEN word LIKE '%ing' THEN 'ing' WHEN word LIKE '%s' THEN 's' ELSE 'rest' END AS suffix FROM lex UNION ALL SELECT '', 'rest'),
  n AS (SELECT suffix, count(*) AS records FROM l GROUP BY suffix UNION ALL SELECT 'zzz', 0) SELECT suffix, records, line FROM n LEFT JOIN l USING (suffix)""")
def suffix_files(spark, d):
    """Lines by the suffix of their first word, and the records of each file"""
    lines = V.lex(spark, d).select(F.concat("word", _pick([".x", " 3", ",b", ""], F.col("frequency"))).alias("line"), F.crc32("word").alias("row_idx"))
    folder = _folder(spark, "suffixes")
    counts = writers.write_suffixes(lines.unionByName(spark.createDataFrame([("", 0)], "line string, row_idx long")), _SUFFIXES, folder)
    back = spark.read.text(folder).select("suffix", F.col("value").alias("line"))
    return counts.join(back, "suffix", "left").select("suffix", "records", "line")


@query(f"WITH {V.SQL_LEX} SELECT word, frequency, CASE WHEN frequency >= 10 THEN 'more' ELSE 'less' END AS side FROM lex")
def split_files(spark, d):
    """K12"""
    folder = _folder(spark, "split")
    writers.write_split(V.lex(spark, d), "frequency", 10, folder)
    return spark.read.schema("word string, frequency long, side string").csv(folder)


@query(f"WITH p AS (SELECT {C._SQL_TITLE} AS word, o_orderkey % 10 AS m FROM orders WHERE o_orderkey % 10 < 5) SELECT word, CASE m WHEN 2 THEN '-hy-ածխ-' WHEN 3 THEN 'NOUN' ELSE '' END AS tag, ['REDIRECT', 'no tag', '-hy-ածխ-', 'no desc', 'no tag'][m + 1] AS filter, '' AS definition FROM p")
def reject_log(spark, d):
    """The log of pages that gave nothing, as a table with a header"""
    folder = _folder(spark, "rejected")
    writers.write_table(wikitext.rejected(wikitext.classify_pages(C._pages(spark, d))), folder)
    rows = spark.read.option("header", True).option("escape", '"').csv(folder)
    return rows.select(*(F.coalesce(c, F.lit("")).alias(c) for c in rows.columns))


_NOTES = ["a,b", 'say "x"', "tab\there", "", "plain"]


@query(f"WITH t AS (SELECT o_orderkey AS k, {_sql_list(_NOTES)}[o_orderkey % 5 + 1] AS note FROM orders) SELECT k, note, note AS tabbed FROM t")
def table_files(spark, d):
    """K8: the same rows with commas and a header, and with tabs and none"""
    rows = _orders(spark, d).select("k", _pick(_NOTES, F.col("k")).alias("note"))
    commas, tabs = _folder(spark, "commas"), _folder(spark, "tabs")
    writers.write_table(rows, commas)
    writers.write_table(rows, tabs, tabs=True, header=False)
    back = spark.read.option("header", True).option("escape", '"').csv(commas).select(F.col("k").cast("long").alias("k"), F.coalesce("note", F.lit("")).alias("note"))
    other = spark.read.schema("k long, tabbed string").option("sep", "\t").option("escape", '"').csv(tabs)
    return back.join(other.withColumn("tabbed", F.coalesce("tabbed", F.lit(""))), "k")


@query(f"WITH {C.SQL_CONLL} SELECT sentence_id, to_json({{'sentence_id': sentence_id, 'tokens': list({{'id': id, 'form': '\"' || form || '\\', 'lemma': lemma, 'POS': \"POS\", 'features': features}} ORDER BY row_idx)}})::VARCHAR AS value FROM t GROUP BY sentence_id")
def sentence_objects(spark, d):
    """An object a sentence; quotes and backslashes are escaped"""
    tokens = morph.conll_tokens(C._conll_lines(spark, d)).withColumn("form", F.concat(F.lit('"'), "form", F.lit("\\")))
    rows = writers.sentences_json(morph.sentences(tokens))
    return rows.select(F.get_json_object("value", "$.sentence_id").cast("long").alias("sentence_id"), "value")


_FEATURES = ["gen=M|num=S|per=3", "gen=F|tense=PAST", "", None, "num=P|gen=X"]


@query(f"""WITH t AS (SELECT o_orderkey AS k, {_sql_pick(_FEATURES, 'o_orderkey')} AS f FROM orders WHERE o_orderkey % 7 <> 0),
  l AS (SELECT '"l""' || k || '","' || ['NN', 'VB'][k % 2 + 1] || '","' || coalesce(regexp_extract(f, 'gen=([MF])', 1), '') || '","' || coalesce(regexp_extract(f, 'num=([SP])', 1), '') || '","' || coalesce(regexp_extract(f, 'per=([123])', 1), '') || '","' || coalesce(regexp_extract(f, 'tense=([A-Z]+)', 1), '') || '"' AS line FROM t)
  SELECT chr(65279) || 'lemma,POS,gender,number,person,tense' AS line UNION ALL SELECT line FROM l""")
def morph_file(spark, d):
    """Token objects read, and their features written in quotes behind a header and a byte-order mark"""
    k = F.col("k")
    token = F.struct(k.alias("id"), F.lit("f").alias("form"), F.concat(F.lit('l"'), k.cast("string")).alias("lemma"), _pick(["NN", "VB"], k).alias("POS"), _pick(_FEATURES, k).alias("features"))
    value = F.when(k % 7 == 0, F.lit('{"batch": 1}')).otherwise(F.to_json(F.struct(F.array(F.struct(k.alias("sentence_id"), F.array(token).alias("tokens"))).alias("sentences"))))
    tokens = readers.morph_tokens(spark, _written(spark, _orders(spark, d), value, "objects"))
    rows = tokens.select("id", "lemma", "POS", *morph.feature_columns(F.col("features")))
    path = _folder(spark, "morphology")
    writers.write_quoted(rows, ["lemma", "POS", "gender", "number", "person", "tense"], "id", path)
    # Spark's reader of lines would take the mark away
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")).where("line != ''")


_LETTERS, _ENDINGS = "אבגדהוזחטי", ["ים", "ות", "־א", "", " ב", "."]
_SQL_LISTED = f"CASE WHEN c_custkey % 6 = 0 THEN 'קטגוריה:' ELSE '' END || translate(c_custkey::VARCHAR, '0123456789', '{_LETTERS}') || {_sql_pick(_ENDINGS, 'c_custkey')}"
#: Members of a page of the listing.
_PAGE = 1000


def _listing(batches: Iterator[pd.DataFrame]) -> live.Ask:
    """A listing of rows (k, title), which come in order: pages of ``_PAGE`` members, of which only the one that is asked for
    is held."""
    rows = chain.from_iterable(zip(b["k"], b["title"]) for b in batches)
    ahead = list(islice(rows, 1))

    def ask(at: str | None) -> tuple[list[str], str | None]:
        if at is not None and at != str(ahead[0][0]):
            raise ValueError(f"no page begins at {at}")
        page = [*ahead, *islice(rows, _PAGE - len(ahead))]
        ahead[:] = islice(rows, 1)
        return [title for _, title in page], str(ahead[0][0]) if ahead else None

    return ask


@query(f"WITH t AS (SELECT {_SQL_LISTED} AS title FROM customer) SELECT title FROM t WHERE NOT starts_with(title, 'קטגוריה:') AND length(title) BETWEEN 4 AND 6 AND NOT regexp_matches(title, '[,.״ ־׳]')")
def category_list(spark, d):
    """A listing of customers that comes in pages, each of which tells where the next one begins, in ranges of
    keys; filtered, written one title to a line and read"""
    k = F.col("c_custkey")
    title = F.concat(F.when(k % 6 == 0, "קטגוריה:").otherwise(""), F.translate(k.cast("string"), "0123456789", _LETTERS), _pick(_ENDINGS, k))
    members = V.table(spark, d, "customer").where(k >= 0).select(k.alias("k"), title.alias("title"))
    titles = live.listed(members.repartitionByRange("k").sortWithinPartitions("k"), _listing)
    path = _written(spark, morph.lemma_filter(titles), F.col("title"), "titles")
    return readers.indexed_lines(spark, path).select(F.col("line").alias("title"))


# ---- sources


@query("SELECT 'm' || o_orderkey AS line, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS source_ord, row_number() OVER (ORDER BY CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END, o_orderkey) - 1 AS row_idx FROM orders")
def union_by_time(spark, d):
    """Files of lines, the oldest first, whatever their names"""
    rows, line = _orders(spark, d), F.concat(F.lit("m"), F.col("k").cast("string"))
    paths = [_folder(spark, name) for name in ("z", "a")]
    for path, part in zip(paths, (rows.where("k % 3 = 0"), rows.where("k % 3 != 0"))):
        part.coalesce(1).sortWithinPartitions("k").select(line.alias("value")).write.text(path)  # a file each
    return readers.union_by_time(spark, *reversed(paths)).select("line", "source_ord", "row_idx")


_DEFINITIONS = ["one, two", 'a "b"', "line\nbreak", "é"]


@query(f"""WITH t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS source_ord FROM orders)
  SELECT 'w' || k AS word, CASE source_ord WHEN 0 THEN 'NOUN' END AS tag, {_sql_pick(_DEFINITIONS, 'k')} AS definition, source_ord, row_number() OVER (PARTITION BY source_ord ORDER BY k) - 1 AS row_idx FROM t""")
def tagged_table_files(spark, d):
    """Tables with headers in the order they are named; one has no tags and an odd column"""
    rows = _orders(spark, d).select("k", F.concat(F.lit("w"), F.col("k").cast("string")).alias("word"), F.lit("NOUN").alias("tag"), _pick(_DEFINITIONS, F.col("k")).alias("definition"))
    paths = [_folder(spark, "main"), _folder(spark, "augment")]
    for path, part in zip(paths, (rows.where("k % 3 = 0").drop("k"), rows.where("k % 3 != 0").select("definition", F.lit(1).alias("odd"), "word", "k"))):
        ordered = part.coalesce(1).sortWithinPartitions(F.col("word").substr(F.lit(2), F.lit(20)).cast("long"))
        writers.write_table(ordered.drop("k"), path)  # one file, with line breaks in fields, that is read in splits
    return readers.tagged_tables(spark, *paths)


#: Lines of each kind of configuration file; %s is an order's key. A list ends its lines with a comma, which separates.
_CONFIG = {
    "map": ["-hy-%s-  ADJ # x", "X%s 5 7", "", "# keys", "ONE%s", "\tY%s#z", "Z%s  N%s"],
    "weights": ["NOUN%s 12", "A%s B 3", "VERB%s\t10", "#N%s 1", " P%s  7 "],
    "names": ["Ածական%s,ած", "#x%s,y", " Թվ%s , թվ", "a,b%s,c", ",z%s"],
    "skip": [" a%s, b c%s ,", ",", "d%s,,", " , e%s,"],
    "boost": ["A%s b%s,c%s", "", "D%s"],
    "boost table": ["E%s,1", "f%s ,2", ",3"],
}


def _config_line(kind: str, n: Column) -> Column:
    return F.replace(_pick(_CONFIG[kind], n), F.lit("%s"), n.cast("string"))


@query("""WITH k AS (SELECT o_orderkey::VARCHAR AS k, o_orderkey % 7 AS m, o_orderkey % 5 AS f, o_orderkey % 4 AS q, o_orderkey % 3 AS t FROM orders),
  c AS (SELECT 'map' AS kind, CASE m WHEN 0 THEN '-hy-' || k || '-' WHEN 1 THEN 'X' || k WHEN 6 THEN 'Z' || k END AS key, CASE m WHEN 0 THEN 'ADJ' WHEN 1 THEN '7' WHEN 6 THEN 'N' || k END AS value FROM k
  UNION ALL SELECT 'weights', CASE f WHEN 0 THEN 'NOUN' WHEN 2 THEN 'VERB' WHEN 4 THEN 'P' END || k, CASE f WHEN 0 THEN '12' WHEN 2 THEN '10' WHEN 4 THEN '7' END FROM k
  UNION ALL SELECT 'names', CASE f WHEN 0 THEN 'Ածական' WHEN 2 THEN 'Թվ' END || k, CASE f WHEN 0 THEN 'ած' WHEN 2 THEN 'թվ' END FROM k
  UNION ALL SELECT 'skip', CASE q WHEN 0 THEN 'a' WHEN 2 THEN 'd' WHEN 3 THEN 'e' END || k, NULL FROM k UNION ALL SELECT 'skip', CASE q WHEN 0 THEN 'b c' || k END, NULL FROM k
  UNION ALL SELECT 'boost', unnest(CASE t WHEN 0 THEN ['a' || k, 'b' || k, 'c' || k] WHEN 2 THEN ['d' || k] ELSE [] END), NULL FROM k
  UNION ALL SELECT 'boost table', CASE t WHEN 0 THEN 'e' WHEN 1 THEN 'f' END || k, NULL FROM k)
  SELECT kind, key, value FROM c WHERE key IS NOT NULL""")
def config_files(spark, d):
    """Files of keys and values, names, comma lists and boosted words, a line for each order"""
    k = F.col("k")
    rows = _orders(spark, d)
    paths = {kind: _written(spark, rows, _config_line(kind, k), kind.replace(" ", "-"), k) for kind in _CONFIG if kind != "boost table"}
    # tables with a header each; fields keep their blanks
    fields = F.split(_config_line("boost table", k), ",")
    paths["boost table"] = _folder(spark, "boost-table")
    rows.select(fields[0].alias("word"), fields[1].alias("n")).write.options(header=True, ignoreTrailingWhiteSpace=False, ignoreLeadingWhiteSpace=False).csv(paths["boost table"])
    lines = {kind: readers.indexed_lines(spark, path) for kind, path in paths.items()}
    lists = {"skip": readers.comma_list(spark, paths["skip"]), "boost": readers.boost_words(spark, paths["boost"]), "boost table": readers.boost_words(spark, paths["boost table"])}
    out = [("map", readers.key_values(lines["map"])), ("weights", readers.key_values(lines["weights"], exact=True)), ("names", readers.name_values(lines["names"]))]
    out += [(kind, rows.select(F.col("word").alias("key"), F.lit(None).cast("string").alias("value"))) for kind, rows in lists.items()]
    every = [rows.select(F.lit(kind).alias("kind"), "key", "value") for kind, rows in out]
    return R.chained(*every).drop("source_ord")


#: Pages of a file of the dump, on average.
_DUMPED = 50_000


def _dump(spark, d) -> str:
    """Pages as a compressed dump of several files, as many as keep them small: lines are sorted into their files, which no
    task holds."""
    k = F.col("k").cast("string")
    page = F.concat(F.lit("<page><title>t &amp; "), k, F.lit('</title><revision><comment>c</comment><text xml:space="preserve">{{-hy-գո-}} &lt;b&gt; '), k, F.lit("</text></revision>"), F.when(F.col("k") % 3 == 0, F.concat(F.lit("<alttext>alt "), k, F.lit("</alttext>"))).otherwise(""), F.lit("<context/></page>"))
    path, rows = _folder(spark, "dump"), _orders(spark, d).where("k is not null")
    files = max(4, -(-rows.count() // _DUMPED))
    pages = rows.select(F.pmod(F.xxhash64("k"), F.lit(files)).alias("file"), F.lit(1).alias("at"), page.alias("value"))
    ends = F.array(F.struct(F.lit(0).alias("at"), F.lit("<mediawiki>").alias("value")), F.struct(F.lit(2).alias("at"), F.lit("</mediawiki>").alias("value")))
    lines = pages.unionByName(spark.range(files).select(F.col("id").alias("file"), F.inline(ends)))
    lines = lines.repartition(files, "file").sortWithinPartitions("file", "at").drop("at")
    lines.write.option("compression", "bzip2").partitionBy("file").text(path)
    return path


@query("SELECT 't & ' || o_orderkey AS title, '{{-hy-գո-}} <b> ' || o_orderkey AS text FROM orders")
def dump_pages(spark, d):
    """Titles and texts of a compressed dump"""
    return readers.wiki_pages(spark, _dump(spark, d))


@query("SELECT 'text' AS tag, '{{-hy-գո-}} <b> ' || o_orderkey AS text FROM orders UNION ALL SELECT 'alttext', 'alt ' || o_orderkey FROM orders WHERE o_orderkey % 3 = 0")
def dump_texts(spark, d):
    """Every element whose name ends with text"""
    return readers.element_texts(spark, _dump(spark, d))


@query(f"WITH t AS (SELECT o_orderkey AS k, 'w' || o_orderkey AS word FROM orders WHERE o_orderkey % 5 < 3) SELECT word, word || {_sql_pick([' 7,N', '-x', ':'], 'k % 5')} AS line FROM t")
def dictionary_scan(spark, d):
    """Lines without blank ones, and the word that each begins with"""
    k = F.col("k")
    line = F.when(k % 5 == 3, " \t").when(k % 5 == 4, "").otherwise(F.concat(F.lit("w"), k.cast("string"), _pick([" 7,N", "-x", ":", "", ""], k)))
    return readers.word_forms(readers.dictionary_lines(spark, _written(spark, _orders(spark, d), line, "dictionary", k))).select("word", "line")


_RECORDS = ['{"word": " w%s ", "frequency": 3, "entries": [{"partOfSpeech": "Noun", "definitions": [{"definition": "d"}]}]}', '{"word": "w%s", "frequency": "1_2", "entries": []}', '{"word": "w%s", "frequency": 3.7, "entries": [null, {"partOfSpeech": "x"}]}', '{"word": "w%s", "entries": "no list"}', '{"word": "", "entries": []}', "{broken %s", '{"word": "w%s", "frequency": "x", "entries": [{"definitions": 5}]}', '{"word": "w%s"}']


@query("SELECT 'w' || o_orderkey AS word, [3, 12, 3, NULL, NULL, NULL, 0][o_orderkey % 8 + 1] AS frequency FROM orders WHERE o_orderkey % 8 IN (0, 1, 2, 6)")
def record_guards(spark, d):
    """Records that are broken or of other types go, odd numbers are read"""
    line = F.replace(_pick(_RECORDS, F.col("k")), F.lit("%s"), F.col("k").cast("string"))
    return readers.validated_records(readers.indexed_lines(spark, _written(spark, _orders(spark, d), line, "records"))).select("word", "frequency")


# ---- text and page rules


@query("""WITH w AS (SELECT unnest(regexp_extract_all(text, '[Ա-Ֆա-ֆ]+')) AS w FROM (SELECT translate(CAST(o_orderkey * 7919 AS VARCHAR), '0123456789', 'ԱբգԴեզէըթժ') || [' ', 'և', 'x'][o_orderkey % 3 + 1] || translate(CAST(o_orderkey AS VARCHAR), '0123456789', 'աբԳդեզէԸթժ') AS text FROM orders))
  SELECT lower(w) AS word, count(*) AS count FROM w WHERE length(w) BETWEEN 4 AND 7 GROUP BY 1""")
def armenian_counts(spark, d):
    """Words of Armenian letters; a wider window is not widened"""
    k = F.col("k")
    text = F.concat(F.translate((k * 7919).cast("string"), "0123456789", "ԱբգԴեզէըթժ"), _pick([" ", "և", "x"], k), F.translate(k.cast("string"), "0123456789", "աբԳդեզէԸթժ"))
    return lexicon.word_counts(_orders(spark, d).select(F.explode(T.armenian_words(text, 2, 12)).alias("word")))


_BROKEN = ['{"POS":"NN,"id":1}', '{"POS":"NN","id":1}', '{"POS":","POS":"VB,"}', "x"]


@query(f"SELECT o_orderkey AS k, {_sql_list(['{\"POS\":\"NN\",\"id\":1}', '{\"POS\":\"NN\",\"id\":1}', '{\"POS\":\"\",\"POS\":\"VB,\"}', 'x'])}[o_orderkey % 4 + 1] AS line FROM orders")
def quote_repair(spark, d):
    """F37"""
    return _orders(spark, d).select("k", T.repair_pos_quote(_pick(_BROKEN, F.col("k"))).alias("line"))


_TITLES = ["a b", "50%", "%41", "%4", "é~*", "x+y/z?", "", "-_.!'()"]


@query(f"SELECT k, word, CASE WHEN contains(word, '%') AND NOT contains(regexp_replace(word, '%[0-9A-Fa-f]{{2}}', '', 'g'), '%') THEN word ELSE url_encode(word) END AS title FROM (SELECT o_orderkey AS k, {_sql_list(_TITLES)}[o_orderkey % 8 + 1] || CASE WHEN o_orderkey % 3 = 0 THEN 'ք' ELSE '' END AS word FROM orders)")
def url_title(spark, d):
    """percent-encoded, unless the word already is"""
    word = F.concat(_pick(_TITLES, F.col("k")), F.when(F.col("k") % 3 == 0, "ք").otherwise(""))
    return _orders(spark, d).select("k", word.alias("word")).withColumn("title", T.url_title(F.col("word")))


_RULED = ["{{-hy-գո-}}\n# ա բառ\n# գ %s\n", "{{-hy-գո-}}\n# մի եւ\n# երկու %s\n# երեք", "{{-hy-գո-}}\n# մի, եւ\n# չորս եւ %s\n", "{{-hy-ած-}}\n* աստղ %s\n- գիծ\n", "=== Բայ ===\nգրել %s\n", "{{-hy-գո-}}\n==Ստուգաբանություն==\n# ծագում %s\n", "{{-hy-գո-}}\n# ա\n"]
_RULED_OUT = [("NOUN", "գ "), ("NOUN", "երկու "), ("NOUN", "չորս եւ "), ("ADJ", "աստղ "), ("VERB", "գրել "), ("NOUN", "ծագում ")]
_SQL_RULED = f"p AS (SELECT o_orderkey AS k, o_orderkey % 7 AS m, {C._SQL_TITLE} AS t, o_orderkey IN (1, 2, 3, 4) AS skipped FROM orders WHERE NOT (o_orderkey % 11 = 0))"


def _ruled_pages(spark, d) -> DataFrame:
    k = F.col("k")
    title = F.translate((k + 10000).cast("string"), "0123456789", "աբգդեզէըթժ")
    text = F.replace(_pick(_RULED, k), F.lit("%s"), k.cast("string"))
    return _orders(spark, d).select(F.when(k % 11 == 0, F.concat(title, title)).otherwise(title).alias("title"), text.alias("text"))


def _skipped() -> tuple[str, ...]:
    return tuple(str(k + 10000).translate(str.maketrans("0123456789", "աբգդեզէըթժ")) for k in (1, 2, 3, 4))


def _first_section(classified: DataFrame) -> DataFrame:
    return classified.select("title", "outcome", "reason", F.try_element_at("sections", F.lit(1))["tag"].alias("tag"), F.try_element_at("sections", F.lit(1))["desc"].alias("definition"))


@query(f"""WITH {_SQL_RULED} SELECT t AS title, CASE WHEN skipped OR m = 6 THEN 'filtered' ELSE 'extracted' END AS outcome, CASE WHEN skipped THEN 'skipped' WHEN m = 6 THEN 'no desc' ELSE 'extracted' END AS reason,
  CASE WHEN NOT skipped THEN {_sql_list([t for t, _ in _RULED_OUT] + [None])}[m + 1] END AS tag, CASE WHEN NOT skipped THEN {_sql_list([t for _, t in _RULED_OUT] + [None])}[m + 1] || k END AS definition FROM p""")
def page_rules(spark, d):
    """Filter and trigger words, list marks, unmarked lines, a header that moves, a skip list, long titles"""
    rules = wikitext.Rules(filter_words=wikitext.word_list(" ա ,, չկա"), trigger_words=wikitext.word_list("եւ"))
    return _first_section(wikitext.classify_pages(_ruled_pages(spark, d), rules, skip=_skipped()))


@query(f"WITH {_SQL_RULED} SELECT t AS title, CASE WHEN m IN (3, 4, 5) THEN 'filtered' ELSE 'extracted' END AS outcome, CASE m WHEN 3 THEN 'no desc' WHEN 4 THEN 'no tag' WHEN 5 THEN 'no desc' ELSE 'extracted' END AS reason, CASE WHEN m NOT IN (3, 4, 5) THEN 'NOUN' END AS tag, CASE m WHEN 0 THEN 'ա բառ' WHEN 1 THEN 'մի եւ' WHEN 2 THEN 'մի, եւ' WHEN 6 THEN 'ա' END AS definition FROM p")
def page_rules_skipped(spark, d):
    """The same pages without the first three steps"""
    return _first_section(wikitext.classify_pages(_ruled_pages(spark, d), wikitext.Rules(skip_steps=wikitext.word_list("pp0, pp1,pp2"))))


#: A page whose text every step but the last changes, and one that none does.
_TRACED = ["=== Գոյական ===\n* %s\n==Ստուգաբանություն==", "{{-hy-գո-}}\n# %s"]
_AFTER = [("input", "=== Գոյական ===\n* %s\n==Ստուգաբանություն=="), ("pp0", "{{-hy-գո-}}\n* %s\n==Ստուգաբանություն=="), ("pp1", "==Ստուգաբանություն==\n{{-hy-գո-}}\n* %s"), ("pp2", "==Ստուգաբանություն==\n{{-hy-գո-}}\n# %s"), ("pp3", "==Ստուգաբանություն==\n{{-hy-գո-}}\n# %s")]


@query(f"""WITH s AS (SELECT unnest(range(5)) AS nth) SELECT 'w' || o_orderkey AS title, nth, {_sql_list([s for s, _ in _AFTER])}[nth + 1] AS step,
  replace(CASE o_orderkey % 2 WHEN 0 THEN {_sql_list([t for _, t in _AFTER])}[nth + 1] ELSE {_sql_list(_TRACED)}[2] END, '%s', o_orderkey::VARCHAR) AS text FROM orders, s WHERE o_orderkey % 10 < 4""")
def page_trace(spark, d):
    """The texts of pages after each step, for the words that are asked for"""
    k = F.col("k")
    pages = _orders(spark, d).select(F.concat(F.lit("w"), k.cast("string")).alias("title"), F.replace(_pick(_TRACED, k), F.lit("%s"), k.cast("string")).alias("text"))
    asked = _orders(spark, d).where("k % 10 < 4").select(F.concat(F.lit("w"), k.cast("string")).alias("title"))
    return wikitext.traced(pages, asked)


# ---- tags

#: (part of speech, definition, tags of a Cyrillic word with case and number in one tag, apart, tags of any other word)
_FORMS = [
    ("NOUN", "nominative singular of x", ["NOMINATIVE_SINGULAR", "SINGULAR"], ["SINGULAR"], ["SINGULAR"]),
    ("NOUN", "genitive singular of x", ["NON_NOMINATIVE_SINGULAR", "SINGULAR"], ["NON_NOMINATIVE", "SINGULAR"], ["SINGULAR"]),
    ("NOUN", "dative plural of x", ["NON_NOMINATIVE_PLURAL", "PLURAL"], ["NON_NOMINATIVE", "PLURAL"], ["PLURAL"]),
    ("NOUN", "plural form of x", ["PLURAL"], ["PLURAL"], ["PLURAL"]),
    ("ADJ", "feminine singular of x", ["FEM", "SINGULAR"], ["FEM", "SINGULAR"], []),
    ("ADJ", "masculine short form of x", ["MASC", "SHORT_FORM"], ["MASC", "SHORT_FORM"], []),
    ("ADJ", "neuter form of x", ["NEUT"], ["NEUT"], []),
    ("ADJ", "common gender of x", ["COMMON_GENDER"], ["COMMON_GENDER"], []),
    ("ADJ", "comparative of x", ["COMPARATIVE"], ["COMPARATIVE"], []),
    ("ADV", "superlative degree of x", ["SUPERLATIVE"], ["SUPERLATIVE"], []),
    ("NOUN", "superlative of x", [], [], []),
    ("VERB", "present active participle of x", ["INFLECTED_FORM", "PARTICIPLE", "PRES_PART"], ["INFLECTED_FORM", "PARTICIPLE", "PRES_PART"], []),
    ("VERB", "past passive participle of x", ["INFLECTED_FORM", "PARTICIPLE", "PAST_PASS_PART"], ["INFLECTED_FORM", "PARTICIPLE", "PAST_PASS_PART"], []),
    ("VERB", "imperfective of x", ["IMPERFECTIVE", "PERFECTIVE"], ["IMPERFECTIVE", "PERFECTIVE"], []),
    ("VERB", "infinitive of x", ["INF", "INFINITIVE", "INFLECTED_FORM"], ["INF", "INFINITIVE", "INFLECTED_FORM"], ["INF"]),
    ("VERB", "future tense of x", ["FUTURE", "INFLECTED_FORM"], ["FUTURE", "INFLECTED_FORM"], []),
    ("VERB", "gerund of x", ["GERUND", "INFLECTED_FORM"], ["GERUND", "INFLECTED_FORM"], []),
]


def _forms(spark, d, combined: bool) -> DataFrame:
    k = F.col("k")
    definition = F.struct(*(F.lit(None).cast(t).alias(n) if n != "definition" else _pick([f[1] for f in _FORMS], k).alias(n) for n, t in (x.split(":", 1) for x in ("definition:string", "examples:array<string>", "parsedExamples:array<struct<example:string>>", "labels:array<string>", "gloss:string", "text:string"))))
    none = F.lit(None).cast("string")
    entry = F.struct(_pick([f[0].lower() for f in _FORMS], k).alias("partOfSpeech"), F.lit("Russian").alias("language"), none.alias("etymology_text"), none.alias("etymology"), none.alias("description"), none.alias("romanization"), F.array(definition).alias("definitions"))
    rows = _orders(spark, d).select(F.concat(_pick(["слово", "slovo"], F.floor(k / len(_FORMS))), k.cast("string")).alias("word"), k.alias("frequency"), F.array(entry).alias("entries"))
    return tagging.tag_words(tagging.by_part_of_speech(rows), combined_case=combined).select("word", "part_of_speech", "tags")


def _forms_sql(which: int) -> str:
    tags = lambda i: "[" + ", ".join(_sql_list(f[i]) + "::VARCHAR[]" for f in _FORMS) + f"][o_orderkey % {len(_FORMS)} + 1]"
    cyrillic = f"(o_orderkey // {len(_FORMS)}) % 2 = 0"
    return f"SELECT CASE WHEN {cyrillic} THEN 'слово' ELSE 'slovo' END || o_orderkey AS word, {_sql_pick([f[0] for f in _FORMS], 'o_orderkey')} AS part_of_speech, CASE WHEN {cyrillic} THEN {tags(which)} ELSE {tags(4)} END AS tags FROM orders"


@query(_forms_sql(2))
def cyrillic_tags(spark, d):
    """Forms of Cyrillic words, and of others, which have none of these tags"""
    return _forms(spark, d, True)


@query(_forms_sql(3))
def cyrillic_tags_apart(spark, d):
    """Case and number as tags of their own"""
    return _forms(spark, d, False)


_PAIRS = [("plural of <a href='#English'>x</a>", "a thing"), ("plural of <a href='#English'>x</a>", "first person of <a href='#english'>y</a>"), ("a thing", "another"), ("plural of <a href='#Latin'>x</a>", None)]


@query(f"SELECT o_orderkey AS word, {_sql_list(['MAYBE_DERIVATIVE', 'LIKELY_DERIVATIVE', None, None])}[o_orderkey % 4 + 1] AS derivative, o_orderkey % 5 = 0 AS transcluded FROM orders")
def derivative_coverage(spark, d):
    """Some or all definitions are forms of a word of their language; a definition that was transcluded"""
    k = F.col("k")
    define = lambda c: F.struct(c.alias("definition"), F.lit(None).cast("array<string>").alias("examples"), F.lit(None).cast("array<struct<example:string>>").alias("parsedExamples"), F.lit(None).cast("array<string>").alias("labels"), F.lit(None).cast("string").alias("gloss"), F.lit(None).cast("string").alias("text"))
    none, mark = F.lit(None).cast("string"), F.when(k % 5 == 0, "<i typeof='mw:Transclusion'></i>").otherwise("")
    definitions = F.array(define(F.concat(_pick([p[0] for p in _PAIRS], k), mark)), define(_pick([p[1] for p in _PAIRS], k)))
    entry = F.struct(F.lit("noun").alias("partOfSpeech"), F.lit("English").alias("language"), none.alias("etymology_text"), none.alias("etymology"), none.alias("description"), none.alias("romanization"), definitions.alias("definitions"))
    rows = _orders(spark, d).select(k.cast("string").alias("word"), k.alias("frequency"), F.array(entry).alias("entries"))
    tagged = tagging.tag_words(tagging.by_part_of_speech(rows))
    derivative = F.when(F.array_contains("tags", "MAYBE_DERIVATIVE"), "MAYBE_DERIVATIVE").when(F.array_contains("tags", "LIKELY_DERIVATIVE"), "LIKELY_DERIVATIVE")
    return tagged.select(F.col("word").cast("long").alias("word"), derivative.alias("derivative"), tagging.has_transclusion().alias("transcluded"))


@query("SELECT o_orderkey AS k, 'a <b>c</b> & d' AS definition_raw, 'a c & d' AS definition, 'e x ' || o_orderkey AS example, 'p < q' AS parsed, '<b>l</b>' AS label, '<i>e</i>' AS etymology, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS n FROM orders")
def structural_strip(spark, d):
    """definitions, examples and parsed examples without HTML; other fields, nulls and empty lists as they were"""
    k = F.col("k")
    raw = "a <b>c</b> &amp; d"
    definition = F.struct(F.lit(raw).alias("definition"), F.array(F.concat(F.lit("e <i>x</i>\n "), k.cast("string"), F.lit("<br>")), F.lit(None)).alias("examples"), F.array(F.struct(F.lit("p &lt; <u>q</u>").alias("example"))).alias("parsedExamples"), F.array(F.lit("<b>l</b>")).alias("labels"))
    entries = F.array(F.struct(F.lit("<i>e</i>").alias("etymology"), F.when(k % 3 == 0, F.array().cast("array<struct<definition:string,examples:array<string>,parsedExamples:array<struct<example:string>>,labels:array<string>>>")).otherwise(F.array(definition)).alias("definitions")), F.struct(F.lit("<i>e</i>").alias("etymology"), F.array(definition).alias("definitions")))
    e = tagging.strip_definitions(_orders(spark, d).select("k", F.lit(raw.replace("&amp;", "&")).alias("definition_raw"), entries.alias("entries")))
    one = F.col("entries")[1]["definitions"][0]
    return e.select("k", "definition_raw", one["definition"].alias("definition"), one["examples"][0].alias("example"), one["parsedExamples"][0]["example"].alias("parsed"), one["labels"][0].alias("label"), F.col("entries")[0]["etymology"].alias("etymology"), F.size(F.col("entries")[0]["definitions"]).alias("n"))


# ---- services, programs, streams


def _answer(title: str) -> live.Answer:
    """A service made up for the queries: a busy answer is one of status 503, which is tried again."""
    n = int(title[1:])
    return [(200, json.dumps({"en": [{"w": title}, None]})), (404, None), (503, None), (200, "[]"), (200, json.dumps({"de": []}))][n % 5]


def _ask(title: str) -> live.Answer:
    return live.fetch_dump(title, _answer, live.Backoff(2, 0.0, 0.0))


def _ask_cleanse(title: str) -> live.Answer:
    return live.fetch_cleanse(title, _answer, live.Backoff(2, 0.0, 0.0))


@query("SELECT 't' || k AS title, [200, 404, 0, 200, 200][k % 5 + 1] AS status, [200, 404, 503, 200, 200][k % 5 + 1] AS status_cleanse, CASE k % 5 WHEN 0 THEN 1 ELSE 0 END AS n_entries FROM (SELECT DISTINCT o_orderkey % 200 AS k FROM orders)")
def asked_snapshot(spark, d):
    """Titles asked by tasks, once each, by either tool's policy; the entries under a language"""
    titles = _orders(spark, d).select(F.concat(F.lit("t"), (F.col("k") % 200).cast("string")).alias("title"))
    one, other = live.snapshot(titles, _ask, per_second=100_000), live.snapshot(titles, _ask_cleanse)
    payload = F.from_json("payload", "map<string,array<struct<w:string>>>")
    rows = one.join(other.select("title", F.col("status").alias("status_cleanse")), "title")
    return rows.select("title", "status", "status_cleanse", F.coalesce(F.size(lookup.locale_entries(payload, "en")), F.lit(0)).alias("n_entries"))


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 20 = 7 THEN '' ELSE 'lemma w' || (o_orderkey % 20) || '|N' END AS analyses FROM orders")
def external_analyses(spark, d):
    """The distinct words stream through a program in each task; its lines for each are joined"""
    words = _orders(spark, d).select("k", F.when(F.col("k") % 20 == 7, "--version-x").otherwise(F.concat(F.lit("w"), (F.col("k") % 20).cast("string"))).alias("word"))
    program = ["sh", "-c", 'while read -r w; do case "$w" in w*) printf "lemma %s\\n\\n N \\n" "$w";; esac; echo .; done']
    return live.joined_analyses(live.analysed_lines(words, program, timeout=30, end=".")).select("k", "analyses")


@query("SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS batch, 'w' || o_orderkey || '!' AS line FROM orders")
def external_batches(spark, d):
    """A program that reads the words of a batch"""
    rows = readers.number_rows(_orders(spark, d), "k").select(F.floor(F.col("row_idx") / 500).alias("batch"), F.concat(F.lit("w"), F.col("k").cast("string")).alias("word"), "row_idx")
    return live.analysed_batches(rows, ["sed", "-n", "s/$/!/;/^w/p"])


@query(f"WITH {V.SQL_TAGGED} SELECT word, frequency, part_of_speech FROM tagged WHERE part_of_speech = 'NOUN' AND list_contains(tags, 'RARE')")
def stream_filter(spark, d):
    """Files that arrive in two lots, filtered as a stream that goes on where it stopped"""
    line = writers.ragged_line(*(F.col(c) for c in ("word", "frequency", "part_of_speech", "tags")))
    folder, out, state = (_folder(spark, name) for name in ("arriving", "filtered", "state"))
    rows = V.tagged(spark, d)
    for lot in (rows.where("frequency % 2 = 0"), rows.where("frequency % 2 = 1")):
        writers.write_lines(lot, line, folder, append=True)
        filters.start(filters.filtered(filters.tagged_stream(spark, folder), "NOUN & RARE"), out, state).awaitTermination()
    return spark.read.schema("word string, frequency long, part_of_speech string").json(out)


@query(f"WITH {V.SQL_LEX}, c AS (SELECT {_SQL_OUTCOME} AS outcome FROM lex) SELECT count(*) AS processed, count(*) FILTER (outcome = 'VALIDATED') AS validated, count(*) FILTER (outcome = 'REJECTED') AS rejected, count(*) FILTER (outcome = 'NONEXISTENT') AS nonexistent, count(*) FILTER (outcome = 'RETRY') AS retry FROM c")
def observed_outcomes(spark, d):
    """Counts that come with a write"""
    rows, seen = lookup.observed(_classified(spark, d))
    rows.write.format("noop").mode("overwrite").save()
    got = seen.get
    return spark.createDataFrame([tuple(got[c] for c in ("processed", "validated", "rejected", "nonexistent", "retry"))], "processed long, validated long, rejected long, nonexistent long, retry long")


@query("""WITH l AS (SELECT 'w' || (o_orderkey % 300) AS key, (o_orderkey * 7919) % 1000 AS n, o_orderkey AS k FROM orders),
  m AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, k) AS best, row_number() OVER (PARTITION BY key ORDER BY k) AS early FROM l)
  SELECT 'best' AS command, key || ' ' || n || ',' || k AS line FROM m WHERE best = 1 AND n >= 400 UNION ALL SELECT 'first', key || ',' || n || ',' || k FROM m WHERE early = 1""")
def command_files(spark, d):
    """Commands over files, one behind the other"""
    from lexspark.__main__ import main

    k = F.col("k")
    line = F.concat_ws(",", F.concat(F.lit("w"), (k % 300).cast("string")), (k * 7919 % 1000).cast("string"), k.cast("string"))
    source = _written(spark, _orders(spark, d), line, "lines", k)
    steps = [["sort_freq_dups", source, f"{source}-1"], ["freq", f"{source}-1", f"{source}-2", "400"], ["make_dictionary", f"{source}-2", f"{source}-best"], ["remove_dups", source, f"{source}-first"]]
    assert not any(main(step) for step in steps)
    out = [readers.indexed_lines(spark, f"{source}-{name}").select(F.lit(name).alias("command"), "line") for name in ("best", "first")]
    return out[0].unionByName(out[1])
