"""The library's registered queries and the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.functions import markup, tagexpr, tagging, wikitext
from lexspark.functions import text as T
from lexspark.operators import lexicon, lookup, morph
from lexspark.operators import relational as R
from lexspark.plans import views as V
from lexspark.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---- words, counts, filters


@query(f"WITH {V.SQL_TAGGED} SELECT word, frequency, part_of_speech FROM tagged WHERE part_of_speech = 'NOUN' AND NOT word LIKE '%e' ORDER BY frequency DESC, word LIMIT 1000")
def word_count_topn(spark, d):
    """Counted words under a tag expression, the thousand most frequent (a top-k report)."""
    rows = V.tagged(spark, d)
    tags = tagexpr.tag_set(F.col("part_of_speech"), F.col("tags"))
    kept = rows.where(tagexpr.compile_expression("NOUN & ![e$]", tags, F.col("word")))
    return R.top_n(kept.select("word", "frequency", "part_of_speech"), 1000, F.desc("frequency"), F.asc("word"))


@query(f"WITH {V.SQL_LEX} SELECT word, frequency FROM lex WHERE frequency >= 5")
def word_counts_min(spark, d):
    """A1 P3"""
    return V.lex(spark, d).where("frequency >= 5")


@query("SELECT word, count(*) AS count FROM (SELECT lower(unnest(regexp_extract_all(p_name, '[A-Za-z]+'))) AS word FROM part) GROUP BY word")
def word_counts_part(spark, d):
    """A1 over another table"""
    words = V.table(spark, d, "part").select(F.explode(F.regexp_extract_all("p_name", F.lit("([A-Za-z]+)"), F.lit(1))).alias("w"))
    return lexicon.word_counts(words.select(F.lower("w").alias("word")))


def _ngrams(spark, d):
    rows = V.tagged(spark, d)
    years = F.array(F.struct(F.lit(2018).alias("year"), (F.col("frequency") + 1).alias("term_frequency")), F.struct(F.lit(2019).alias("year"), F.col("frequency").alias("term_frequency")))
    return rows.select(F.concat_ws("_", "word", "part_of_speech").alias("term"), years.alias("years"))


@query(f"WITH {V.SQL_TAGGED} SELECT word || '_' || part_of_speech AS term, frequency AS term_frequency FROM tagged ORDER BY frequency DESC, term LIMIT 500")
def ngram_scan_topk(spark, d):
    """Exploded years, anchored patterns, top k"""
    return readers.ngram_top(_ngrams(spark, d), 2019, 500)


def _expression(name: str, expression: str, sql: str) -> None:
    def run(spark, d):
        rows = V.tagged(spark, d)
        tags = tagexpr.tag_set(F.col("part_of_speech"), F.col("tags"))
        return rows.where(tagexpr.compile_expression(expression, tags, F.col("word"))).select("word", "frequency", "part_of_speech")

    run.__name__ = name
    run.__doc__ = f"P1 Q1 A8: {expression or 'an empty expression'}"
    query(f"WITH {V.SQL_TAGGED} SELECT word, frequency, part_of_speech FROM tagged WHERE {sql}")(run)


_expression("tag_expr_and", "NOUN & RARE", "part_of_speech = 'NOUN' AND list_contains(tags, 'RARE')")
_expression("tag_expr_or", "VERB | PLURAL & SHORT", "part_of_speech = 'VERB' OR (list_contains(tags, 'PLURAL') AND list_contains(tags, 'SHORT'))")
_expression("tag_expr_not", "!RARE & !NO_SUCH_TAG", "NOT list_contains(tags, 'RARE')")
_expression("tag_expr_paren", "!(NOUN | ADJ) & (RARE | SHORT)", "part_of_speech NOT IN ('NOUN', 'ADJ') AND (list_contains(tags, 'RARE') OR list_contains(tags, 'SHORT'))")
_expression("tag_expr_regex", "[^th] & ![e.$] | [zz]", "(regexp_matches(word, '^th') AND NOT regexp_matches(word, 'e.$')) OR regexp_matches(word, 'zz')")
_expression("tag_expr_empty", "  ", "true")


# ---- candidate lists


def _candidate_lines(spark, d):
    o = V.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    value = F.when(F.col("o_orderkey") % 11 == 0, "x").otherwise(F.floor("o_totalprice").cast("string"))
    line = F.concat(F.when(F.col("o_orderkey") % 13 == 0, "  ").otherwise(""), F.when(F.col("o_orderkey") % 17 == 0, "Word").otherwise(F.concat(F.lit("w"), F.col("o_orderkey"), F.when(F.col("o_orderkey") % 3 == 0, "_NOUN").otherwise(""))), F.lit(", "), value, F.lit(",more,fields"))
    return o.select(line.alias("line"), F.col("o_orderkey").alias("row_idx"))


SQL_LINES = """lines AS (SELECT (CASE WHEN o_orderkey % 13 = 0 THEN '  ' ELSE '' END) || (CASE WHEN o_orderkey % 17 = 0 THEN 'Word' ELSE 'w' || o_orderkey || (CASE WHEN o_orderkey % 3 = 0 THEN '_NOUN' ELSE '' END) END)
  || ', ' || (CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END) || ',more,fields' AS line, o_orderkey AS row_idx FROM orders)"""


@query(f"WITH {SQL_LINES} SELECT split_part(trim(line), ',', 1) AS word, try_cast(trim(split_part(line, ',', 2)) AS BIGINT) AS frequency, row_idx FROM lines WHERE NOT lower(trim(line)) LIKE 'word,%' AND try_cast(trim(split_part(line, ',', 2)) AS BIGINT) IS NOT NULL")
def candidate_parse(spark, d):
    """S2 Q11"""
    return readers.dump_candidates(_candidate_lines(spark, d))


@query(f"""WITH {SQL_LINES}, p AS (SELECT regexp_replace(trim(split_part(trim(line), ',', 1)), '_[A-Z]{{2,6}}$', '') AS word, try_cast(trim(split_part(line, ',', 2)) AS BIGINT) AS frequency, trim(line) AS line, row_idx FROM lines),
  q AS (SELECT * FROM p WHERE frequency IS NOT NULL), s AS (SELECT min(row_idx) AS stop FROM q WHERE frequency < 3000)
  SELECT word, frequency, line, row_idx FROM q, s WHERE (stop IS NULL OR row_idx < stop) AND length(word) BETWEEN 2 AND 4""")
def candidate_parse_cleanse(spark, d):
    """S3 F5 P2 W4"""
    return readers.cleanse_candidates(_candidate_lines(spark, d), 3000, 2, 4)


@query("WITH s AS (SELECT min(o_orderkey) AS stop FROM orders WHERE o_totalprice < 1500) SELECT o_orderkey, o_totalprice FROM orders, s WHERE stop IS NULL OR o_orderkey < stop")
def prefix_stop_min_freq(spark, d):
    """W4"""
    return R.prefix_until(V.table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", F.col("o_totalprice") < 1500)


@query("SELECT o_orderkey, o_orderstatus FROM (SELECT *, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS done FROM orders) WHERE coalesce(done, 0) < 700")
def stop_after_m(spark, d):
    """Everything up to the 700th success"""
    return R.until_enough(V.table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", F.col("o_orderstatus") == "F", 700)


# ---- text functions

def _suffixed():
    return F.concat(F.col("word"), F.element_at(F.array(*map(F.lit, ("_NOUN", "_noun", "_XYZ", "_bar", "", "_ADJ"))), (F.col("frequency") % 6 + 1).cast("int")))

_SQL_SUFFIXED = "word || ['_NOUN', '_noun', '_XYZ', '_bar', '', '_ADJ'][frequency % 6 + 1]"


@query(f"WITH {V.SQL_LEX}, t AS (SELECT {_SQL_SUFFIXED} AS token FROM lex) SELECT token, regexp_replace(token, '(?i)_(NOUN|VERB|ADJ|ADV|PROPN|PRON|DET|ADP|CONJ|SCONJ|CCONJ|NUM|PART|INTJ|AUX)$', '') AS word FROM t")
def pos_suffix_strip(spark, d):
    """F4 Q5"""
    return V.lex(spark, d).select(_suffixed().alias("token")).select("token", T.strip_query_suffix(F.col("token")).alias("word"))


@query(f"WITH {V.SQL_LEX}, t AS (SELECT {_SQL_SUFFIXED} AS token FROM lex) SELECT token, regexp_replace(token, '_[A-Z]{{2,6}}$', '') AS word FROM t")
def pos_suffix_strip_cleanse(spark, d):
    """F5 Q5"""
    return V.lex(spark, d).select(_suffixed().alias("token")).select("token", T.normalize_term(F.col("token")).alias("word"))


@query("SELECT p_partkey, lower(p_name) AS low, upper(p_name[1]) || p_name[2:] AS upper_first, upper(p_name[1]) || lower(p_name[2:]) AS capital FROM part")
def case_variants(spark, d):
    """F7"""
    c = F.col("p_name")
    return V.table(spark, d, "part").select("p_partkey", F.lower(c).alias("low"), T.upper_first(c).alias("upper_first"), T.capitalize(c).alias("capital"))


@query("SELECT r_name, n_name, translate(upper(n_name), ' -', '__') AS tag FROM nation JOIN region ON n_regionkey = r_regionkey")
def lang_tag(spark, d):
    """F8"""
    n = V.table(spark, d, "nation").join(F.broadcast(V.table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select("r_name", "n_name", T.lang_tag(F.col("n_name")).alias("tag"))


# the only markup within a script of the tables' pages is that text, which a tokenizer leaves
_SQL_UNTAGGED = "regexp_replace(replace(html, 't=\"</p>\"', 't=\"' || chr(2) || '\"'), '(?s)<!--.*?-->|</?[a-zA-Z!][^>]*>', '', 'g')"
_SQL_ENTITIES = "replace(replace(replace(replace(replace(replace(replace(replace(html, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&')"


@query(f"SELECT page_id, regexp_replace({_SQL_ENTITIES}, '<[^>]+>', '', 'g') AS text FROM pages")
def strip_html_simple(spark, d):
    """F1"""
    return V.table(spark, d, "pages").select("page_id", T.strip_html(F.col("html")).alias("text"))


@query(rf"SELECT page_id, trim(regexp_replace(replace(replace({_SQL_ENTITIES.replace('html', _SQL_UNTAGGED)}, chr(2), '</p>'), chr(160), ' '), '\s+', ' ', 'g')) AS text FROM pages")
def strip_html_parser(spark, d):
    """F2 Q4: a tokenizer's text"""
    return V.table(spark, d, "pages").select("page_id", T.strip_html_parsed(F.col("html")).alias("text"))


def _wiki():
    return F.concat(F.lit("<!-- "), F.col("lang"), F.lit(" -->[["), F.col("source"), F.lit("|"), F.col("lang"), F.lit("]] '''"), F.col("text"), F.lit("'''{{t|x}}<ref name=a>r</ref> [[w]] [http://x.y z] և"))


@query(r"""WITH w AS (SELECT doc_id, '<!-- ' || lang || ' -->[[' || source || '|' || lang || ']] ''''''' || text || '''''''{{t|x}}<ref name=a>r</ref> [[w]] [http://x.y z] և' AS t FROM documents),
  a AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '(?s)<!--.*?-->', ' ', 'g'), '(?is)<ref[^>]*>.*?</ref>', ' ', 'g'), '<[^>]+>', ' ', 'g') AS t FROM w),
  b AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(?s)\{\{.*?\}\}', ' ', 'g'), '\[\[([^|\]]+)\|([^\]]+)\]\]', '\2', 'g'), '\[\[([^\]]+)\]\]', '\1', 'g'), '\[https?://[^\s\]]+(?:\s+([^\]]+))?\]', '\1', 'g') AS t FROM a)
  SELECT doc_id, replace(replace(replace(t, '''''''', ''), '''''', ''), 'և', 'եւ') AS text FROM b""")
def wikitext_cleanup(spark, d):
    """F11"""
    return R.spread(V.table(spark, d, "documents").select("doc_id", "text", "lang", "source")).select("doc_id", markup.clean_wikitext(_wiki()).alias("text"))


@query(r"SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t\r\n\f\x0b!\"#$%&''()*+,\-./:;<=>?@\[\]^_`{|}~]+'), lambda w: w <> '') AS words FROM documents")
def tokenize_words(spark, d):
    """F15"""
    return V.table(spark, d, "documents").select("doc_id", T.tokenize_words(F.col("text")).alias("words"))


@query(f"WITH {V.SQL_LEX} SELECT word, CASE WHEN frequency % 2 = 0 AND length(CAST(frequency AS VARCHAR)) < 5 THEN CAST(rpad(CAST(frequency AS VARCHAR), 5, '0') AS BIGINT) ELSE frequency END AS count FROM lex")
def apply_boost(spark, d):
    """F28"""
    return V.lex(spark, d).select("word", T.apply_boost(F.col("frequency"), F.col("frequency") % 2 == 0).alias("count"))


@query(f"WITH {V.SQL_TAGGED} SELECT word || ' ' || frequency || ',' || part_of_speech AS line FROM tagged")
def make_dictionary_line(spark, d):
    """F30"""
    rows = V.tagged(spark, d)
    return rows.select(T.make_dictionary_line(F.concat_ws(",", "word", F.col("frequency").cast("string"), "part_of_speech")).alias("line"))


@query(f"WITH {V.SQL_LEX} SELECT word, CASE frequency % 4 WHEN 0 THEN frequency WHEN 1 THEN 0 WHEN 2 THEN 0 ELSE 12 END AS count, CASE frequency % 4 WHEN 2 THEN '' ELSE word END AS back FROM lex")
def parse_dictionary_line(spark, d):
    """lines with a count, without a number, without a blank, and with an odd number"""
    n = F.col("frequency")
    rest = F.when(n % 4 == 0, F.concat(F.lit(" "), n.cast("string"), F.lit(",TAG,a, b"))).when(n % 4 == 1, " x,TAG").when(n % 4 == 2, ",5").otherwise("  1_2 ,T 7")
    line = F.concat(F.col("word"), rest)
    return V.lex(spark, d).select("word", T.line_count(line).alias("count"), T.line_word(line).alias("back"))


# ---- relational tools


def _lines_of(spark, d):
    return V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1")
def dedupe_first(spark, d):
    """W2 U4"""
    return R.dedupe_first(_lines_of(spark, d), "l_suppkey", ["l_orderkey", "l_linenumber"])


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS n FROM lineitem WHERE l_quantity > 25) WHERE n = 1")
def dedupe_first_eligible(spark, d):
    """W1"""
    return R.dedupe_first(_lines_of(spark, d), "l_suppkey", ["l_orderkey", "l_linenumber"], F.col("l_quantity") > 25)


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1")
def max_freq_per_word(spark, d):
    """A7 Q17"""
    return R.max_per_key(_lines_of(spark, d), "l_suppkey", "l_quantity", ["l_orderkey", "l_linenumber"])


@query(f"WITH {V.SQL_LEX} SELECT word, frequency FROM lex ORDER BY frequency DESC, word")
def sort_freq(spark, d):
    """R1 R4"""
    return R.top_n(V.lex(spark, d), 0, F.desc("frequency"), F.asc("word"))


@query(f"WITH {V.SQL_LEX} SELECT word, frequency, CASE WHEN frequency >= 10 THEN 'more' ELSE 'less' END AS side FROM lex")
def threshold_split(spark, d):
    """P12"""
    more, less = R.threshold_split(V.lex(spark, d), "frequency", 10)
    return more.withColumn("side", F.lit("more")).unionByName(less.withColumn("side", F.lit("less")))


@query(f"WITH {V.SQL_LEX}, s AS (SELECT CASE WHEN word LIKE '%ing' THEN 'ing' WHEN word LIKE '%er' THEN 'er' WHEN word LIKE '%s' THEN 's' END AS suffix FROM lex) SELECT coalesce(suffix, '') AS suffix, count(*) AS words FROM s GROUP BY 1")
def suffix_split(spark, d):
    """P13 A10"""
    rows = V.lex(spark, d).withColumn("suffix", F.coalesce(R.first_suffix(F.col("word"), ["ing", "er", "s"]), F.lit("")))
    return rows.groupBy("suffix").agg(F.count(F.lit(1)).alias("words"))


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END AS source_ord FROM documents")
def union_sources(spark, d):
    """U3"""
    docs = V.table(spark, d, "documents").select("doc_id", "lang")
    rest = docs.where("lang is null or lang not in ('en', 'de')")
    return R.chained(docs.where("lang = 'en'"), docs.where("lang = 'de'"), rest).select("doc_id", "source_ord")


@query("""WITH r AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders), b AS (SELECT CAST(floor((i - 50) / 100.0) AS BIGINT) AS batch, i FROM r WHERE i >= 50),
  g AS (SELECT batch, min(i) AS words_start, max(i) AS words_end, count(*) AS words FROM b GROUP BY batch) SELECT *, CAST(sum(words) OVER (ORDER BY batch) AS BIGINT) AS total_processed FROM g""")
def batch_plan(spark, d):
    """S23 W8"""
    rows = readers.number_rows(V.table(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    return R.batch_plan(rows, "row_idx", 100, 50)


@query("WITH a AS (SELECT o_custkey % 50 AS x FROM orders WHERE o_orderkey % 2 = 0), b AS (SELECT o_custkey % 50 AS x FROM orders WHERE o_orderkey % 2 = 1) SELECT NOT EXISTS ((SELECT x FROM a EXCEPT ALL SELECT x FROM b) UNION ALL (SELECT x FROM b EXCEPT ALL SELECT x FROM a)) AS halves, NOT EXISTS ((SELECT DISTINCT x FROM a EXCEPT SELECT x FROM b) UNION ALL (SELECT DISTINCT x FROM b EXCEPT SELECT x FROM a)) AS kinds, count(*) = 2 * count(*) AS twice FROM a")
def set_equality(spark, d):
    """Two halves of a table as bags, their distinct values, and one half with itself twice"""
    o = V.table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 50).alias("x"))
    a, b = o.where("o_orderkey % 2 = 0").select("x"), o.where("o_orderkey % 2 = 1").select("x")
    return spark.createDataFrame([(R.same_rows(a, b), R.same_rows(a.distinct(), b.distinct().repartition(3)), R.same_rows(a, a.unionByName(a)))], "halves boolean, kinds boolean, twice boolean")


# ---- lexicon


def _ascii_capital(c):
    """The first letter in upper case if it is one of a-z; engines differ on letters without a single capital."""
    return F.concat(F.translate(F.left(c, F.lit(1)), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substr(c, F.lit(2)))


def _tagged_rows(spark, d):
    rows = V.tagged(spark, d)
    upper = F.when(F.col("frequency") % 2 == 0, _ascii_capital(F.col("word"))).otherwise(F.col("word"))
    main = rows.select(F.concat(F.lit(" "), upper).alias("word"), F.col("part_of_speech").alias("tag"), F.concat(F.lit("d "), F.col("word")).alias("definition"), F.crc32("word").alias("row_idx"))
    return R.chained(main, main.withColumn("definition", F.lit("more")))


SQL_COMBINE = V.SQL_TAGGED + """, main AS (SELECT CASE WHEN frequency % 2 = 0 THEN translate(word[1], 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') || word[2:] ELSE word END AS raw, word, part_of_speech AS tag, 'd ' || word AS definition, frequency FROM tagged),
  kept AS (SELECT * FROM main WHERE tag IN ('NOUN', 'ADJ')),
  combined AS (SELECT word, CASE WHEN word LIKE 'the%' AND n < 10000 THEN CAST(rpad(CAST(n AS VARCHAR), 5, '0') AS BIGINT) ELSE n END AS count, tag, definition FROM (SELECT *, CASE WHEN raw = word THEN frequency + 1 ELSE 1 END AS n FROM kept))"""


def _combined(spark, d):
    counts = V.lex(spark, d).select("word", F.col("frequency").cast("string").alias("count"), F.crc32("word").alias("row_idx"))
    boosted = V.lex(spark, d).where("word like 'the%'").select(F.upper("word").alias("word"))
    return lexicon.combine(_tagged_rows(spark, d), counts, {"NOUN": 12, "ADJ": 11, "VERB": 3}, 11, boosted)


@query(f"WITH {SQL_COMBINE} SELECT * FROM combined")
def combine_lexicon(spark, d):
    """J1 J2 J3 W1 F28 P4 P5 U3 S8 Q19"""
    return _combined(spark, d)


@query(f"WITH {SQL_COMBINE} SELECT length(word) AS len, count, word || ' ' || count || ',' || tag || ',' || definition AS line FROM combined WHERE count >= 2")
def dictionary_buckets(spark, d):
    """A5"""
    return lexicon.dictionary_lines(_combined(spark, d), 2)


@query(f"WITH {SQL_COMBINE} SELECT length(word) AS len, count(*) AS words, min(count) AS least, max(count) AS most FROM combined GROUP BY 1")
def bucket_summary(spark, d):
    """A5 A6"""
    return lexicon.bucket_summary(_combined(spark, d))


@query(f"""WITH {SQL_COMBINE}, l AS (SELECT word, count, word || ' ' || count || ',' || tag || ',' || definition AS line, row_number() OVER (ORDER BY count DESC, word) - 1 AS i, count(*) OVER () AS n FROM combined WHERE length(word) = 6),
  s AS (SELECT * FROM l WHERE i >= floor(n * 10 / 100.0) AND i < floor(n * 10 / 100.0) + floor(n * 25 / 100.0)) SELECT line FROM s WHERE NOT word LIKE '%s'""")
def answers_slice(spark, d):
    """W3 J4 A6 Q18"""
    combined = _combined(spark, d)
    lines = lexicon.dictionary_lines(combined).where("len = 6")
    ignored = V.lex(spark, d).where("word like '%s'").select("word")
    return lexicon.answers(lines, [F.desc("count"), "line"], 10, 25, ignored).select("line")


def _leipzig():
    return F.concat_ws(" ", F.col("row_idx").cast("string"), _ascii_capital(F.col("word")), F.col("frequency").cast("string"))


@query(f"WITH {V.SQL_LEX} SELECT word, word || ',' || frequency AS line FROM lex WHERE length(word) > 4 AND length(word) <= 6")
def leipzig_clean(spark, d):
    """S19 F31 P8 W2"""
    rows = V.lex(spark, d).withColumn("row_idx", F.crc32("word"))
    return lexicon.leipzig_rows(rows.select(_leipzig().alias("line"), "row_idx"), "row_idx", 4, 6).select("word", "line")


# ---- lookups


def _probes(spark, d):
    """(word, token, statuses and entries of two probes) with every mixture of answers."""
    k, status = F.col("o_orderkey"), F.array(*map(F.lit, (200, 404, 429, 200, 500)))
    at = lambda e: status[(e % 5).cast("int")]
    entries = lambda e: F.when(e % 3 == 0, F.array(F.lit("a"), F.lit("b"))).when(e % 3 == 1, F.array().cast("array<string>"))
    return V.table(spark, d, "orders").select(k, at(k).alias("s1"), at(F.floor(k / 5)).alias("s2"), entries(F.floor(k / 7)).alias("e1"), entries(F.floor(k / 11)).alias("e2"))


SQL_PROBES = """p AS (SELECT o_orderkey, [200, 404, 429, 200, 500][o_orderkey % 5 + 1] AS s1, [200, 404, 429, 200, 500][(o_orderkey // 5) % 5 + 1] AS s2, (o_orderkey // 7) % 3 AS k1, (o_orderkey // 11) % 3 AS k2 FROM orders),
  q AS (SELECT *, NOT (s1 = 200 AND k1 < 2) AND s1 <> 404 AS t1, NOT (s2 = 200 AND k2 < 2) AND s2 <> 404 AS t2, s1 = 200 AND k1 = 0 AS f1, s2 = 200 AND k2 = 0 AS f2 FROM p)"""


@query(f"WITH {SQL_PROBES} SELECT o_orderkey, CASE WHEN t1 THEN 'RETRY' WHEN s1 = 404 THEN 'NONEXISTENT' WHEN f1 THEN 'VALIDATED' ELSE 'REJECTED' END AS outcome FROM q")
def outcome_plain(spark, d):
    """C1"""
    return _probes(spark, d).select("o_orderkey", lookup.outcome_plain(F.col("s1"), F.col("e1")).alias("outcome"))


@query(f"WITH {SQL_PROBES} SELECT o_orderkey, CASE WHEN t1 OR t2 THEN 'RETRY' WHEN s1 = 404 AND s2 = 404 THEN 'NONEXISTENT' WHEN f1 OR f2 THEN 'VALIDATED' ELSE 'REJECTED' END AS outcome, CASE WHEN t1 OR t2 THEN 0 ELSE (CASE WHEN f1 THEN 2 ELSE 0 END) + (CASE WHEN f2 THEN 2 ELSE 0 END) END AS n_entries FROM q")
def outcome_cap(spark, d):
    """C2 Q7"""
    four = [F.col(c) for c in ("s1", "e1", "s2", "e2")]
    outcome = lookup.outcome_cap(*four)
    n = F.when(outcome == "VALIDATED", F.size(lookup.entries_cap(*four))).otherwise(0)
    return _probes(spark, d).select("o_orderkey", outcome.alias("outcome"), n.alias("n_entries"))


@query(f"""WITH {SQL_PROBES}, r AS (SELECT o_orderkey, CASE WHEN s1 = 500 AND o_orderkey % 2 = 0 THEN -1 ELSE s1 END AS s1, s2, k1, k2 FROM p)
  SELECT o_orderkey, CASE WHEN s1 = -1 THEN 'REJECTED' WHEN (s1 = 200 AND k1 = 0) OR (s2 = 200 AND k2 = 0) THEN 'VALIDATED' WHEN (s1 = 200 AND k1 = 1) OR (s2 = 200 AND k2 = 1) THEN 'REJECTED' WHEN s1 = 404 AND s2 = 404 THEN 'NONEXISTENT' ELSE 'HARD' END AS outcome,
  CASE WHEN s1 = -1 THEN 'exception' WHEN (s1 = 200 AND k1 = 0) OR (s2 = 200 AND k2 = 0) THEN NULL WHEN (s1 = 200 AND k1 = 1) OR (s2 = 200 AND k2 = 1) THEN 'wrong_locale' WHEN s1 = 404 AND s2 = 404 THEN NULL WHEN s1 = 429 OR s2 = 429 THEN 'rate_limited' WHEN s1 = 500 OR s2 = 500 THEN 'http_500' ELSE 'unknown_error' END AS reason FROM r""")
def outcome_cleanse(spark, d):
    """C3"""
    rows = _probes(spark, d).withColumn("s1", F.when((F.col("s1") == 500) & (F.col("o_orderkey") % 2 == 0), -1).otherwise(F.col("s1")))
    sizes = F.array(*[F.when(F.col(e).isNotNull(), F.size(e)) for e in ("e1", "e2")])
    return rows.withColumn("r", lookup.outcome_cleanse(F.array("s1", "s2"), sizes)).select("o_orderkey", "r.outcome", "r.reason")


def _snapshot(spark, d):
    """Definitions of the words of lex: what a service might have answered, by frequency."""
    rows = V.lex(spark, d)
    status = F.element_at(F.array(*map(F.lit, (200, 404, 200, 429, 200))), (F.col("frequency") % 5 + 1).cast("int"))
    entries = F.when(F.col("frequency") % 2 == 0, F.array("word")).otherwise(F.array().cast("array<string>"))
    return rows.select(F.col("word").alias("title"), status.alias("status"), F.when(status == 200, entries).alias("entries"))


@query(f"""WITH {V.SQL_LEX}, s AS (SELECT *, [200, 404, 200, 429, 200][frequency % 5 + 1] AS status FROM lex)
  SELECT CASE WHEN status = 404 THEN 'NONEXISTENT' WHEN status <> 200 THEN 'RETRY' WHEN frequency % 2 = 0 THEN 'VALIDATED' ELSE 'REJECTED' END AS outcome, count(*) AS words FROM s GROUP BY 1""")
def lookup_counts(spark, d):
    """J9 S4 C1 A9 F4"""
    words = V.lex(spark, d).select(F.concat(F.col("word"), F.lit("_NOUN")).alias("token"), "frequency")
    return lookup.outcome_counts(lookup.classify(words, _snapshot(spark, d)))


@query("SELECT o_orderkey AS word, CASE WHEN o_orderkey % 7 = 0 THEN 'NONEXISTENT' WHEN o_orderkey % 4 < 2 THEN 'VALIDATED' ELSE 'RETRY' END AS outcome FROM orders")
def retry_fixpoint(spark, d):
    """Words answer in the round that their key names; the second round's missing words are the first's"""
    words = V.table(spark, d, "orders").select(F.col("o_orderkey").alias("word"))
    attempt = lambda w, n: w.withColumn("outcome", F.when(F.col("word") % 7 == 0, "NONEXISTENT").when(F.col("word") % 4 < n, "VALIDATED").otherwise("RETRY"))
    return lookup.retry_stream(words, attempt, f"{R.shared_folder(spark)}/retry-{uuid.uuid4().hex}").select("word", "outcome")


# ---- tags

_PHRASES = ("plural of x", "singular form of y", "past participle of z", "borrowed from Old French", "cognate with Greek", "an archaic word", "compound of a and b", "<i>foreign</i> term", "imperfective of q", "third-person singular form of v", "prefixed with un-", "form of <a href=\"#english\">w</a>", "named after A &amp; B", "genitive plural of k")
_TAG_SQL = [("PLURAL", "pos = 'NOUN' AND (contains(t, 'plural of') OR contains(t, 'plural form of'))"), ("SINGULAR", "pos = 'NOUN' AND NOT (contains(t, 'plural of') OR contains(t, 'plural form of')) AND (contains(t, 'singular of') OR contains(t, 'singular form of'))")]
# the words are written out here as well, so that a fault in the tables of the rules shows
_SQL_VERBS = [(["past participle"], "PAST_PART INFLECTED_FORM"), (["present participle"], "PRES_PART INFLECTED_FORM"), (["past tense", "preterite"], "PAST INFLECTED_FORM"), (["imperative"], "IMP INFLECTED_FORM"), (["third-person singular", "3rd-person singular", "3rd person singular"], "3PS INFLECTED_FORM"), (["subjunctive"], "SUBJ INFLECTED_FORM"), (["infinitive"], "INF"), (["form of", "inflection of", "conjugation of", "conjugated form of"], "FORM_OF INFLECTED_FORM")]
_SQL_LANGUAGES = ["latin", "greek", "french", "old french", "middle french", "german", "old english", "anglo-norman", "spanish", "italian", "portuguese", "arabic", "hebrew", "aramaic", "persian", "sanskrit", "russian", "ukrainian", "polish", "czech", "dutch", "swedish", "norwegian", "danish", "japanese", "chinese", "korean"]
_TAG_SQL += [(tag, "pos = 'VERB' AND (" + " OR ".join(f"contains(t, '{n}')" for n in needles) + ")") for needles, tags in _SQL_VERBS for tag in tags.split()]
_TAG_SQL += [("LOANWORD", "contains(t, 'borrowed from') OR contains(t, 'loanword from')"), ("EPONYM", "contains(t, 'named after') OR contains(t, 'eponym')")]
for _l in _SQL_LANGUAGES:
    _n = _l.upper().replace(" ", "_").replace("-", "_")
    _TAG_SQL += [(f"FROM_{_n}", f"contains(t, 'from {_l}')"), (f"VIA_{_n}", f"contains(t, 'via {_l}')"), (f"COGNATE_{_n}", f"contains(t, 'cognate with {_l}') OR contains(t, 'cognate to {_l}')")]
_TAG_SQL += [(r.upper(), f"contains(t, '{r}')") for r in ("archaic", "obsolete", "slang", "informal", "rare", "offensive", "dialectal", "poetic")]
_TAG_SQL += [("COMPOUND", "contains(t, 'compound of')"), ("PREFIXED", "contains(t, 'prefix')"), ("SUFFIXED", "contains(t, 'suffix')"), ("FOREIGN_TERM", "contains(raw, '<i>') OR contains(raw, '</i>')"), ("TRANSLITERATED", "k % 9 = 0"), ("HAS_EXAMPLE", "k % 4 = 0")]
_TAG_SQL += [("LIKELY_DERIVATIVE", "contains(raw, '#english') AND regexp_matches(t, '\\bform of ')")]


def _entry_rows(spark, d):
    """(k, word, frequency, entries): an entry for each order, with a definition that its key names."""
    k = F.col("o_orderkey")
    raw = F.element_at(F.array(*map(F.lit, _PHRASES)), (k % len(_PHRASES) + 1).cast("int"))
    examples = F.when(k % 4 == 0, F.array(F.lit("e"))).otherwise(F.array().cast("array<string>"))
    definition = F.struct(raw.alias("definition"), examples.alias("examples"), F.lit(None).cast("array<struct<example:string>>").alias("parsedExamples"), F.lit(None).cast("array<string>").alias("labels"), F.lit(None).cast("string").alias("gloss"), F.lit(None).cast("string").alias("text"))
    none = F.lit(None).cast("string")
    pos = F.element_at(F.array(F.lit("noun"), F.lit("Verb"), F.lit(None).cast("string")), (F.floor(k / 3) % 3 + 1).cast("int"))
    entry = F.struct(pos.alias("partOfSpeech"), F.lit("English").alias("language"), none.alias("etymology_text"), none.alias("etymology"), none.alias("description"), F.when(k % 9 == 0, "r").alias("romanization"), F.array(definition).alias("definitions"))
    return R.spread(V.table(spark, d, "orders").select("o_orderkey"), R.CHUNK).select(k.alias("k"), F.concat(F.lit("w"), k.cast("string")).alias("word"), k.alias("frequency"), F.array(entry).alias("entries"))


_SQL_RAW = "['" + "', '".join(p.replace("'", "''") for p in _PHRASES) + f"'][o_orderkey % {len(_PHRASES)} + 1]"
SQL_ENTRIES = f"""e AS (SELECT o_orderkey AS k, 'w' || o_orderkey AS word, o_orderkey AS frequency, {_SQL_RAW} AS raw, ['NOUN', 'VERB', 'UNKNOWN'][(o_orderkey // 3) % 3 + 1] AS pos FROM orders),
  f AS (SELECT *, lower(regexp_replace(replace(raw, '&amp;', '&'), '<[^>]+>', '', 'g')) AS t FROM e)"""


@query(f"WITH {SQL_ENTRIES} SELECT word, frequency, pos AS part_of_speech, list_sort(list_distinct(list_filter([{', '.join(f'CASE WHEN {c} THEN {chr(39)}{t}{chr(39)} END' for t, c in _TAG_SQL)}], lambda x: x IS NOT NULL))) AS tags FROM f")
def tag_inference(spark, d):
    """A2 A3 A4 A8 R6 G1-G9"""
    return tagging.tag_words(tagging.by_part_of_speech(_entry_rows(spark, d))).select("word", "frequency", "part_of_speech", "tags")


_CLEANSE_SQL = [("HAS_EXAMPLE", "k % 4 = 0"), ("LIKELY_DERIVATIVE", "contains(raw, '#english') AND regexp_matches(t, '\\bform of ')")]
_SQL_PLURALS = " OR ".join(f"contains(t, '{n}')" for n in ("plural of", "plural form of", "plurals of", "pluriel de", "plural von", "plural de", "forma plural"))
_SQL_CLEANSE_VERBS = [(["past participle", "participe passé", "partizip ii"], "PAST_PART INFLECTED_FORM"), (["present participle", "gerund", "participe présent", "partizip i"], "PRES_PART INFLECTED_FORM"), (["past tense", "preterite", "prétérit", "imparfait"], "PAST INFLECTED_FORM"), (["third-person singular", "3rd-person singular", "3rd person singular"], "3PS INFLECTED_FORM"), (["imperative"], "IMP INFLECTED_FORM"), (["infinitive"], "INF"), (["subjunctive"], "SUBJ INFLECTED_FORM"), (["form of", "inflection of", "conjugation of", "conjugated form of"], "FORM_OF INFLECTED_FORM")]
_CLEANSE_SQL += [("PLURAL", f"pos = 'NOUN' AND ({_SQL_PLURALS})"), ("SINGULAR", f"pos = 'NOUN' AND NOT ({_SQL_PLURALS})")]
_CLEANSE_SQL += [(tag, "pos = 'VERB' AND (" + " OR ".join(f"contains(t, '{n}')" for n in needles) + ")") for needles, tags in _SQL_CLEANSE_VERBS for tag in tags.split()]


@query(f"WITH {SQL_ENTRIES} SELECT word, CASE WHEN pos = 'UNKNOWN' THEN [] ELSE [pos] END AS positions, list_sort(list_distinct(list_filter([{', '.join(f'CASE WHEN {c} THEN {chr(39)}{t}{chr(39)} END' for t, c in _CLEANSE_SQL)}], lambda x: x IS NOT NULL))) AS tags FROM f")
def tags_cleanse(spark, d):
    """G14 F34"""
    return tagging.cleanse_tags(_entry_rows(spark, d)).select("word", "positions", "tags")


# ---- pages, morphology, Hebrew

_PAGE = "== Հայերեն ==\n=== Գոյական ===\n# {{t|x}} [[տուն|տան]] մաս %s,\n# երկրորդ\n{{-hy-բաց-}}\n# բաց %s\n== Վերջ ==\n"


def _pages(spark, d):
    """(title, text): a dictionary page for each order, of several kinds."""
    k = F.col("o_orderkey")
    title = F.concat(F.translate((k + 10000).cast("string"), "0123456789", "աբգդեզէըթժ"), F.when(k % 10 == 9, "x").otherwise(""))
    text = F.when(k % 10 == 0, "#redirect [[x]]").when(k % 10 == 1, "no sections").when(k % 10 == 2, "{{-hy-ածխ-}}\n# x").when(k % 10 == 3, "{{-hy-գո-}}\n# {{only}}").when(k % 10 == 4, F.lit(None).cast("string"))
    full = F.replace(F.lit(_PAGE), F.lit("%s"), k.cast("string"))
    return R.spread(V.table(spark, d, "orders").select("o_orderkey"), R.CHUNK).select(title.alias("title"), F.coalesce(text, F.when(k % 10 != 4, full)).alias("text"))


_SQL_TITLE = "translate(CAST(o_orderkey + 10000 AS VARCHAR), '0123456789', 'աբգդեզէըթժ')"


@query(f"""WITH p AS (SELECT {_SQL_TITLE} || (CASE WHEN o_orderkey % 10 = 9 THEN 'x' ELSE '' END) AS title, o_orderkey % 10 AS m FROM orders)
  SELECT title, CASE WHEN m = 9 THEN 'other' WHEN m < 5 THEN 'filtered' ELSE 'extracted' END AS outcome, CASE m WHEN 2 THEN '-hy-ածխ-' WHEN 3 THEN 'NOUN' ELSE '' END AS tag, CASE m WHEN 9 THEN 'not Armenian' WHEN 0 THEN 'REDIRECT' WHEN 1 THEN 'no tag' WHEN 2 THEN '-hy-ածխ-' WHEN 3 THEN 'no desc' WHEN 4 THEN 'no tag' ELSE 'extracted' END AS reason FROM p""")
def page_classify(spark, d):
    """C4 P6 P7 F9 F10 F17 F20 F22-F25 F27 J6 J8"""
    return wikitext.classify_pages(_pages(spark, d)).select("title", "outcome", "tag", "reason")


@query(f"WITH p AS (SELECT {_SQL_TITLE} AS word, o_orderkey AS k FROM orders WHERE o_orderkey % 10 BETWEEN 5 AND 8) SELECT word, 'NOUN' AS tag, 'տան մաս ' || k AS definition FROM p")
def wiki_extract_single(spark, d):
    """The section of the largest weight, phrases merged into it"""
    return wikitext.extracted(wikitext.classify_pages(_pages(spark, d)), single=True).select("word", "tag", "definition")


@query("SELECT CAST(count(*) FILTER (o_orderkey % 10 BETWEEN 5 AND 8) AS BIGINT) AS extracted, count(*) FILTER (o_orderkey % 10 < 5) AS filtered, count(*) FILTER (o_orderkey % 10 = 9) AS not_armenian, count(*) FILTER (o_orderkey % 10 = 0) AS redirects FROM orders")
def page_counters(spark, d):
    """A11"""
    return wikitext.page_counters(wikitext.classify_pages(_pages(spark, d)))


def _conll_lines(spark, d):
    k = F.col("row_idx")
    rows = readers.number_rows(V.table(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    line = F.when(k % 7 == 3, "").when(k % 7 == 4, " ").otherwise(F.concat_ws("\t", k.cast("string"), F.concat(F.lit("f"), k), F.lit("l"), F.concat(F.lit("p"), k % 50), F.element_at(F.array(*map(F.lit, ("NN", "XX", "VB"))), (k % 3 + 1).cast("int"))))
    return rows.select(line.alias("line"), "row_idx")


SQL_CONLL = "r AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders), t AS (SELECT i AS row_idx, i // 7 + (CASE WHEN i % 7 > 4 THEN 1 ELSE 0 END) AS sentence_id, CAST(i AS VARCHAR) AS id, 'f' || i AS form, 'l' AS lemma, 'p' || (i % 50) AS \"POS\", ['NN', 'XX', 'VB'][i % 3 + 1] AS features FROM r WHERE i > 0 AND i % 7 NOT IN (3, 4))"


@query(f"WITH {SQL_CONLL} SELECT * FROM t")
def conll_tokens(spark, d):
    """S20 W7 Q15"""
    return morph.conll_tokens(_conll_lines(spark, d))


@query(f"WITH {SQL_CONLL} SELECT sentence_id, count(*) AS n, string_agg(form, ' ' ORDER BY row_idx) AS forms FROM t GROUP BY sentence_id")
def conll_sentences(spark, d):
    """A12"""
    rows = morph.sentences(morph.conll_tokens(_conll_lines(spark, d)))
    return rows.select("sentence_id", F.size("tokens").cast("long").alias("n"), F.array_join(F.transform("tokens", lambda t: t["form"]), " ").alias("forms"))


@query(f"WITH {SQL_CONLL} SELECT DISTINCT \"POS\" AS word FROM t WHERE features IN ('NN', 'JJ', 'VB', 'BN')")
def morph_extract(spark, d):
    """P11 R5"""
    return morph.morph_words(morph.conll_tokens(_conll_lines(spark, d)))


@query("SELECT o_orderkey, ['M', 'F', ''][o_orderkey % 3 + 1] AS gender, CASE WHEN o_orderkey % 2 = 0 THEN 'S' ELSE '' END AS number, CASE WHEN o_orderkey % 3 < 2 THEN '3' ELSE '' END AS person, CASE WHEN o_orderkey % 5 = 0 THEN 'PAST' ELSE '' END AS tense FROM orders")
def morph_csv(spark, d):
    """F33 Q16"""
    k = F.col("o_orderkey")
    features = F.concat_ws("|", F.when(k % 3 < 2, F.concat(F.lit("gen="), F.element_at(F.array(F.lit("M"), F.lit("F")), (k % 3 + 1).cast("int")), F.lit("|per=3"))), F.when(k % 2 == 0, "num=S"), F.when(k % 5 == 0, "tense=PAST"))
    return V.table(spark, d, "orders").select("o_orderkey", *morph.feature_columns(features))


@query("SELECT 'שלום' || chr(1488 + CAST(o_orderkey % 27 AS INTEGER)) AS word FROM orders WHERE o_orderkey % 4 < 2")
def hebrew_length(spark, d):
    """S24 F32 P9 Q26"""
    k = F.col("o_orderkey")
    letters = F.element_at(F.split(F.lit("".join(chr(1488 + i) for i in range(27))), ""), (k % 27 + 1).cast("int"))
    line = F.concat(F.lit(" שָׁלוֹם"), F.when(k % 4 == 0, letters).when(k % 4 == 1, F.concat(letters, F.lit("ְ "))).when(k % 4 == 2, "x").otherwise(""))
    return morph.hebrew_words(V.table(spark, d, "orders").select(line.alias("line")), 5)


@query(f"WITH {V.SQL_TAGGED} SELECT word, frequency, part_of_speech, tags FROM tagged")
def tagged_round_trip(spark, d):
    """Ragged lines written and read again"""
    line = writers.ragged_line(F.col("word"), F.col("frequency"), F.col("part_of_speech"), F.col("tags"))
    lines = V.tagged(spark, d).select(line.alias("line"), F.lit(1).alias("row_idx"))
    return readers.tagged_rows(lines, header=False).drop("row_idx")


@query(f"WITH {V.SQL_LEX} SELECT word, frequency, 1 AS n_entries, 'noun' AS pos FROM lex")
def json_round_trip(spark, d):
    """Validated records as JSON lines and back"""
    entry = F.struct(F.lit("noun").alias("partOfSpeech"), F.array(F.struct(F.lit("d").alias("definition"))).alias("definitions"))
    value = F.when(F.col("frequency") % 2 == 0, F.to_json(F.struct("word", "frequency", F.array(entry).alias("entries")))).otherwise(F.to_json(F.struct("word", F.col("frequency").cast("string").alias("frequency"), F.array(entry).alias("entries"))))
    rows = readers.validated_records(V.lex(spark, d).select(value.alias("line")))
    return rows.select("word", "frequency", F.size("entries").alias("n_entries"), F.col("entries")[0]["partOfSpeech"].alias("pos"))


@query(f"WITH {V.SQL_TAGGED} SELECT word || ',' || frequency || ',' || part_of_speech || ',' || array_to_string(tags, ',') AS line FROM tagged")
def validated_csv_line(spark, d):
    """K5"""
    return V.tagged(spark, d).select(writers.validated_line(F.col("word"), F.col("frequency"), F.array("part_of_speech"), F.col("tags")).alias("line"))
