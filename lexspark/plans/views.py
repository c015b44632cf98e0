"""Base views over the test tables that the library's queries start from, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.operators import relational as R


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word), a row for each run of letters of the documents, in lower case."""
    return R.spread(table(spark, sf_dir, "documents").select("text")).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))).alias("word"))


def lex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, frequency) of words of four to seven letters."""
    return words(spark, sf_dir).where(F.char_length("word").between(4, 7)).groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, frequency, part_of_speech, tags): lex with parts of speech and tags that follow from its values."""
    pos = F.element_at(F.array(*map(F.lit, ("NOUN", "VERB", "ADJ", "ADV"))), ((F.char_length("word") + F.col("frequency")) % 4 + 1).cast("int"))
    tags = F.array_compact(F.array(F.when(F.col("frequency") < 3, "RARE"), F.when(F.col("word").endswith("s"), "PLURAL"), F.when(F.char_length("word") == 4, "SHORT")))
    return lex(spark, sf_dir).withColumn("part_of_speech", pos).withColumn("tags", tags)


SQL_WORDS = r"words AS (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents)"
SQL_LEX = SQL_WORDS + ", lex AS (SELECT word, count(*) AS frequency FROM words WHERE length(word) BETWEEN 4 AND 7 GROUP BY word)"
SQL_TAGGED = SQL_LEX + """, tagged AS (SELECT word, frequency, ['NOUN','VERB','ADJ','ADV'][(length(word) + frequency) % 4 + 1] AS part_of_speech,
  list_filter([CASE WHEN frequency < 3 THEN 'RARE' END, CASE WHEN word LIKE '%s' THEN 'PLURAL' END, CASE WHEN length(word) = 4 THEN 'SHORT' END], lambda t: t IS NOT NULL) AS tags FROM lex)"""
