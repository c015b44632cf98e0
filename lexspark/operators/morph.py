"""Morphology: token tables with sentences, and what is taken from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import relational as R

#: Morphological classes that words are taken of, and symbols that no lemma may have.
WORD_CLASSES = ("NN", "JJ", "VB", "BN")
FORBIDDEN = ",.״ ־׳"
CATEGORY = "קטגוריה:"


def conll_tokens(lines: DataFrame, row_idx: str = "row_idx", header: bool = True, drop_open_end: bool = False) -> DataFrame:
    """(row_idx, sentence_id, id, form, lemma, POS, features) of lines with five fields or more.

    A blank line ends a sentence that has a token; sentences count from 0. The first line is skipped. The last sentence
    is kept even without a blank line behind it, unless ``drop_open_end``.
    """
    rows = lines.where(F.col(row_idx) > 0) if header else lines
    rows = rows.withColumn("f", F.filter(F.split("line", r"[ \t]+"), lambda x: x != "")).withColumn("token", F.size("f") >= 5)
    rows = R.in_pieces(rows.where("token or size(f) = 0").select(row_idx, "f", "token"), row_idx)
    # a token opens a sentence if no token is right before it; what a piece's first token is, the piece before tells
    inside = Window.partitionBy("_piece").orderBy(row_idx)
    opens = (F.col("token") & ~F.coalesce(F.lag("token").over(inside), F.lit(False))).cast("long")
    kept = R.checkpointed(rows.withColumn("_opens", opens).withColumn("_nth", F.sum("_opens").over(inside)))
    row = F.struct(row_idx, "token")
    pieces = kept.groupBy("_piece").agg(F.sum("_opens").alias("n"), F.min(row)["token"].alias("first"), F.max(row)["token"].alias("last"))
    order = Window.orderBy("_piece")  # a row a piece
    joins = (F.col("first") & F.coalesce(F.lag("last").over(order), F.lit(False))).cast("long")
    carried = pieces.withColumn("joins", joins).withColumn("_before", F.sum(F.col("n") - F.col("joins")).over(order) - F.col("n")).select("_piece", "_before")
    tokens = kept.where("token")
    if drop_open_end:
        last = kept.where("not token").agg(F.max(row_idx).alias("_last"))
        tokens = tokens.crossJoin(F.broadcast(last)).where(F.col(row_idx) < F.col("_last"))  # a single row
    names = ["id", "form", "lemma", "POS", "features"]
    sentence = (F.col("_before") + F.col("_nth") - 1).alias("sentence_id")
    return tokens.join(F.broadcast(carried), "_piece").select(row_idx, sentence, *[F.col("f")[i].alias(n) for i, n in enumerate(names)])


def sentences(tokens: DataFrame, row_idx: str = "row_idx") -> DataFrame:
    """(sentence_id, tokens) with the tokens of a sentence in order."""
    row = F.struct(row_idx, "id", "form", "lemma", "POS", "features")
    return tokens.groupBy("sentence_id").agg(F.transform(F.sort_array(F.collect_list(row)), lambda t: t.dropFields(row_idx)).alias("tokens"))


def feature_columns(features: Column) -> list[Column]:
    """gender, number, person and tense of a feature string; empty where it has none."""
    f = F.coalesce(features, F.lit(""))
    patterns = {"gender": "gen=([MF])", "number": "num=([SP])", "person": "per=([123])", "tense": "tense=([A-Z]+)"}
    return [F.regexp_extract(f, p, 1).alias(n) for n, p in patterns.items()]


def morph_words(tokens: DataFrame) -> DataFrame:
    """Distinct words of the wanted classes. The analyser's columns are shifted: the class stands in ``features``, the
    lemma in ``POS``."""
    return tokens.where(F.col("features").isin(*WORD_CLASSES)).select(F.col("POS").alias("word")).distinct()


def hebrew_words(lines: DataFrame, length: int, column: str = "line") -> DataFrame:
    """Words of Hebrew letters only, of exactly this length once marks are dropped."""
    word = F.regexp_replace(T.nfc(T.strip(F.col(column))), r"\p{Mn}", "")
    return lines.select(word.alias("word")).where(F.col("word").rlike("^[א-ת]*$") & (F.char_length("word") == length))


def lemma_filter(titles: DataFrame, column: str = "title") -> DataFrame:
    """Titles of four to six characters that name no category and have none of the forbidden symbols."""
    t = F.col(column)
    return titles.where(~t.startswith(CATEGORY) & F.char_length(t).between(4, 6) & (F.translate(t, FORBIDDEN, "") == t))
