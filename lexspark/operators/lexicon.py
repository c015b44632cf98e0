"""From words with tags and counts to dictionaries by length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import relational as R

#: How parts of speech are weighed.
POS_WEIGHTS = {"NOML": 13, "NOUN": 12, "ADJ": 11, "VERB": 10, "ADV": 9, "PRON": 8, "NUM": 7, "ADP": 6, "CONJ": 5, "MOD": 4, "INTJ": 3, "ABBR": 2, "PLC": 1}
#: Words of a boost or ignore list up to which it is broadcast; such lists are written by hand.
HAND_WRITTEN = 100_000


def word_counts(words: DataFrame, word: str = "word") -> DataFrame:
    return words.groupBy(word).agg(F.count(F.lit(1)).alias("count"))


def allowed_tags(weights: dict[str, int], least: int) -> list[str]:
    return sorted(t for t, w in weights.items() if w >= least)


def last_counts(counts: DataFrame, order: str = "row_idx") -> DataFrame:
    """(word, base) of each trimmed word: its last row with a readable count."""
    rows = counts.select(T.strip(F.col("word")).alias("word"), T.parse_int(F.col("count").cast("string")).alias("base"), order).where("base is not null")
    return rows.groupBy("word").agg(F.max_by("base", order).alias("base"))


def combine(tagged: DataFrame, counts: DataFrame, weights: dict[str, int] = POS_WEIGHTS, least_weight: int = 0, boosted: DataFrame | None = None, least: int = 4, most: int = 9) -> DataFrame:
    """(word, count, tag, definition): the first row of each lower-case word that has an allowed tag and length.

    ``tagged`` has (word, tag, definition, source_ord, row_idx). The count is one more than that of the word as it is
    written, and padded for boosted words. Rows are filtered and deduplicated before counts are joined.
    """
    rows = tagged.withColumn("_raw", T.strip(F.col("word"))).withColumn("tag", T.strip(F.col("tag"))).withColumn("_low", F.lower("_raw"))
    right = F.col("tag").isin(*allowed_tags(weights, least_weight)) & F.char_length("_low").between(least, most)
    first = R.dedupe_first(rows, "_low", ["source_ord", "row_idx"], right)
    joined = first.join(last_counts(counts).withColumnRenamed("word", "_raw"), "_raw", "left").withColumn("_n", F.coalesce("base", F.lit(0)) + 1)
    if boosted is not None:
        flags = boosted.select(F.lower("word").alias("_low"), F.lit(True).alias("_boost")).distinct()
        joined = joined.join(flags, "_low", "left")
    else:
        joined = joined.withColumn("_boost", F.lit(False))
    return joined.select(F.col("_low").alias("word"), T.apply_boost(F.col("_n"), F.coalesce("_boost", F.lit(False))).alias("count"), "tag", "definition")


def dictionary_lines(combined: DataFrame, least_count: int = 0) -> DataFrame:
    """(len, count, line) of words with enough counts; a file of a length has its lines by count, largest first."""
    rows = combined.where(F.col("count") >= least_count)
    line = F.concat(F.col("word"), F.lit(" "), F.concat_ws(",", F.col("count").cast("string"), F.coalesce("tag", F.lit("")), F.coalesce("definition", F.lit(""))))
    return rows.select(F.char_length("word").alias("len"), "count", line.alias("line"))


def bucket_summary(combined: DataFrame) -> DataFrame:
    return combined.groupBy(F.char_length("word").alias("len")).agg(F.count(F.lit(1)).alias("words"), F.min("count").alias("least"), F.max("count").alias("most"))


def answers(lines: DataFrame, order: list[Column | str], skip: float, keep: float, ignored: DataFrame | None = None) -> DataFrame:
    """A slice of a dictionary's lines by position; ignored words go after the slice, so the answers may be fewer."""
    part = R.percentile_slice(lines.where(F.trim("line") != ""), order, skip, keep)
    if ignored is None:
        return part
    return part.withColumn("_word", F.lower(T.line_word(F.col("line")))).join(ignored.select(F.lower("word").alias("_word")).distinct(), "_word", "left_anti").drop("_word")


def leipzig_rows(lines: DataFrame, order: str, least: int = 3, most: int = 7) -> DataFrame:
    """(line): fields from the second on in lower case, comma-joined, for alphabetic words longer than ``least`` and of
    at most ``most`` characters; the first row of each word."""
    fields = F.filter(F.split(F.col("line"), r"\s+"), lambda x: x != "")
    rows = lines.withColumn("f", fields).where("size(f) > 1").withColumn("w", F.col("f")[1])
    rows = rows.where((F.char_length("w") > least) & (F.char_length("w") <= most) & F.col("w").rlike(r"^\p{L}+$"))
    out = rows.select(F.lower("w").alias("word"), F.array_join(F.transform(F.slice("f", 2, F.size("f") - 1), F.lower), ",").alias("line"), order)
    return R.dedupe_first(out, "word", [order])
