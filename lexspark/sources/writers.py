"""Writers: every sink is a folder that Spark's committer fills; inputs are never overwritten."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import relational as R


def csv_cell(c: Column) -> Column:
    """A field, in quotes if it needs them."""
    s = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(s.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(s)


def ragged_line(word: Column, frequency: Column, part_of_speech: Column, tags: Column) -> Column:
    """word,frequency,part of speech,tag,tag,..."""
    return F.concat_ws(",", csv_cell(word), csv_cell(frequency), csv_cell(part_of_speech), F.transform(tags, csv_cell))


def validated_line(word: Column, frequency: Column, positions: Column, tags: Column) -> Column:
    """Without quotes: word, frequency, parts of speech, and the tags last (an empty field if there are none)."""
    return F.concat_ws(",", F.concat(F.array(word, frequency.cast("string")), positions, F.array(F.array_join(tags, ","))))


def write_outcomes(classified: DataFrame, path: str, append: bool = False) -> None:
    """A folder for each outcome."""
    classified.write.mode("append" if append else "overwrite").partitionBy("outcome").json(path)


def write_lines(rows: DataFrame, line: Column, path: str, order: list[Column] | None = None, by: str | None = None, append: bool = False) -> None:
    """Text lines; ``by`` makes a folder for each value. With an order the files of a folder, by name, are in order: rows
    are dealt out by ranges, so that a large value is as many files as it needs. ``append`` adds a run after those that
    are there: a numbered folder, whose name comes after theirs."""
    if append:
        path = claimed_run(rows.sparkSession, path, True)
    out = rows.select(line.alias("value"), *([by] if by else []), *[o.alias(f"_o{i}") for i, o in enumerate(order or [])])
    keys = [c for c in out.columns if c != "value"]
    if keys:
        out = out.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = out.drop(*[c for c in keys if c != by]).write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).text(path)


#: What the buckets of outcomes are called, for the two tools.
BUCKETS = {
    "jsonl": {"VALIDATED": "{0}-VALIDATED.jsonl", "RETRY": "R{0}.csv", "NONEXISTENT": "N{0}.csv", "REJECTED": "{0}-REJECTED.csv"},
    "csv": {"VALIDATED": "{0}-VALIDATED.csv", "NONEXISTENT": "N{0}.csv", "HARD": "R{0}.csv", "REJECTED": "{0}-REJECTED.csv"},
}


def bucket_names(source: str, flavour: str = "jsonl") -> dict[str, str]:
    """The name of each outcome's bucket, after the input's file without its folder and ``.csv``."""
    base = source.rstrip("/").rsplit("/", 1)[-1]
    base = base[:-4] if base.lower().endswith(".csv") else base
    return {outcome: name.format(base) for outcome, name in BUCKETS[flavour].items()}


def _files(spark: SparkSession, path: str):
    """(the path, its file system) for Hadoop's calls."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def claimed_run(spark: SparkSession, path: str, append: bool) -> str:
    """The folder of the next run below ``path``, which only the caller has: ``run=000000`` and so on, so that the order of
    names is that of runs. Without ``append`` what is there goes first.

    A number is claimed by a hidden file that is created only if it is not there, so two writers never share a run.
    """
    where, files = _files(spark, path)
    if not append:
        files.delete(where, True)
    files.mkdirs(where)
    taken = [re.sub(r"\D", "", f.getPath().getName()) for f in files.listStatus(where) if re.match(r"run=|_claim-", f.getPath().getName())]
    nth = 1 + max(map(int, taken), default=-1)
    while not files.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_claim-{nth:06d}")):
        nth += 1
    return f"{path}/run={nth:06d}"


#: Rows of an ordered file of a bucket.
PIECE = 100_000


def write_buckets(rows: DataFrame, folder: str, source: str, flavour: str = "jsonl", append: bool | None = None, validated_to: str | None = None, order: str | None = None) -> dict[str, str]:
    """Writes a bucket for each outcome and returns their paths by outcome.

    ``rows`` has (outcome, token, frequency) and what validated rows are made of: (word, entries) for JSON lines, (word,
    positions, tags) for lines with commas. Other buckets have ``token,frequency``. The JSON flavour replaces what is
    there unless told to append; the other one appends unless told not to. ``validated_to`` is another place for the
    validated rows.

    One write makes all buckets, so a look-up runs once; then each becomes the next run of its path by one rename, and a
    run that fails is never seen. With ``order``, a column of row numbers, a run's files are in that order by name: a file
    holds ``PIECE`` numbers, so rows are dealt out by them without looking at the rows before.
    """
    append = flavour == "csv" if append is None else append
    if flavour == "jsonl":
        validated = F.to_json(F.struct("word", "frequency", "entries"))
    else:
        validated = validated_line(F.col("word"), F.col("frequency"), F.col("positions"), F.col("tags"))
    paths = {outcome: f"{folder}/{name}" for outcome, name in bucket_names(source, flavour).items()}
    if validated_to:
        paths["VALIDATED"] = validated_to if "/" in validated_to else f"{folder}/{validated_to}"
    line = F.when(F.col("outcome") == "VALIDATED", validated).otherwise(F.concat_ws(",", "token", F.col("frequency").cast("string")))
    # an outcome without a bucket is a null, whose part goes; a filter would ask for the outcomes twice
    out = rows.select(line.alias("value"), F.when(F.col("outcome").isin(*paths), F.col("outcome")).alias("outcome"), *([F.col(order).alias("_at")] if order else []))
    keys = ["outcome"]
    if order:
        keys = ["outcome", "piece"]
        out = out.withColumn("piece", F.lpad(F.floor(F.col("_at") / PIECE).cast("string"), 13, "0"))
        out = out.repartition("piece").sortWithinPartitions("outcome", "piece", "_at").drop("_at")
    spark = rows.sparkSession
    written = f"{folder}/_writing-{uuid.uuid4().hex}"
    out.write.partitionBy(*keys).text(written)
    made = spark._jvm.org.apache.hadoop.fs.Path(written)
    for outcome, path in paths.items():
        target, files = _files(spark, claimed_run(spark, path, append))
        part = spark._jvm.org.apache.hadoop.fs.Path(f"{written}/outcome={outcome}")
        if not (files.rename(part, target) if files.exists(part) else files.mkdirs(target)):
            raise OSError(f"{target} cannot be made")
    files.delete(made, True)
    return paths


def remove(spark: SparkSession, *patterns: str) -> int:
    """Deletes what the patterns find and says how many there were."""
    gone = 0
    for pattern in patterns:
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in files.globStatus(path) or []:
            gone += bool(files.delete(found.getPath(), True))
    return gone


def clean(spark: SparkSession, folder: str, base: str) -> int:
    """Removes the buckets of both tools, those of retries (whose names have something before ``base``) included."""
    return remove(spark, *(f"{folder}/{name}" for name in (f"R*{base}.csv", f"N*{base}.csv", f"{base}-VALIDATED.csv", f"{base}-VALIDATED.jsonl", f"{base}-REJECTED.csv")))


def write_suffixes(lines: DataFrame, suffixes: Sequence[str], path: str) -> DataFrame:
    """Lines (line, row_idx) by the first suffix that ends their first word: folders ``suffix=...``, with ``rest`` for the
    others and empty lines. The input is left as it is. Returns (suffix, records), all suffixes included."""
    found = F.when(F.col("line") != "", R.first_suffix(T.first_word_form(F.col("line")), suffixes))
    write_lines(lines.withColumn("suffix", F.coalesce(found, F.lit("rest"))), F.col("line"), path, [F.col("row_idx")], by="suffix")
    spark = lines.sparkSession
    counts = spark.read.schema("value string, suffix string").text(path).groupBy("suffix").agg(F.count(F.lit(1)).alias("records"))
    every = spark.createDataFrame([(s,) for s in [*suffixes, "rest"]], "suffix string")
    return every.join(counts, "suffix", "left").select("suffix", F.coalesce("records", F.lit(0)).alias("records"))


def answers_path(dictionary: str) -> str:
    return dictionary.replace("dictionary-", "answers-")


def write_answers(answers: DataFrame, order: list[Column], dictionary: str) -> str:
    """Lines of answers beside the dictionary that they are from; returns their path."""
    path = answers_path(dictionary)
    write_lines(answers, F.col("line"), path, order)
    return path


def quoted_line(*cells: Column) -> Column:
    """Every text in quotes, numbers without, nothing for a null."""
    return F.concat_ws(",", *(F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in cells))


def write_quoted(rows: DataFrame, columns: Sequence[str], order: str, path: str) -> None:
    """A header and quoted rows in order; the first file begins with a byte-order mark."""
    spark = rows.sparkSession
    header = spark.createDataFrame([("\ufeff" + ",".join(columns), 0, None)], f"line string, _body int, {order} {rows.schema[order].dataType.simpleString()}")
    body = rows.select(quoted_line(*map(F.col, columns)).alias("line"), F.lit(1).alias("_body"), order)
    write_lines(header.unionByName(body), F.col("line"), path, [F.col("_body"), F.col(order)])


def write_table(rows: DataFrame, path: str, tabs: bool = False, header: bool = True) -> None:
    rows.write.mode("overwrite").option("header", header).option("sep", "\t" if tabs else ",").option("escape", '"').csv(path)


def write_split(rows: DataFrame, value: str, least: int, path: str) -> None:
    """Folders ``side=more`` (at least ``least``) and ``side=less``."""
    side = F.when(F.coalesce(F.col(value), F.lit(0)) >= least, "more").otherwise("less")
    rows.withColumn("side", side).write.mode("overwrite").partitionBy("side").csv(path)


def sentences_json(sentences: DataFrame) -> DataFrame:
    """(value): a JSON object for each sentence, properly escaped."""
    return sentences.select(F.to_json(F.struct("sentence_id", "tokens")).alias("value"))
