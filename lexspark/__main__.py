"""``python -m lexspark COMMAND ...``: the stages as commands over files. ``help`` lists them."""

from __future__ import annotations

import inspect
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions import tagexpr, tagging, wikitext
from lexspark.functions import text as T
from lexspark.operators import lexicon, morph
from lexspark.operators import relational as R
from lexspark.sources import readers, writers


def _spark() -> SparkSession:
    return SparkSession.builder.appName("lexspark").getOrCreate()


def cmd_parse(source: str, target: str) -> None:
    """Tags validated records (JSON lines) and writes ragged lines."""
    rows = tagging.tag_words(tagging.by_part_of_speech(readers.validated_records(readers.indexed_lines(_spark(), source))))
    writers.write_lines(rows, writers.ragged_line(*(F.col(c) for c in ("word", "frequency", "part_of_speech", "tags"))), target, [F.col("word"), F.col("part_of_speech")])


def cmd_filter(source: str, expression: str, target: str) -> None:
    """Keeps the tagged lines that an expression holds for."""
    rows = readers.tagged_rows(readers.indexed_lines(_spark(), source), header=False)
    kept = rows.where(tagexpr.compile_expression(expression, tagexpr.tag_set(F.col("part_of_speech"), F.col("tags")), F.col("word")))
    writers.write_lines(kept, writers.ragged_line(*(F.col(c) for c in ("word", "frequency", "part_of_speech", "tags"))), target, [F.col("row_idx")])


def cmd_extract(source: str, target: str, single: str = "n") -> None:
    """Words, tags and definitions of a dump's pages."""
    classified = wikitext.classify_pages(readers.wiki_pages(_spark(), source))
    writers.write_table(wikitext.extracted(classified, single == "y").orderBy("word", "ord").drop("ord"), f"{target}/extract")
    writers.write_table(wikitext.rejected(classified).orderBy("word"), f"{target}/filtered")


def cmd_dictionaries(source: str, target: str, least: str = "0") -> None:
    """Dictionaries by length of a combined table (word, count, tag, definition)."""
    rows = _spark().read.option("header", True).csv(source).withColumn("count", F.col("count").cast("long"))
    writers.write_lines(lexicon.dictionary_lines(rows, int(least)), F.col("line"), target, [-F.col("count"), F.col("line")], by="len")


def cmd_remove_dups(source: str, target: str) -> None:
    """The first line of each first field."""
    lines = readers.indexed_lines(_spark(), source)
    writers.write_lines(R.dedupe_first(lines, F.substring_index("line", ",", 1), ["row_idx"]), F.col("line"), target, [F.col("row_idx")])


def cmd_sort_freq(source: str, target: str) -> None:
    """Lines by their second field, largest first."""
    lines = readers.indexed_lines(_spark(), source)
    number = F.coalesce(F.split("line", ",")[1].try_cast("double"), F.lit(0.0))
    lines.orderBy(number.desc(), "line").select("line").write.mode("overwrite").text(target)


def _fields(lines: DataFrame) -> DataFrame:
    """Lines with their first two fields: ``key``, and ``number``, 0 where it is none."""
    parts = F.split("line", ",", -1)
    number = F.coalesce(F.regexp_extract(F.get(parts, F.lit(1)), r"^\s*([-+]?[0-9]+(?:\.[0-9]*)?)", 1).try_cast("double"), F.lit(0.0))
    return lines.withColumns({"key": parts[0], "number": number})


def cmd_sort_freq_dups(source: str, target: str) -> None:
    """The line of the largest second field for each first field."""
    rows = _fields(readers.indexed_lines(_spark(), source))
    writers.write_lines(R.max_per_key(rows, "key", "number", ["row_idx"]), F.col("line"), target, [F.col("key")])


def cmd_freq(source: str, target: str, least: str = "1") -> None:
    """Lines whose second field is at least so much."""
    rows = _fields(readers.indexed_lines(_spark(), source)).where(F.col("number") >= float(least))
    writers.write_lines(rows, F.col("line"), target, [F.col("row_idx")])


def cmd_split(source: str, target: str, least: str) -> None:
    """Folders of lines whose second field is at least so much, and of the others."""
    n = int(least)
    if n <= 0:
        raise SystemExit("the number must be positive")
    more, less = R.threshold_split(_fields(readers.indexed_lines(_spark(), source)), "number", n)
    for name, rows in (("more", more), ("less", less)):
        writers.write_lines(rows, F.col("line"), f"{target}-{name}-{n}.csv", [F.col("row_idx")])


def cmd_clean_leipzig(source: str, target: str, least: str = "3", most: str = "7") -> None:
    """Words of a Leipzig list longer than LEAST and of at most MOST characters, each once."""
    rows = lexicon.leipzig_rows(readers.indexed_lines(_spark(), source), "row_idx", int(least), int(most))
    writers.write_lines(rows, F.col("line"), target, [F.col("row_idx")])


def cmd_combine_valid(source: str, target: str) -> None:
    """The validated lines of all runs whose name ends with SOURCE, the oldest first."""
    writers.write_lines(readers.union_by_time(_spark(), f"{source}-VALIDATED.csv"), F.col("line"), target, [F.col("row_idx")])


def cmd_make_dictionary(source: str, target: str) -> None:
    """Lines with a blank for their first comma."""
    writers.write_lines(readers.indexed_lines(_spark(), source), T.make_dictionary_line(F.col("line")), target, [F.col("row_idx")])


def cmd_answers(dictionary: str, skip: str = "0", keep: str = "100", ignored: str = "") -> None:
    """A slice of a dictionary beside it, its percentages from its first line on, without ignored words."""
    lines = readers.dictionary_lines(_spark(), dictionary)
    words = readers.dictionary_lines(_spark(), ignored).select(T.strip(F.col("line")).alias("word")) if ignored else None
    print(writers.write_answers(lexicon.answers(lines, ["row_idx"], float(skip), float(keep), words), [F.col("row_idx")], dictionary))


def cmd_split_wordforms(source: str, target: str, suffixes: str) -> None:
    """Folders of lines by the first suffix (of a list with commas) of their word; prints how many are in each."""
    for r in writers.write_suffixes(readers.indexed_lines(_spark(), source), wikitext.word_list(suffixes), target).orderBy("suffix").collect():
        print(f"{r.suffix} - {r.records} records")


def cmd_morph_csv(source: str, target: str) -> None:
    """Features of an analyser's token objects, in quotes."""
    rows = readers.morph_tokens(_spark(), source)
    features = rows.select("sentence_id", "id", "lemma", "POS", *morph.feature_columns(F.col("features")))
    ordered = R.numbered(features, ["sentence_id", "id"])[0]
    writers.write_quoted(ordered, ["lemma", "POS", "gender", "number", "person", "tense"], "row_idx", target)


def cmd_clean(folder: str, base: str) -> None:
    """Removes the buckets of a run."""
    print(writers.clean(_spark(), folder, base))


def cmd_help() -> None:
    """Lists the commands."""
    for name, f in sorted(globals().items()):
        if name.startswith("cmd_"):
            print(f"{name[4:]} {' '.join(p.upper() for p in inspect.signature(f).parameters)}: {f.__doc__}")


def main(args: list[str]) -> int:
    command = globals().get(f"cmd_{args[0]}") if args else cmd_help
    if command is None:
        print(f"unknown command: {args[0]}", file=sys.stderr)
        cmd_help()
        return 2
    try:
        command(*args[1:])
    finally:
        if args and SparkSession.getActiveSession():
            R.forget(_spark())
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
