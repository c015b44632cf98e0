"""Line deduplication over levelled sorted runs of line hashes, in DataFrame operations only.

Batches of documents come by ascending id. Each is merged against the runs by an anti-join: what is left are the lines
that no earlier batch has. These are the run that the batch adds; a run is a table of (h1, h2, n_docs, n_rows,
first_doc) in sorted buckets, and a line is in one run only. The batch's other lines are kept beside its run as more documents of
lines that an earlier run has. As soon as a level has ``fanout`` runs they are merged into one run of the next level,
so n batches leave about log(n) runs. All runs and batches have the same sorted buckets, so that joins and merges
read them side by side, without a shuffle. In the end a line's documents are those that its run has, and the more.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lexspark.llm._scratch import Scratch, hot_join, merging
from lexspark.operators.relational import spread

#: Code points that are stripped at both ends of a line (x20 and x09 to x0D).
BLANK = " \t\n\x0b\x0c\r"


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, every other code point as it is."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _row_key(id_col: str, text_col: str) -> list[Column]:
    """Two hashes that tell rows apart by id and whole text; equal rows are equal in all that follows."""
    return [F.xxhash64(id_col, text_col).alias("r1"), F.xxhash64(F.lit(1), text_col, id_col).alias("r2")]


def hashed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """(r1, r2, id, pos, h1, h2): a row for each line whose key has at least ``min_chars`` code points."""
    exploded = docs.select(*_row_key(id_col, text_col), F.col(id_col).alias("id"), F.posexplode(_lines(text_col)).alias("pos", "line"))
    keyed = exploded.withColumn("key", ascii_lower(F.btrim("line", F.lit(BLANK)))).where(F.char_length("key") >= min_chars)
    return keyed.select("r1", "r2", "id", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"))


_HASH = ["h1", "h2"]
#: What is known of a line: the documents that have it, the rows that it has, the smallest id of these documents.
_FACTS = ["n_docs", "n_rows", "first_doc"]


@dataclass
class LineRuns:
    """The runs, by level: written tables in the shared folder with a column ``new`` that parts the lines that a run has
    (no other run has them) from the more documents of lines of earlier runs. They are never changed, only replaced;
    ``written`` has all of them, for the one who drops them."""

    spark: SparkSession
    scratch: Scratch
    fanout: int = 2
    levels: list[list[DataFrame]] = field(default_factory=list)
    written: list[DataFrame] = field(default_factory=list)

    def runs(self) -> list[DataFrame]:
        """Older runs first."""
        return [run for level in reversed(self.levels) for run in level]

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The rows of ``lines`` (with h1 and h2) whose hash is in no run: an anti-join with each run."""
        for run in self.runs():
            lines = lines.join(run.where("new").select(*_HASH), _HASH, "left_anti")
        return lines

    def _sorted(self, run: DataFrame) -> DataFrame:
        out = self.scratch.write_sorted(run.select(*_HASH, *_FACTS, "new"), "run", _HASH, ("new",))
        self.written.append(out)
        return out

    @staticmethod
    def merged(one: DataFrame, other: DataFrame) -> DataFrame:
        """Both runs in one: a line that a run has is in no other, and more documents are added up."""

        def both(new: bool, facts: Callable[[str], Column]) -> DataFrame:
            x, y = (run.where(F.col("new") == new).select(*_HASH, F.struct(*_FACTS).alias(name)) for run, name in ((one, "x"), (other, "y")))
            return x.join(y, _HASH, "full").select(*_HASH, *(facts(c).alias(c) for c in _FACTS), F.lit(new).alias("new"))

        return both(True, lambda c: F.coalesce("x", "y")[c]).unionByName(both(False, lambda c: _added(c, F.col("x")[c], F.col("y")[c])))

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        """Two at a time, from the latest, which are the smallest: what is written is in sorted buckets again."""
        out, *rest = reversed(runs)
        for run in rest:
            out = self._sorted(self.merged(run, out))
        return out

    def add(self, batch: DataFrame) -> DataFrame:
        """Adds a batch of (h1, h2, n_docs, n_rows, first_doc), a table in sorted buckets with one row a hash; returns its run."""
        new = self.unseen(batch).select(*_HASH, F.lit(True).alias("new"))
        run = self._sorted(batch.join(new, _HASH, "left").withColumn("new", F.coalesce("new", F.lit(False))))
        level, carried = 0, run
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(carried)
            if len(self.levels[level]) < self.fanout:
                return run
            carried = self._merge(self.levels[level])
            self.levels[level] = []
            level += 1

    def totals(self) -> DataFrame:
        """(h1, h2, n_docs, n_rows, first_doc) of all lines of the runs, with the more documents that later batches have."""
        every = self._merge(self.runs())
        more = every.where("not new").select(*_HASH, F.struct(*_FACTS).alias("more"))
        joined = every.where("new").join(more, _HASH, "left")
        return joined.select(*_HASH, *(_added(c, F.col(c), F.col("more")[c]).alias(c) for c in _FACTS))


def _added(fact: str, x: Column, y: Column) -> Column:
    return F.least(x, y) if fact == "first_doc" else F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0))


def _counted(lines: DataFrame) -> DataFrame:
    """Documents and rows of each hash in each batch. The first step makes a line one row in a document and spreads a
    frequent line over all tasks; the second adds up in the map tasks before it shuffles."""
    once = lines.groupBy("batch", *_HASH, "id").agg(F.count(F.lit(1)).alias("n_rows"))
    return once.groupBy("batch", *_HASH).agg(F.count("id").alias("n_docs"), F.sum("n_rows").alias("n_rows"), F.min("id").alias("first_doc"))


#: Lines of a batch, at most, on average; a small table has BATCHES of them all the same.
BATCH_LINES, BATCHES = 1 << 30, 4


def _batch(lines: DataFrame, batches: int) -> Column:
    """The number of the batch of a line's id: ranges of about as many lines, or a hash where ids are no numbers. All rows
    of an id are in one batch. Where exactly batches are cut has no effect on the result."""
    if not isinstance(lines.schema["id"].dataType, NumericType):
        return F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")
    cuts = lines.agg(F.percentile_approx("id", [i / batches for i in range(1, batches)])).first()[0] if batches > 1 else None
    out = F.lit(0)
    for i, cut in enumerate(sorted({*(cuts or [])})):
        out = F.when(F.col("id") > cut, F.lit(i + 1)).otherwise(out)
    return out


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, batches: int | None = None, fanout: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text after dropping, and ``n_lines`` (before) and ``n_dropped``, in columns of these names.

    A line's key is the line without the blanks x20 and x09-x0D at its ends and with A-Z in lower case. Keys of at
    least ``min_chars`` code points that occur in at least ``min_docs`` documents lose their lines: in every document,
    or with ``keep_first`` in every document but that of the smallest id. Other lines stay, joined by a newline.
    There are BATCHES batches, or more of BATCH_LINES lines, if ``batches`` does not say how many.

    A document is an id: rows of one id count once for a line, whatever their texts. Rows without an id do not count,
    but lose frequent lines like others. Each row gets a result of its own, equal rows equal ones. A null or empty
    text is one empty line (and stays as it is). Other columns pass unchanged; columns called n_lines or n_dropped are
    replaced. An empty table gives an empty result.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "lines")
    docs = docs.drop("n_lines", "n_dropped")
    lines = scratch.write(hashed_lines(spread(docs.select(id_col, text_col)), id_col, text_col, min_chars), "lines")
    total = lines.count()
    batches = max(BATCHES, -(-total // BATCH_LINES)) if batches is None else batches
    dealt = _counted(lines.withColumn("batch", _batch(lines, batches))).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *_HASH)
    counted = scratch.write_sorted(dealt, "batches", _HASH, ("batch",))
    runs = LineRuns(spark, scratch, fanout)
    for i in range(batches):
        runs.add(counted.where(F.col("batch") == i).drop("batch"))
    with merging(spark):
        found = scratch.write(runs.totals().where(F.col("n_docs") >= min_docs), "frequent")
    scratch.drop(counted, *runs.written)

    hits = hot_join(lines, found, _HASH, "n_rows")
    if keep_first:
        hits = hits.where("id is null or first_doc is null or id != first_doc")
    places = hits.groupBy("r1", "r2").agg(F.collect_set("pos").alias("gone"))

    # the row is one column, so that no name of its own can clash with those of the join
    keyed = docs.select(F.struct(*docs.columns).alias("row"), *_row_key(id_col, text_col), _lines(text_col).alias("lines"))
    joined = keyed.join(places, ["r1", "r2"], "left")
    # array_except hashes, so that a text of very many lines takes linear time
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    text = F.when(F.col("gone").isNull(), F.col("row")[text_col]).otherwise(F.array_join(F.transform(kept, lambda i: F.col("lines")[i]), "\n"))
    columns = [(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns]
    return joined.select(*columns, F.size("lines").cast("long").alias("n_lines"), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"))
