"""Looking words up in a snapshot of definitions, and sorting the outcomes.

A snapshot is a table (title, status, payload): what a definition service answered for a title. ``entries`` is null
unless the answer was an object; an empty array means that it had nothing in the wanted language.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import relational as R

VALIDATED, REJECTED, NONEXISTENT, RETRY = "VALIDATED", "REJECTED", "NONEXISTENT", "RETRY"


def locale_entries(payload: Column, lang: str) -> Column:
    """The entries under a language of a payload map; without nulls, empty if there are none."""
    got = F.try_element_at(payload, F.lit(lang))
    return F.filter(F.coalesce(got, F.slice(got, 1, 0)), lambda e: e.isNotNull())


def _size(entries: Column) -> Column:
    return F.coalesce(F.when(entries.isNull(), 0).otherwise(F.size(entries)), F.lit(0))


def probe(words: DataFrame, snapshot: DataFrame, title: Column, name: str) -> DataFrame:
    """``words`` with ``status_<name>`` and ``entries_<name>`` of a title; a title that is not there has status 0."""
    found = snapshot.select(F.col("title").alias("_title"), F.col("status").alias(f"status_{name}"), F.col("entries").alias(f"entries_{name}"))
    return words.withColumn("_probe", title).join(found, F.col("_probe") == F.col("_title"), "left").drop("_probe", "_title").withColumn(f"status_{name}", F.coalesce(f"status_{name}", F.lit(0)))


def outcome_plain(status: Column, entries: Column) -> Column:
    """One probe: anything but an object or a 404 is tried again."""
    usable = (status == 200) & entries.isNotNull()
    return F.when(~usable & (status != 404), RETRY).when(status == 404, NONEXISTENT).when(_size(entries) > 0, VALIDATED).otherwise(REJECTED)


def outcome_cap(status1: Column, entries1: Column, status2: Column, entries2: Column) -> Column:
    """The lower-case title first, then the capitalised one; a failure of either is tried again."""
    transient = lambda s, e: ~((s == 200) & e.isNotNull()) & (s != 404)
    missing = (status1 == 404) & (status2 == 404)
    found = (_size(entries1) > 0) & (status1 == 200) | (_size(entries2) > 0) & (status2 == 200)
    return F.when(transient(status1, entries1) | transient(status2, entries2), RETRY).when(missing, NONEXISTENT).when(found, VALIDATED).otherwise(REJECTED)


def entries_cap(status1: Column, entries1: Column, status2: Column, entries2: Column) -> Column:
    """The entries of both probes, the lower-case title's first."""
    empty = F.slice(F.coalesce(entries1, entries2), 1, 0)
    return F.concat(F.coalesce(F.when(status1 == 200, entries1), empty), F.coalesce(F.when(status2 == 200, entries2), empty))


def outcome_cleanse(statuses: Column, sizes: Column) -> Column:
    """struct<outcome, reason> of the other tool, for arrays of probes.

    A status of -1 is an exception. A size is that of the wanted language's section: null for an answer that was no
    object or an empty one. Any section validates; an object without one is the wrong locale and tried again.
    """
    some = lambda test: F.exists(F.arrays_zip(statuses.alias("s"), sizes.alias("n")), test)
    valid = some(lambda p: F.coalesce((p["s"] == 200) & (p["n"] > 0), F.lit(False)))
    wrong = some(lambda p: F.coalesce((p["s"] == 200) & (p["n"] == 0), F.lit(False)))
    other = F.try_element_at(F.filter(statuses, lambda s: ~s.isin(200, 404)), F.lit(1))
    kind = lambda o, r: F.struct(F.lit(o).alias("outcome"), (r if isinstance(r, Column) else F.lit(r).cast("string")).alias("reason"))
    return (
        F.when(F.array_contains(statuses, -1), kind("REJECTED", "exception"))
        .when(valid, kind("VALIDATED", None))
        .when(wrong, kind("REJECTED", "wrong_locale"))
        .when(F.forall(statuses, lambda s: s == 404), kind("NONEXISTENT", None))
        .when(F.array_contains(statuses, 429), kind("HARD", "rate_limited"))
        .when(other.isNotNull(), kind("HARD", F.concat(F.lit("http_"), other.cast("string"))))
        .otherwise(kind("HARD", "unknown_error"))
    )


def classify(words: DataFrame, snapshot: DataFrame, cap: bool = False) -> DataFrame:
    """``words`` (token, and others) with ``word``, ``outcome`` and ``entries``, by one or two joins with a snapshot."""
    words = words.withColumn("word", T.strip_query_suffix(F.col("token")))
    if not cap:
        out = probe(words, snapshot, F.col("word"), "1")
        return out.withColumn("outcome", outcome_plain(F.col("status_1"), F.col("entries_1"))).withColumn("entries", F.when(F.col("outcome") == VALIDATED, F.col("entries_1"))).drop("status_1", "entries_1")
    out = probe(probe(words, snapshot, F.lower("word"), "1"), snapshot, T.upper_first(F.col("word")), "2")
    four = [F.col(c) for c in ("status_1", "entries_1", "status_2", "entries_2")]
    out = out.withColumn("outcome", outcome_cap(*four)).withColumn("entries", F.when(F.col("outcome") == VALIDATED, entries_cap(*four)))
    return out.drop("status_1", "entries_1", "status_2", "entries_2")


def outcome_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("outcome").agg(F.count(F.lit(1)).alias("words"))


def observed(classified: DataFrame, name: str = "outcomes") -> tuple[DataFrame, Observation]:
    """``classified``, and the counts of its outcomes that are there once an action has run over it."""
    seen = Observation(name)
    kinds = (VALIDATED, REJECTED, NONEXISTENT, RETRY)
    return classified.observe(seen, F.count(F.lit(1)).alias("processed"), *[F.count_if(F.col("outcome") == k).alias(k.lower()) for k in kinds]), seen


def retry_until_stable(words: DataFrame, attempt: Callable[[DataFrame, int], DataFrame], write: Callable[[DataFrame, str], DataFrame] = lambda frame, _: R.checkpointed(frame), most_rounds: int = 100) -> DataFrame:
    """Runs ``attempt`` (words, round) again over what it left for RETRY or NONEXISTENT, until nothing has to be retried
    or the nonexistent words are the same as the round before.

    ``write`` materialises a frame in a shared folder under a name and returns it as read back, which cuts the lineage.
    Returns all rows with their last outcome and ``round``.
    """
    done, missing, todo = [], None, words
    for n in range(1, most_rounds + 1):
        got = write(attempt(todo, n).withColumn("round", F.lit(n)), f"round-{n}")
        again = got.where(F.col("outcome") == RETRY)
        now = got.where(F.col("outcome") == NONEXISTENT)
        stable = missing is not None and missing.select("word").exceptAll(now.select("word")).isEmpty() and now.select("word").exceptAll(missing.select("word")).isEmpty()
        if again.isEmpty() or stable or n == most_rounds:
            done.append(got)
            break
        done.append(got.where(~F.col("outcome").isin(RETRY, NONEXISTENT)))
        missing, todo = now, again.unionByName(now).select(*words.columns)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def retry_stream(words: DataFrame, attempt: Callable[[DataFrame, int], DataFrame], folder: str, most_rounds: int = 100) -> DataFrame:
    """``retry_until_stable`` as a stream that can be stopped at any time: called again with the same ``folder``, which has
    to outlive the program, it goes on with the round that was not finished.

    The words of a round are files that the stream takes as one batch; what the batch leaves for RETRY or NONEXISTENT
    becomes the files of the next one. A round that is written is never asked again: the stream's own record tells which
    files a batch has, and each step is a rename to a name that is then left alone.
    """
    spark, schema = words.sparkSession, words.schema
    rounds = lambda kind, n: f"{folder}/{kind}/round={n:06d}"
    path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(name)
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def put(frame: DataFrame, target: str) -> None:
        if files.exists(path(target)):
            return
        made = f"{folder}/_writing-{uuid.uuid4().hex}"
        frame.write.parquet(made)
        files.mkdirs(path(target).getParent())
        if not files.rename(path(made), path(target)):
            raise OSError(f"{target} cannot be made")

    def missing(n: int) -> DataFrame:
        return spark.read.parquet(rounds("done", n)).where(F.col("outcome") == NONEXISTENT).select("word")

    def step(batch: DataFrame, number: int) -> None:
        n = number + 1
        if not files.exists(path(rounds("done", n))):
            put(attempt(batch.select(*words.columns), n).withColumn("round", F.lit(n)), rounds("done", n))
        got = spark.read.parquet(rounds("done", n))
        stable = n > 1 and R.same_rows(missing(n - 1), missing(n))
        if n == most_rounds or stable or got.where(F.col("outcome") == RETRY).isEmpty():
            files.createNewFile(path(f"{folder}/_finished-{n:06d}"))
        else:
            put(got.where(F.col("outcome").isin(RETRY, NONEXISTENT)).select(*words.columns), rounds("todo", n + 1))

    put(words, rounds("todo", 1))
    while not (ended := files.globStatus(path(f"{folder}/_finished-*"))):
        stream = spark.readStream.schema(schema).parquet(f"{folder}/todo/round=*")
        stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    last = int(ended[0].getPath().getName().rsplit("-", 1)[1])
    out = [spark.read.parquet(rounds("done", n)) for n in range(1, last + 1)]
    kept = [got.where(~F.col("outcome").isin(RETRY, NONEXISTENT)) for got in out[:-1]]
    return reduce(DataFrame.unionByName, [*kept, out[-1]])
