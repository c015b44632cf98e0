"""Order-aware relational tools. Whatever depends on an order takes the columns that define it."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a piece of an ordered table, on average, and the most pieces: a table of these has a row a piece.
CHUNK, PIECES = 100_000, 4096
#: Groups of tasks whose quantiles are merged apart.
GROUPS = 64


def spread(frame: DataFrame, rows: int | None = None) -> DataFrame:
    """``frame``, dealt out evenly if it is a plain scan that would keep few cores busy: for steps that take much longer for a
    row than its shuffle. That is one of fewer splits than there are cores, as of a small file, or one where a split has
    more than twice a core's share of the rows, as of a file of few row groups: the other splits of such a file are empty.
    With ``rows``, for narrow tables, no task gets many more than so many rows. Others stay as they are."""
    execution = frame._jdf.queryExecution()
    if frame.isStreaming or execution.executedPlan().nodeName().startswith("AdaptiveSparkPlan"):
        return frame
    cores, splits = frame.sparkSession.sparkContext.defaultParallelism, execution.toRdd().getNumPartitions()
    if splits < cores and rows is None:
        return frame.repartition(cores)
    told = frame.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max("n").alias("most")).first()
    even = splits >= cores and (told.most or 0) <= (-(-2 * told.n // cores) if rows is None else rows)
    if even:
        return frame
    # by numbers of rows, as Spark sorts all rows of a split before it deals them out in turn
    tasks = max(cores, splits if rows is None else -(-told.n // rows))
    dealt = frame.withColumn("_nth", F.monotonically_increasing_id()).repartition(tasks, "_nth").drop("_nth")
    # exploded, as Spark would work out conditions on what is made of the rows before they are dealt out otherwise
    return dealt if rows is None else dealt.select(F.inline(F.array(F.struct("*"))))


def dedupe_first(rows: DataFrame, key: Column | str, order: Sequence[str], eligible: Column | None = None) -> DataFrame:
    """The first row of each key. Rows that are not ``eligible`` neither appear nor claim a key.

    ``min_by`` combines within the map tasks, so a hot key shuffles one row a task.
    """
    rows = rows if eligible is None else rows.where(F.coalesce(eligible, F.lit(False)))
    key = F.col(key) if isinstance(key, str) else key
    best = rows.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def max_per_key(rows: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """The row of each key with the largest value; among equals the first."""
    best = rows.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*rows.columns), F.struct((-F.col(value)).alias("v"), *order)).alias("_row"))
    return best.select("_row.*")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a local session without one gets one."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lexspark-"))
    return context._jsc.sc().getCheckpointDir().get()


_kept: list[str] = []


def checkpointed(frame: DataFrame) -> DataFrame:
    """``frame``, computed now and kept in the shared folder as columns: later steps read those that they use. ``forget``
    deletes what was kept."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
    _kept.append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def forget(spark: SparkSession) -> int:
    """Deletes all tables that this program has kept, and says how many: for when results are written, as frames read
    them until then."""
    gone, conf = 0, spark._jsc.hadoopConfiguration()
    while _kept:
        path = spark._jvm.org.apache.hadoop.fs.Path(_kept.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def _pooled_cuts(groups: Sequence[tuple[int, Sequence[int]]], pieces: int) -> list[int]:
    """Where values that are known by evenly spaced quantiles of groups, of so many values each, fall into equal pieces."""
    at = np.concatenate([np.asarray(cuts, dtype=np.int64) for _, cuts in groups])
    share = np.concatenate([np.full(len(cuts), n / len(cuts)) for n, cuts in groups])
    order = np.argsort(at, kind="stable")
    upto = np.cumsum(share[order])
    wanted = upto[-1] * np.arange(1, pieces) / pieces
    return sorted(set(at[order][np.searchsorted(upto, wanted)].tolist()))


def in_pieces(rows: DataFrame, order: str) -> DataFrame:
    """``rows`` with ``_piece``: numbers of ranges of ``order``, a long, that hold about as many rows, however its values
    are spread. Reads that column once. Quantiles are merged in groups of tasks, so no task merges those of all others;
    the groups' quantiles, at most ``PIECES`` of each, reach the driver."""
    grid = F.lit(np.arange(1, PIECES) / PIECES)
    group = F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("g")
    told = rows.where(F.col(order).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(order, grid, F.lit(2 * PIECES)).alias("cuts")).collect()
    pieces = min(PIECES, -(-sum(r.n for r in told) // CHUNK))
    at = _pooled_cuts([(r.n, r.cuts) for r in told], pieces) if pieces > 1 else []
    if not at:
        return rows.withColumn("_piece", F.lit(0))
    # cuts in groups: a row is compared with one cut of each group, and with those of its own group
    size = math.isqrt(len(at) - 1) + 1
    groups = [at[i : i + size] for i in range(0, len(at), size)]
    below = lambda values: F.size(F.filter(values, lambda c: c < F.col(order)))
    group = below(F.lit(np.array([g[-1] for g in groups])))
    inside = F.try_element_at(F.array(*[F.lit(np.array(g)) for g in groups]), group + 1)
    return rows.withColumn("_piece", group * size + F.coalesce(below(inside), F.lit(0)))


def running(rows: DataFrame, order: str, columns: dict[str, tuple[Column, str]]) -> DataFrame:
    """``rows`` with, for each name of ``columns`` (value, "sum" or "max"), the sum or maximum of the value over all rows
    before one in ``order``, a unique long.

    Pieces of the order are windows of their own; they are computed in one pass, now, and kept in the shared folder. A
    table of a row for each piece carries over what is before it. So no task sorts the whole table, and the input is
    read twice: for the cuts, only its order, and for the pass.
    """
    total = {"sum": F.sum, "max": F.max}
    names = list(enumerate(columns.items()))
    inside = Window.partitionBy("_piece").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    cut = in_pieces(rows, order).withColumns({f"_v{i}": value for i, (_, (value, _)) in names})
    kept = checkpointed(cut.withColumns({f"_w{i}": total[how](f"_v{i}").over(inside) for i, (_, (_, how)) in names}))
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = kept.groupBy("_piece").agg(*(total[how](f"_v{i}").alias(f"_t{i}") for i, (_, (_, how)) in names))
    carried = pieces.select("_piece", *(total[how](f"_t{i}").over(before).alias(f"_c{i}") for i, (_, (_, how)) in names))

    def merged(i: int, how: str) -> Column:
        a, b = F.col(f"_c{i}"), F.col(f"_w{i}")
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)) if how == "sum" else F.coalesce(F.greatest(a, b), F.lit(0))

    joined = kept.join(F.broadcast(carried), "_piece")  # PIECES rows at most
    return joined.select(*rows.columns, *(merged(i, how).alias(name) for i, (name, (_, how)) in names))


def numbered(rows: DataFrame, order: Sequence[Column | str], out: str = "row_idx") -> tuple[DataFrame, int]:
    """(``rows`` with ``out``, their number): numbers from 0 without gaps, in ``order``; ties get some order.

    Rows are sorted by ranges and kept in the shared folder with their place in the range; a table of a row for each
    range has where it begins.
    """
    n = rows.select(F.lit(1)).count()
    placed = rows.repartitionByRange(max(1, min(PIECES, -(-n // CHUNK))), *order).sortWithinPartitions(*order)
    kept = checkpointed(placed.withColumns({"_piece": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    before = F.sum("_n").over(Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
    starts = kept.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n")).select("_piece", F.coalesce(before, F.lit(0)).alias("_before"))
    return kept.join(F.broadcast(starts), "_piece").select(*rows.columns, (F.col("_before") + F.col("_at")).alias(out)), n


def prefix_until(rows: DataFrame, order: str, fails: Column) -> DataFrame:
    """The rows before the first one (in ``order``) that fails. The other side of the join is a single row."""
    first = rows.where(F.coalesce(fails, F.lit(False))).agg(F.min(order).alias("_stop"))
    return rows.crossJoin(F.broadcast(first)).where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_stop")


def until_enough(rows: DataFrame, order: str, success: Column, most: int) -> DataFrame:
    """Rows with fewer than ``most`` successes before them; all of them if ``most`` is 0."""
    if not most:
        return rows
    counted = running(rows, order, {"_done": (F.coalesce(success, F.lit(False)).cast("long"), "sum")})
    return counted.where(F.col("_done") < most).drop("_done")


def percentile_slice(rows: DataFrame, order: Sequence[Column | str], skip: float, keep: float) -> DataFrame:
    """The rows from position int(n * skip / 100) on, int(n * keep / 100) of them, in ``order``: a filter on the numbers
    of ``numbered``, so that no task takes the slice."""
    placed, n = numbered(rows, order, "_at")
    start = min(n, int(n * skip / 100))
    count = max(0, min(n - start, int(n * keep / 100)))
    return placed.where((F.col("_at") >= start) & (F.col("_at") < start + count)).drop("_at")


def threshold_split(rows: DataFrame, value: str, least: int) -> tuple[DataFrame, DataFrame]:
    """(rows with at least ``least``, the others); a null counts as 0."""
    high = F.coalesce(F.col(value), F.lit(0)) >= least
    return rows.where(high), rows.where(~high)


def first_suffix(word: Column, suffixes: Sequence[str]) -> Column:
    """The first of ``suffixes`` that ends the word, or null."""
    return F.coalesce(*[F.when(word.endswith(s), F.lit(s)) for s in suffixes])


def top_n(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows in order, or all for 0."""
    ordered = rows.orderBy(*order)
    return ordered.limit(n) if n else ordered


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equal as bags of rows."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def chained(*frames: DataFrame) -> DataFrame:
    """All rows, with ``source_ord`` telling which frame they come from."""
    return reduce(DataFrame.unionByName, [f.withColumn("source_ord", F.lit(i)) for i, f in enumerate(frames)])


def batch_plan(rows: DataFrame, row_idx: str, size: int, start: int = 0) -> DataFrame:
    """(batch, words_start, words_end, words, total_processed) of the rows from ``start`` on, ``size`` to a batch."""
    cut = rows.where(F.col(row_idx) >= start).withColumn("batch", F.floor((F.col(row_idx) - start) / size))
    per = cut.groupBy("batch").agg(F.min(row_idx).alias("words_start"), F.max(row_idx).alias("words_end"), F.count(F.lit(1)).alias("words"))
    return running(per, "batch", {"_before": (F.col("words"), "sum")}).withColumn("total_processed", F.col("_before") + F.col("words")).drop("_before")
