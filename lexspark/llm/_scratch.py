"""Intermediate tables in the folder that the whole cluster shares.

``spark.checkpoint.dir`` names that folder. A table written there cuts the lineage and outlives every executor. Only
where the setting is missing (a local session, as in tests) a folder of this machine is used instead.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Holds a session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def merging(spark: SparkSession):
    """In this block plans take the files of sorted buckets as sorted."""
    return setting(spark, "spark.sql.legacy.bucketedTableScan.outputOrdering", "true")


_roots: list[str] = []


def remove_all(spark: SparkSession) -> int:
    """Deletes the folders of all operators that this program has run, and says how many: for when results are written, as
    an operator's result may read them until then."""
    gone, conf = 0, spark._jsc.hadoopConfiguration()
    while _roots:
        path = spark._jvm.org.apache.hadoop.fs.Path(_roots.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


class Scratch:
    """Writes tables below one folder of its own and can drop them again."""

    def __init__(self, spark: SparkSession, name: str):
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
            root = tempfile.mkdtemp(prefix="lexspark-")
        self.spark = spark
        self.root = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        _roots.append(self.root)
        self.count, self.tables = 0, []

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def write(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Runs ``df`` now, keeps its rows as Parquet and returns a frame that reads them; its shuffle files go at once."""
        path = self.path(name)
        with setting(self.spark, CLEANUP, "true"):
            df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def write_sorted(self, df: DataFrame, name: str, by: list[str], partition_by: tuple[str, ...] = (), buckets: int | None = None) -> DataFrame:
        """Like ``write``, but in buckets by hash of the columns ``by``, each bucket (of each value of ``partition_by``) one
        file that is sorted by them. Joins of such tables on ``by`` merge them without a shuffle, and in a block of
        ``merging`` without a sort.

        ``df`` should come from a shuffle by these columns, so that each bucket is in one task. Buckets are those of the
        session's shuffle, if no number is given. Spark knows buckets of tables of its catalog only; ``drop`` removes the name too.
        """
        path, table = self.path(name), f"{name}_{uuid.uuid4().hex}"
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, *by).sortBy(*by)
        self.tables.append(table)
        with setting(self.spark, CLEANUP, "true"), merging(self.spark):
            (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
        out = self.spark.table(table)
        out._scratch_path, out._scratch_table = path, table
        return out

    @contextmanager
    def guarded(self) -> Iterator[None]:
        """A block that leaves neither names in the catalog nor files behind if it fails."""
        try:
            yield
        except BaseException:
            for table in self.tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
            root.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(root, True)
            raise

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that no pending result reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for table in tables:
            if hasattr(table, "_scratch_table"):
                self.spark.sql(f"DROP TABLE IF EXISTS {table._scratch_table}")
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(conf).delete(path, True)


def small(df: DataFrame, most_rows: int) -> DataFrame:
    """A broadcast hint, but only after a count has shown that ``df`` (a written table) has at most ``most_rows`` rows.

    Above that the frame comes back as it is and Spark joins it by a shuffle.
    """
    return F.broadcast(df) if df.count() <= most_rows else df


#: A key with a larger share of all rows than one in this many is heavy: at most this many keys can be.
HEAVY = 4096
#: Rows up to which no key is heavy.
LIGHT = 10_000


def key_counts(table: DataFrame, size: str) -> tuple[int, int]:
    """(rows of all keys, most rows of a key) of a table for ``hot_join``."""
    total, most = table.agg(F.sum(size), F.max(size)).first()
    return total or 0, most or 0


def hot_join(rows: DataFrame, table: DataFrame, on: list[str], size: str, least: int = LIGHT, counts: tuple[int, int] | None = None) -> DataFrame:
    """The inner join of ``rows`` with ``table``, which has each key once and in ``size`` how many of the rows have it.

    Rows of heavy keys stay where they are: the table's few rows for these are broadcast. All others are shuffled by
    key, of which none has more than its share. Both frames are read twice where there are heavy keys, so they should
    be written tables. Keys are not null. ``counts`` are the table's ``key_counts``, where the caller has them.
    """
    total, most = counts or key_counts(table, size)
    cut = max(least, total // HEAVY + 1)
    if most < cut:
        return rows.join(table, on)
    heavy = F.broadcast(table.where(F.col(size) >= cut))
    rest = rows.join(heavy.select(*on), on, "left_anti")
    return rows.join(heavy, on).unionByName(rest.join(table.where(F.col(size) < cut), on))
