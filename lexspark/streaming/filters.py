"""The stateless stages over files that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexspark.functions import tagexpr
from lexspark.sources import readers


def tagged_stream(spark: SparkSession, path: str) -> DataFrame:
    """(word, frequency, part_of_speech, tags, row_idx) of tagged lines of a folder, without header lines."""
    lines = spark.readStream.text(path).select(F.col("value").alias("line"), F.lit(1).alias("row_idx"))
    return readers.tagged_rows(lines.where(~F.col("line").startswith("word,")), header=False)


def filtered(rows: DataFrame, expression: str) -> DataFrame:
    """Rows, streaming or not, that a tag expression holds for."""
    tags = tagexpr.tag_set(F.col("part_of_speech"), F.col("tags"))
    return rows.where(tagexpr.compile_expression(expression, tags, F.col("word")))


def start(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what is there now and stops; a later call goes on behind it."""
    return rows.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
