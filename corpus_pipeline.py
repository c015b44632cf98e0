"""The corpus pipeline: quality, repeated lines, near duplicates, packing.

Each stage takes the documents that its predecessor kept, all of them; ``run`` chains the stages over the documents of
a folder. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm import line_dedup, minhash, packing, quality
from lexspark.llm._scratch import Scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is trained on documents labelled as good."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    return quality.keep_accepted(docs, trusted)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more have stay in the first of them only; n_chars follows the new text. Documents that
    this leaves without any text go; those that came so stay."""
    out = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1, keep_first=True)
    out = out.where(F.coalesce((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"), F.lit(True)))
    return out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words, similarity 0.8 or more) stays."""
    return minhash.drop_near_duplicates(docs, size=5, num=80, den=100).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its bin and place."""
    return packing.best_fit(docs, capacity=8192)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("minhash near-dedup", near_duplicate_stage),
    ("best-fit packing", packing_stage),
]

#: Scores of a language model, components and sequential packing have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's documents are written to the shared folder before the next one reads them."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
