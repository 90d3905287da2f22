"""Documents to packed sequences: rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import line_dedup, mixing, near_dedup, packing, quality_rules
from quire.llm.common import Workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the rules."""
    return quality_rules.quality_filter(spark, docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document of smaller id has; n_chars follows."""
    return line_dedup.dedup_columns(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(spark, docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that calibrated probabilities keep."""
    return mixing.sample(spark, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack_documents(spark, docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near dedup", near), ("mixing", mixture), ("packing", packed)]

#: SQL can express neither MinHash groups nor raking nor the tokenizer: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order on documents. A stage's table goes when the next one is written."""
    ws = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        done = docs
        docs = ws.write(stage(spark, done, sf_dir), name.replace(" ", "-"))
        if name != STAGES[0][0]:
            ws.done(done)
    packed = STAGES[-1][1](spark, docs, sf_dir)  # the pieces are written by now
    ws.done(docs)
    return packed
