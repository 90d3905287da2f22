"""Reports over runs: times by model and file, inputs without results, token usage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_model(runs: DataFrame) -> DataFrame:
    """runs, total and mean seconds by provider and model."""
    return runs.groupBy("provider", "model").agg(F.count("*").alias("runs"), F.sum("elapsed_seconds").alias("total_seconds"), (F.sum("elapsed_seconds").cast("double") / F.count("*")).alias("avg_seconds"))


def by_file(runs: DataFrame) -> DataFrame:
    return runs.select("source", "provider", "model", "elapsed_seconds").orderBy(F.lower("source"), "provider", "model")


def of_inputs(runs: DataFrame, inputs: DataFrame) -> DataFrame:
    """Runs whose source is an input, whatever the case."""
    return runs.join(inputs.select(F.lower("name").alias("_n")).distinct(), F.lower("source") == F.col("_n"), "left_semi")


def without_runs(inputs: DataFrame, runs: DataFrame) -> DataFrame:
    return inputs.join(runs.select(F.lower("source").alias("_n")).distinct(), F.lower("name") == F.col("_n"), "left_anti")


def usage_totals(usages: DataFrame) -> DataFrame:
    """Tokens by provider and model; a total of 0 is prompt and completion together."""
    s = usages.groupBy("provider", "model").agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")])
    return s.withColumn("total_tokens", F.when(F.col("total_tokens") == 0, F.col("prompt_tokens") + F.col("completion_tokens")).otherwise(F.col("total_tokens")))
