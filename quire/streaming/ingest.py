"""Layout lines from a folder of documents as they come, and running style counts over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.lines import STYLE, cluster_key
from ..sources.layout import html_lines


def page_stream(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """Pages of Parquet files as they are added to a folder."""
    return spark.readStream.schema("page_id long, url string, html string").option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def style_counts(pages: DataFrame) -> DataFrame:
    """How many lines each style has so far; state grows with the styles, not the lines."""
    return cluster_key(html_lines(pages)).groupBy(*STYLE).count()


def start(counts: DataFrame, table: str, checkpoint: str):
    """Runs what is there and ends; started again, it goes on where it was."""
    return counts.writeStream.outputMode("complete").format("memory").queryName(table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
