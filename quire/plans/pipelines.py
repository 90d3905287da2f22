"""Whole queries: from pages or lines to tables of contents, without a model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.fragments import build_chapters
from ..operators.lines import body_size, candidates, gaps, score
from ..operators.rules import apply_rules, learn_rules
from ..sources.layout import html_lines, layout_texts, parse_layout


def rule_toc(pages: DataFrame) -> DataFrame:
    """Rules learned from the pages' h1 lines, applied to all lines."""
    lines = html_lines(pages).withColumn("page", F.lit(1))
    reference = lines.where("tag = 'h1'").select("doc_id", F.lit(1).alias("level"), F.col("text").alias("chapter"), F.col("source_order").alias("pos"), "page")
    return apply_rules(lines, learn_rules(reference, lines))


def scored_lines(lines: DataFrame, *, width: float = 595.0, height: float = 842.0) -> DataFrame:
    """Styled lines with geometry, gaps, their document's body size and heading score."""
    d = lines.withColumns({
        "page_height": F.lit(height), "page_width": F.lit(width), "y0": F.col("y"), "y1": F.col("y") + F.col("s"), "x0": F.col("x"), "x1": F.least(F.lit(width - 35), F.col("x") + F.char_length("text") * F.col("s") / 2), "rel_y0": F.col("y") / height,
    })
    return score(gaps(d).join(body_size(lines), "doc_id"))


def heuristic_toc(lines: DataFrame, titles: DataFrame, *, least: float = 7.5, max_depth: int = 4) -> DataFrame:
    """Styled lines to a table of contents without a model: scored, the best of each title, labels and cut titles put together, levels
    by number and type size, finished. titles: doc_id, title."""
    best = candidates(scored_lines(lines), least).drop("body_size")
    best = best.withColumn("pos", F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "y0", "x0", "line_index")))
    return build_chapters(best, titles, body_size(lines), max_depth)


def layout_lines_of(spark: SparkSession, path: str) -> DataFrame:
    """The lines of whole text files in a layout grammar."""
    return parse_layout(layout_texts(spark, path))
