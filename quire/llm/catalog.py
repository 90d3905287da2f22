"""The queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import html_text, line_dedup, media, mixing, near_dedup, packing, pii, quality_model, quality_rules, suffix_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op2_html_text": html_text.op2_html_text,
        "op3_quality_rules": quality_rules.op3_quality_rules,
        "op4_pii": pii.op4_pii,
        "op5_media_columns": media.op5_media_columns,
        "op6_quality_model": quality_model.op6_quality_model,
        "op7_mixing": mixing.op7_mixing,
        "op8_packing": packing.op8_packing,
        "op9_near_dedup": near_dedup.op9_near_dedup,
        "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.SQL,
        "op3_quality_rules": quality_rules.SQL,
    }
