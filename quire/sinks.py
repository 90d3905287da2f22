"""What a run leaves behind: results with their provenance, parsed texts, chunks, events of stages, errors, summaries."""

from __future__ import annotations

import logging
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .functions.text import clean_text, elapsed_text, safe_name

LOG = logging.getLogger("quire")


def results(toc: DataFrame, meta: DataFrame) -> DataFrame:
    """(doc_id, json): one object a document with title, chapters in order and _meta.

    toc: doc_id, pos, level, chapter, page, level_reason; meta: doc_id, title, source_pdf, provider, model, started_at, completed_at, elapsed_seconds and more,
    all of which _meta has, with the seconds to 3 places and in words.
    """
    chapter = F.struct("level", "chapter", "page", F.nullif(clean_text("level_reason"), F.lit("")).alias("level_reason"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("pos", chapter.alias("c")))), lambda v: v["c"])
    t = toc.groupBy("doc_id").agg(rows.alias("chapters"))
    extra = [c for c in meta.columns if c not in ("doc_id", "title", "elapsed_seconds")]
    seconds = F.round(F.col("elapsed_seconds").cast("double"), 3)
    own = F.struct(*extra, seconds.alias("elapsed_seconds"), elapsed_text(F.col("elapsed_seconds")).alias("elapsed"))
    none = F.array().cast(t.schema["chapters"].dataType)
    return meta.join(t, "doc_id", "left").select("doc_id", F.to_json(F.struct("title", F.coalesce("chapters", none).alias("chapters"), own.alias("_meta"))).alias("json"))


def parsed_texts(pages: DataFrame, files: DataFrame) -> DataFrame:
    """(doc_id, text): pages (doc_id, page, text) under their heads, after what files (doc_id, source_pdf, processed_pdf, metadata map) tell."""
    page = F.concat(F.lit("[PAGE "), F.col("page").cast("string"), F.lit("]\n"), F.coalesce("text", F.lit("")))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", page.alias("t")))), lambda v: v["t"]), "\n\n")
    pairs = F.array_sort(F.map_entries("metadata"))
    told = F.concat(F.lit("{"), F.array_join(F.transform(pairs, lambda e: F.concat(F.lit('"'), e["key"], F.lit('": "'), e["value"], F.lit('"'))), ", "), F.lit("}"))
    head = F.concat(F.lit("# Parsed PDF Text\nsource_pdf: "), F.coalesce("source_pdf", "processed_pdf"), F.lit("\nprocessed_pdf: "), F.col("processed_pdf"), F.lit("\nextraction_metadata: "), told, F.lit("\n\n"))
    j = files.join(pages.groupBy("doc_id").agg(body.alias("body")), "doc_id", "left")
    return j.select("doc_id", F.concat(F.rtrim(F.concat(head, F.coalesce("body", F.lit("")))), F.lit("\n")).alias("text"))


def chunk_payloads(chunks: DataFrame) -> DataFrame:
    """(doc_id, chunk, name, json): each chunk (doc_id, chunk, total, start_page, end_page, text) as it was sent, under a name that tells its pages."""
    name = F.format_string("chunk_%s_pages_%s_%s.json", F.col("chunk").cast("string"), F.col("start_page").cast("string"), F.col("end_page").cast("string"))
    body = F.to_json(F.struct(F.lit("input_chunk").alias("stage"), "chunk", F.col("total").alias("total_chunks"), "start_page", "end_page", F.char_length("text").alias("input_chars"), "text"))
    return chunks.select("doc_id", "chunk", name.alias("name"), body.alias("json"))


def stage_events(events: DataFrame) -> DataFrame:
    """events (doc_id, run, at, stage, payload and more) with stage_index, their place in the run."""
    w = Window.partitionBy("doc_id", "run").orderBy("at", "stage")
    return events.withColumn("stage_index", F.row_number().over(w))


def errors(answers: DataFrame) -> DataFrame:
    """(doc_id, chunk, error_kind, error): the rows of answers that failed, told apart by what would help."""
    from .operators.models import CONFIGURATION, REQUEST, RETRYABLE

    e = F.upper("error")
    has = lambda marks: F.exists(F.array(*[F.lit(m) for m in marks]), lambda m: e.contains(m))
    kind = F.when(has(CONFIGURATION), "configuration").when(has(REQUEST), "request").when(has(RETRYABLE), "temporary").otherwise("other")
    return answers.where("error is not null").select("doc_id", "chunk", kind.alias("error_kind"), "error")


def review_summary(counts: DataFrame) -> DataFrame:
    """One row over review.change_counts: documents that changed, and what changed in all."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("level_change_count", "added_count", "removed_count")]
    return counts.agg(F.count("*").alias("documents"), *sums)


def trimmed_results(toc: DataFrame, ranges: DataFrame) -> DataFrame:
    """Entries within their document's range (doc_id, start_page, end_page), with how many there were (source_chapter_count) and are (chapter_count)."""
    j = toc.join(ranges, "doc_id")
    w = Window.partitionBy("doc_id")
    inside = F.col("page").between(F.col("start_page"), F.col("end_page"))
    j = j.withColumns({"source_chapter_count": F.count("*").over(w), "chapter_count": F.count(F.when(inside, 1)).over(w)})
    return j.where(inside)


def result_name(stem: Column, label: Column, stamp: Column, suffix: str = "_toc.json") -> Column:
    """stem_label_stamp and a suffix, each part safe for a file's name."""
    return F.concat(F.concat_ws("_", stem, safe_name(label), stamp), F.lit(suffix))


def ascii_name(stem: Column) -> Column:
    """A file's name for an upload: only ASCII, input_pdf if nothing is left."""
    return F.concat(safe_name(stem, "input_pdf"), F.lit(".pdf"))


def unique_names(names: DataFrame, name: str = "name") -> DataFrame:
    """names with the second of equal ones as name_2, the third as name_3, before the suffix; order: the column n."""
    k = F.row_number().over(Window.partitionBy(name).orderBy("n"))
    numbered = F.concat(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit("_"), F.col("_k").cast("string"), F.regexp_extract(name, r"(\.[^.]*)$", 1))
    return names.withColumn("_k", k).withColumn(name, F.when(F.col("_k") == 1, F.col(name)).otherwise(numbered)).drop("_k")


def table_text(rows: DataFrame, order: str) -> DataFrame:
    """(text): rows as one text table of columns as wide as their longest value, in order of a column; the rows are few."""
    cols = [c for c in rows.columns if c != order]
    wide = rows.agg(*[F.greatest(F.lit(len(c)), F.coalesce(F.max(F.char_length(F.col(c).cast("string"))), F.lit(0))).alias(f"w_{c}") for c in cols])
    cell = lambda v, c: F.rpad(F.coalesce(v.cast("string"), F.lit("")), F.col(f"w_{c}"), F.lit(" "))
    line = F.rtrim(F.concat_ws("  ", *[cell(F.col(c), c) for c in cols]))
    body = rows.crossJoin(F.broadcast(wide)).groupBy(*[f"w_{c}" for c in cols]).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line.alias("t")))), lambda v: v["t"]), "\n").alias("body"))
    head = F.rtrim(F.concat_ws("  ", *[cell(F.lit(c), c) for c in cols]))
    rule = F.concat_ws("  ", *[F.repeat(F.lit("-"), F.col(f"w_{c}").cast("int")) for c in cols])
    return body.select(F.concat_ws("\n", head, rule, "body").alias("text"))


def save(df: DataFrame, path: str, *, kind: str = "json", by: str | None = None, mode: str = "errorifexists") -> None:
    """A table of texts or JSON objects (last column) at path, partitioned by a column; a path that exists is an error, so runs don't meet."""
    value = df.columns[-1]
    out = df.select(*([by] if by else []), F.col(value).alias("value"))
    out.write.mode(mode).partitionBy(*([by] if by else [])).text(path)
    LOG.info("%s written as %s", path, kind)


class RunLog(logging.Handler):
    """Copies the package's log lines to a file of the run, each with its time."""

    def __init__(self, path: str):
        super().__init__()
        self.path = Path(path)
        self.path.parent.mkdir(parents=True, exist_ok=True)
        self.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))

    def emit(self, record: logging.LogRecord) -> None:
        with self.path.open("a", encoding="utf-8") as f:
            f.write(self.format(record) + "\n")
