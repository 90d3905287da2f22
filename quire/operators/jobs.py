"""Which files belong together: documents, tables of contents, chunks and parsed texts, by their names, newest first.

Files are rows (path, name, stem, modified) and what their contents say; names are compared as document keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, document_key


def stem_of(path: Column) -> Column:
    """The last part of a path without its suffix."""
    return F.regexp_replace(F.element_at(F.split(path, r"[/\\]"), -1), r"(?<=.)\.[^.]*$", "")


def kind_of(name: Column) -> Column:
    """parsed, text, chunk or reference; null for other files. A text that isn't called parsed stands in where none is."""
    n = F.lower(name)
    stem = F.regexp_replace(n, r"\.[^.]*$", "")
    text, json = n.endswith(".txt"), n.endswith(".json")
    known = stem.contains("toc") | stem.contains("reference")
    return F.when(text & stem.contains("parsed"), "parsed").when(text, "text").when(json & known, "reference").when(json & stem.contains("chunk"), "chunk")


def _newest(*fields: str) -> Column:
    return F.max_by(F.struct(*fields), F.struct("modified", "name", "path"))


def discover(files: DataFrame, kind: str, hint: str | None = None) -> DataFrame:
    """The one file of a kind in each folder (dir); folders with several or none are left out.

    Of references, those of first chunks count before others, the newest one; with a hint only those whose name begins as it.
    """
    f = files.withColumn("kind", kind_of(F.col("name")))
    if kind == "parsed":
        f = f.where(F.col("kind").isin("parsed", "text")).withColumn("rank", F.when(F.col("kind") == "parsed", 0).otherwise(1))
    else:
        f = f.where(F.col("kind") == kind).withColumn("rank", F.lit(0))
    if kind == "reference":
        first = F.lower("stem").endswith("_chunk1")
        f = f.withColumn("rank", F.when(first, 0).otherwise(1))
        if hint:
            f = f.where(~first | document_key("stem").startswith(document_key(F.lit(hint))))
    best = f.groupBy("dir").agg(F.min("rank").alias("rank"))
    chosen = f.join(best, ["dir", "rank"]).groupBy("dir", "rank").agg(F.count("*").alias("n"), _newest("path", "name").alias("m"))
    some = F.col("n") == 1
    if kind == "reference":
        some = some | (F.col("rank") == 0)
    return chosen.where(some).select("dir", "m.*")


def match_documents(sources: DataFrame, documents: DataFrame) -> DataFrame:
    """sources (path, names array) with the document (doc_path, doc_stem) whose key begins one of their names' keys; the longest key, then the greatest path.

    Every beginning of a name is a join key: an equi-join, not a comparison of all with all. Of documents of one key only the greatest path
    can count, and names that are equal are looked up once, so a row for each is all that meets.
    """
    d = documents.select(F.col("path").alias("doc_path"), F.col("stem").alias("doc_stem"), document_key("stem").alias("_key")).where("_key <> ''")
    d = d.groupBy("_key").agg(F.max_by(F.struct("doc_path", "doc_stem"), "doc_path").alias("d"))
    names = sources.select("path", F.explode("names").alias("_n")).select("path", document_key(stem_of(F.col("_n"))).alias("_n")).where("_n <> ''").distinct()
    begin = F.explode(F.transform(F.sequence(F.lit(1), F.char_length("_n")), lambda k: F.substring(F.col("_n"), F.lit(1), k)))
    best = lambda n: F.max_by("d", F.struct(n, F.col("d.doc_path")))
    known = names.select("_n").distinct().select("_n", begin.alias("_key")).join(d, "_key").groupBy("_n").agg(best(F.char_length("_key")).alias("d"), F.max(F.char_length("_key")).alias("_size"))
    return names.join(known, "_n").groupBy("path").agg(best(F.col("_size")).alias("m")).select("path", "m.*")


def choose_source(candidates: DataFrame, entries: DataFrame, start: int, end: int) -> DataFrame:
    """For each document (doc_path) the table of candidates (doc_path, path, name, modified) that has entries (path, page) in
    the range: the newest of those that reach its end, else the one that goes furthest. max_page tells how far."""
    pages = entries.withColumn("page", F.coalesce(F.col("page").try_cast("int"), F.lit(0)))
    facts = pages.groupBy("path").agg(F.max("page").alias("max_page"), F.bool_or(F.col("page").between(start, end)).alias("inside"))
    j = candidates.join(facts.where("inside"), "path")
    reaches = F.col("max_page") >= end
    best = F.max_by(F.struct("path", "max_page"), F.struct(reaches, F.when(~reaches, F.col("max_page")).otherwise(0), "modified", "name", "path"))
    return j.groupBy("doc_path").agg(best.alias("m")).select("doc_path", "m.*")


def trim_to_range(entries: DataFrame, start: int, end: int, *, strict: bool = False) -> DataFrame:
    """entries whose page is in the range; a page that is no number is an error if strict, else it goes."""
    page = F.col("page").try_cast("int")
    if strict:
        page = F.coalesce(page, F.raise_error(F.concat(F.lit("page must be an integer: "), F.coalesce(F.col("page").cast("string"), F.lit("none")))).cast("int"))
    return entries.withColumn("page", page).where(F.col("page").between(start, end))


def chunk_range(chunks: DataFrame) -> DataFrame:
    """(doc, start_page, end_page) over chunks (doc, name, start_page, end_page): what they say, else what their names do."""
    named = lambda k: F.nullif(F.regexp_extract("name", r"pages_(\d+)_(\d+)", k), F.lit("")).try_cast("int")
    c = chunks.select("doc", F.coalesce(F.col("start_page").try_cast("int"), named(1)).alias("a"), F.coalesce(F.col("end_page").try_cast("int"), named(2)).alias("b"))
    return c.where("a >= 1 and b >= a").groupBy("doc").agg(F.min("a").alias("start_page"), F.max("b").alias("end_page"))


def source_name(source_input: Column, title: Column, path: Column) -> Column:
    """The document that a reference is of: by its own record, else its title, else its file."""
    own = F.nullif(clean_text(source_input), F.lit(""))
    return F.coalesce(stem_of(own), F.nullif(clean_text(title), F.lit("")), stem_of(path))


def resolve(references: DataFrame, chunks: DataFrame, parsed: DataFrame) -> DataFrame:
    """(reference, chunk, parsed) for references (path, source_input, title, run): the newest chunk (path, name, modified, run, source_pdf)
    of the run they name, else of the same document; its parsed text (path, name, modified, run) is that of the chunk's run, else of a document whose name begins as it."""
    r = references.select(F.col("path").alias("reference"), F.element_at(F.split("run", r"[/\\]"), -1).alias("run"), document_key(source_name(F.col("source_input"), F.col("title"), F.col("path"))).alias("_key"))
    c = chunks.select("path", "name", "modified", "run", F.nullif(clean_text("source_pdf"), F.lit("")).alias("source")).withColumn("_key", document_key(stem_of(F.col("source"))))
    # What a run, a document or a name's beginning has is one newest row, before anything meets it: groups are as large as they like.
    newest = lambda rows, by, order, *fields: rows.groupBy(by).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("m"), F.max(F.struct(*order)).alias("o"))
    pick = F.max_by("m", "o").alias("m")
    own = r.join(newest(c, "run", ["modified", "name"], "path", "run", "source"), "run").groupBy("reference").agg(pick)
    same = r.join(own.select("reference"), "reference", "left_anti").join(newest(c.where("_key <> ''"), "_key", ["modified", "name"], "path", "run", "source"), "_key").groupBy("reference").agg(pick)
    found = own.unionByName(same).select("reference", F.col("m.path").alias("chunk"), F.col("m.run").alias("run"), F.coalesce(stem_of(F.col("m.source")), F.col("m.run")).alias("_source"))
    p = parsed.select("path", "name", "modified", "run", document_key(stem_of(F.col("name"))).alias("_text"))
    order = ["modified", "name", "path"]
    exact = found.join(newest(p, "run", order, "path", "name"), "run").groupBy("reference", "chunk").agg(pick)
    rest = found.join(exact.select("reference"), "reference", "left_anti").withColumn("_key", document_key("_source")).where("_key <> ''")
    begin = F.explode(F.transform(F.sequence(F.lit(1), F.char_length("_text")), lambda k: F.substring(F.col("_text"), F.lit(1), k)))
    like = rest.join(newest(p.where("_text <> ''").withColumn("_key", begin), "_key", order, "path", "name"), "_key").groupBy("reference", "chunk").agg(pick)
    return exact.unionByName(like).select("reference", "chunk", F.col("m.path").alias("parsed"))
