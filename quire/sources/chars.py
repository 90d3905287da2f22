"""Layout lines from characters: a reader's table (doc_id, page, line, n, text, size, x0, top, fontname) and its pages (doc_id, page, width, height).

What a reader gives is characters; lines, sizes, fonts and columns are aggregations over them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_extracted, clean_text, font_bold, font_italic, font_name

#: Shapes of headings, lines of authors, what tells of explanations.
HEADING_SHAPES = [
    r"(?i)^CHAPTER(?:\s+\d+)?$", r"(?i)^SECTION(?:\s+\d+)?$", r"^\d{1,3}\s+[가-힣A-Za-z]", r"^\d{1,3}\.\s*[가-힣A-Za-z]", r"^\d{1,3}\)\s*[가-힣A-Za-z]", r"^\(\d{1,3}\)\s*[가-힣A-Za-z]",
    r"^[①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳]\s*[가-힣A-Za-z]", r"^[가-힣]\.\s*[가-힣A-Za-z]", r"^[A-Z]\.\s+[A-Za-z가-힣]",
]
AUTHORS = r"^[가-힣]{2,4}(?:,\s*[가-힣]{2,4})+(?:\s*\(.+\))?$"
DELIMITERS = [":", "：", " - ", " – ", " — "]
PROSE = ["한다", "된다", "있다", "없다", "이며", "이고", "하고", "하며", "에서", "에게", "으로", "로서", "because", "which", "that", "with", "without", "patients", "disease", "syndrome"]
#: Characters a side that make a page one of two columns, and their least share.
SIDE, SHARE = 80, 0.25


def body_sizes(chars: DataFrame) -> DataFrame:
    """(doc_id, page, body_size): the median size of a page's visible characters, 10 if there are none."""
    size = F.percentile(F.when(clean_text("text") != "", F.col("size")), 0.5)
    return chars.groupBy("doc_id", "page").agg(F.coalesce(F.nullif(size, F.lit(0.0)), F.lit(10.0)).alias("body_size"))


def two_columns(chars: DataFrame, pages: DataFrame, split: float | None = None) -> DataFrame:
    """(doc_id, page, two): whether enough characters stand on either side of the page's middle (or of split)."""
    c = chars.where(clean_text("text") != "").join(pages.select("doc_id", "page", "width"), ["doc_id", "page"])
    at = F.col("width") / 2 if split is None else F.lit(split)
    left, right = F.count(F.when(F.col("x0") < at - 20, 1)), F.count(F.when(F.col("x0") > at + 20, 1))
    n = c.groupBy("doc_id", "page").agg(F.count("*").alias("n"), left.alias("l"), right.alias("r"))
    both = F.greatest(F.lit(1), F.col("l") + F.col("r"))
    two = (F.col("n") >= 2 * SIDE) & (F.col("l") >= SIDE) & (F.col("r") >= SIDE) & (F.col("l") / both >= SHARE) & (F.col("r") / both >= SHARE)
    return pages.select("doc_id", "page").join(n.select("doc_id", "page", two.alias("two")), ["doc_id", "page"], "left").withColumn("two", F.coalesce("two", F.lit(False)))


def dominant(values: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """keys with the most frequent non-empty value of each, the first seen of equal ones."""
    v = values.select(*keys, clean_text(value).alias("v"), order).where("v <> ''")
    n = v.groupBy(*keys, "v").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return n.groupBy(*keys).agg(F.max_by("v", F.struct("n", -F.col("first"))).alias(value))


def layout_lines(chars: DataFrame, pages: DataFrame, *, columns: str = "auto", split: float | None = None, gap: float = 8.0) -> DataFrame:
    """Lines: doc_id, page, source_order, column, s, r, x, y, b, i, f, fontname, text, in the order left column, right column, line.

    Size is the median, position the least, font the dominant one of a line's characters; f numbers a document's fonts in
    the order in which lines use them (f0: none). columns: auto, two or none; what stands in the gap belongs to neither.
    """
    c = chars.join(pages.select("doc_id", "page", "width"), ["doc_id", "page"])
    at = F.col("width") / 2 if split is None else F.lit(split)
    if columns == "auto":
        c = c.join(two_columns(chars, pages, split), ["doc_id", "page"])
    else:
        c = c.withColumn("two", F.lit(columns == "two"))
    side = F.when(~F.col("two"), "").when(F.col("x0") < at - gap / 2, "L").when(F.col("x0") >= at + gap / 2, "R")
    c = c.withColumn("column", side).where("column is not null")
    keys = ["doc_id", "page", "column", "line"]
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda v: v["text"]), "")
    lines = c.groupBy(*keys).agg(F.percentile("size", 0.5).alias("s"), F.min("x0").alias("x"), F.min("top").alias("y"), clean_extracted(text).alias("text")).where("text <> ''")
    lines = lines.join(dominant(c, keys, "fontname", "n"), keys, "left").join(body_sizes(chars), ["doc_id", "page"])
    by_page = Window.partitionBy("doc_id", "page").orderBy("column", "line")
    lines = lines.withColumn("source_order", F.row_number().over(by_page)).withColumn("_font", font_name(F.coalesce("fontname", F.lit(""))))
    first = lines.where("_font <> ''").groupBy("doc_id", "_font").agg(F.min(F.struct("page", "source_order")).alias("_first"))
    number = first.withColumn("f", F.concat(F.lit("f"), F.row_number().over(Window.partitionBy("doc_id").orderBy("_first")).cast("string"))).drop("_first")
    lines = lines.join(number, ["doc_id", "_font"], "left")
    return lines.select(
        "doc_id", "page", "source_order", F.nullif("column", F.lit("")).alias("column"), "s", (F.col("s") / F.col("body_size")).alias("r"), "x", "y",
        font_bold("fontname").alias("b"), font_italic("fontname").alias("i"), F.coalesce("f", F.lit("f0")).alias("f"), "fontname", "text", "body_size",
    )


def is_heading_like(text: Column, size: Column, ratio: Column, bold: Column, body: Column, *, most: int = 140, authors: bool = True, body_lines: bool = True, tolerance: float = 0.08) -> Column:
    """Whether a line is kept when only headings are: numbered, or larger than the body, or bold; no authors, no lines in the body's size."""
    t = clean_text(text)
    shaped = t.rlike("|".join(f"(?:{p})" for p in HEADING_SHAPES))
    n = F.char_length(t)
    drop = (t == "") | (F.lit(authors) & t.rlike(AUTHORS)) | (F.lit(body_lines) & (F.abs(ratio - 1.0) <= max(0.0, tolerance)))
    styled = (ratio >= 1.25) | ((bold != 0) & (ratio >= 0.95) & (n <= 80)) | ((body != 0) & (size >= body + 2.0) & (n <= 120))
    return F.coalesce(~drop & (n <= most) & (shaped | styled), F.lit(False))


def is_explanation(text: Column) -> Column:
    """A term, a delimiter and prose after it."""
    t = clean_text(text)
    out = F.lit(False)
    for d in DELIMITERS:
        at = F.instr(t, d)
        before, after = F.trim(F.substring(t, F.lit(1), at - 1)), F.trim(F.substring(t, at + len(d), F.char_length(t)))
        prose = F.exists(F.array(*[F.lit(w) for w in PROSE]), lambda w: F.lower(after).contains(w))
        out = out | ((at > 0) & (F.char_length(before) >= 2) & (F.char_length(after) >= 8) & (prose | ((F.char_length(after) >= 16) & after.rlike(r"[가-힣]{2,}"))))
    return out


def headings_only(lines: DataFrame, **options) -> DataFrame:
    """The lines that are heading-like, their body size taken from size and ratio as a rendered line has them."""
    size, ratio = F.round("s", 1), F.round("r", 2)
    return lines.where(is_heading_like(F.col("text"), size, ratio, F.col("b"), F.when(ratio != 0, size / ratio).otherwise(size), **options))


def tag(column: Column | None = None, order: Column | None = None) -> Column:
    """A line in the lower-case grammar, with its column and its place if given."""
    number = F.lit("") if order is None else F.concat(F.lit("source_order="), order.cast("string"), F.lit(" "))
    side = F.lit("") if column is None else F.coalesce(F.concat(F.lit(" c="), column), F.lit(""))
    head = F.format_string("s=%.1f r=%.2f x=%.0f y=%.0f b=%d i=%d f=%s", *[F.bround(F.col(c).cast("double"), k) for c, k in (("s", 1), ("r", 2), ("x", 0), ("y", 0))], F.col("b").cast("int"), F.col("i").cast("int"), F.col("f"))
    return F.concat(F.lit("[L "), number, head, side, F.lit("] "), F.col("text"))


def page_texts(lines: DataFrame, line: Column) -> DataFrame:
    """(doc_id, page, text): a page's lines in order, one a row of text."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_order", line.alias("t")))), lambda v: v["t"]), "\n")
    return lines.groupBy("doc_id", "page").agg(body.alias("text"))


def typed_pages(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, page_count, line_count, pages): pages as nested structs with their lines, sizes to 3 places, positions to 1."""
    line = F.struct("source_order", F.round("s", 3).alias("s"), F.round("r", 3).alias("r"), F.round("x", 1).alias("x"), F.round("y", 1).alias("y"), "b", "i", font_name("fontname", 40).alias("f"), clean_text("text").alias("text"))
    per = lines.groupBy("doc_id", "page").agg(F.first("body_size").alias("body_size"), F.array_sort(F.collect_list(line)).alias("lines"))
    p = pages.join(per, ["doc_id", "page"], "left").select("doc_id", F.struct("page", "width", "height", F.round(F.coalesce("body_size", F.lit(10.0)), 3).alias("body_size"), F.coalesce("lines", F.array().cast(per.schema["lines"].dataType)).alias("lines")).alias("p"))
    t = p.groupBy("doc_id").agg(F.array_sort(F.collect_list("p")).alias("pages"))
    return t.select("doc_id", F.size("pages").alias("page_count"), F.aggregate("pages", F.lit(0), lambda n, q: n + F.size(q["lines"])).alias("line_count"), "pages")


def upper_text(typed: DataFrame) -> DataFrame:
    """(doc_id, text): typed_pages in the upper-case grammar."""
    line = lambda p: lambda v: F.concat(F.format_string("[L P=%d O=%d S=%.2f R=%.3f X=%.1f Y=%.1f B=%d I=%d F=%s] ", p["page"], v["source_order"], v["s"], v["r"], v["x"], v["y"], v["b"], v["i"], v["f"]), v["text"])
    page = lambda p: F.concat(F.array(F.format_string("[PAGE P=%d W=%.1f H=%.1f BODY=%.2f]", p["page"], p["width"], p["height"], p["body_size"])), F.transform(p["lines"], line(p)))
    return typed.select("doc_id", F.concat(F.array_join(F.flatten(F.transform("pages", page)), "\n"), F.lit("\n")).alias("text"))
