"""Layout lines from texts in the layout grammars, from plain documents and from web pages; and file catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import clean_text

#: Lines of a plain document that make a page.
PAGE_LINES = 20


def catalogue(spark: SparkSession, path: str, *, suffix: str = "pdf", contains: list[str] | None = None) -> DataFrame:
    """path, name, stem, modificationTime and length of the files below a folder, whatever their suffix's case."""
    glob = "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).drop("content")
    files = files.withColumn("name", F.element_at(F.split("path", "/"), -1)).withColumn("stem", F.regexp_replace("name", r"\.[^.]*$", ""))
    for term in contains or []:
        files = files.where(F.lower("path").contains(term.lower()))
    return files


def newest(files: DataFrame, *by: str) -> DataFrame:
    """The newest file of each key, by time, then name."""
    best = F.max_by(F.struct("path", "name"), F.struct("modificationTime", "name")).alias("file")
    return files.groupBy(*by).agg(best).select(*by, "file.*")


def layout_texts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text) of whole text files."""
    return spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("doc_id"), F.col("value").alias("text"))


def _tag(line: Column, key: str) -> Column:
    """The value of key in a line's tag, lower- or upper-case."""
    return F.nullif(F.regexp_extract(line, rf"^\[L [^\]]*(?<![A-Za-z])(?:{key.lower()}|{key.upper()})=([^\s\]]*)", 1), F.lit(""))


def parse_layout(texts: DataFrame) -> DataFrame:
    """Lines of (doc_id, text) in either grammar: page, source_order, line_index, s, r, x, y, b, i, f, column, text.

    source_order counts a page's tagged lines from 1, those with empty text included, which are then left
    out; upper-case lines carry their own. Lines before the first page are ignored.
    """
    raw = texts.select("doc_id", F.posexplode(F.split("text", r"\r?\n")).alias("line_index", "line"))
    page = F.coalesce(F.regexp_extract("line", r"^\s*\[PAGE (?:P=)?(\d+)[^\]]*\]", 1).try_cast("int"), _tag(F.col("line"), "p").try_cast("int"))
    by_doc = Window.partitionBy("doc_id").orderBy("line_index")
    lines = raw.withColumn("page", F.last(page, ignorenulls=True).over(by_doc)).where(F.col("line").startswith("[L ") & F.col("page").isNotNull())
    order = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("line_index"))
    num = lambda k, t="double": _tag(F.col("line"), k).try_cast(t)
    lines = lines.withColumn("n", order).select(
        "doc_id", "page", F.coalesce(num("o", "int"), F.col("n")).alias("source_order"), "line_index",
        *[F.bround(num(k), 2).alias(k) for k in ("s", "r", "x", "y")], *[num(k, "int").alias(k) for k in ("b", "i")],
        _tag(F.col("line"), "f").alias("f"), _tag(F.col("line"), "c").alias("column"), F.trim(F.regexp_replace("line", r"^\[L [^\]]*\]\s?", "")).alias("text"),
    )
    return lines.where("text <> ''")


def document_lines(docs: DataFrame) -> DataFrame:
    """Plain documents as lines: doc_id, line_index, page, source_order, rel_y0, rel_y1, text."""
    d = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_index", "text"))
    at = F.col("line_index") % PAGE_LINES
    return d.select(
        "doc_id", "line_index", (F.floor(F.col("line_index") / PAGE_LINES) + 1).cast("int").alias("page"), (at + 1).alias("source_order"),
        (at / PAGE_LINES).alias("rel_y0"), ((at + 1) / PAGE_LINES).alias("rel_y1"), "text",
    )


#: Styles of the elements of a page: size, bold, indent; others are as p.
ELEMENTS = {"h1": (24.0, 1, 72.0), "h2": (18.0, 1, 72.0), "h3": (14.0, 1, 72.0), "li": (9.0, 0, 40.0), "td": (9.0, 0, 72.0), "footer": (8.0, 0, 72.0), "nav": (8.0, 0, 40.0)}
PLAIN = (10.0, 0, 72.0)
#: What has no text of a page, elements that don't end a line, and an element with the text after it.
UNSEEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<title\b[^>]*>.*?</title>"
INLINE = r"(?i)</?(?:a|b|i|em|strong|span|u|small|sup|sub|code|font|mark|abbr|cite|q|time|img|label)(?:\s[^>]*)?/?>"
ELEMENT = r"<(/?[A-Za-z][A-Za-z0-9]*)[^>]*>[^<]*"


def html_lines(pages: DataFrame) -> DataFrame:
    """Pages as styled lines, one for each stretch of text between block elements, whatever their attributes: doc_id, source_order, tag (that before the text), s, r, x, y, b, i, f, text."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), UNSEEN, ""), INLINE, "")
    d = pages.select(F.col("page_id").alias("doc_id"), F.posexplode(F.regexp_extract_all(bare, F.lit(ELEMENT), F.lit(0))).alias("n", "m"))
    text = F.regexp_replace("m", "^<[^>]*>", "")
    for name, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(ch))
    d = d.select("doc_id", (F.col("n") + 1).alias("source_order"), F.lower(F.regexp_extract("m", "^<(/?[A-Za-z][A-Za-z0-9]*)", 1)).alias("tag"), clean_text(text).alias("text")).where("text <> ''")
    pick = lambda i: F.coalesce(*[F.when(F.col("tag") == t, F.lit(v[i])) for t, v in ELEMENTS.items()], F.lit(PLAIN[i]))
    y = F.when(F.col("tag") == "footer", 780.0).otherwise(60.0 + 17.0 * (F.col("source_order") % 40))
    return d.select("doc_id", "source_order", "tag", pick(0).alias("s"), (pick(0) / 10).alias("r"), pick(2).alias("x"), y.alias("y"), pick(1).alias("b"), F.lit(0).alias("i"), F.lit("f1").alias("f"), "text")


def read_pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, page, text) of PDF files, where a PDF library is installed on the workers; else a clear error."""

    def pages(batches):
        import pandas as pd

        try:
            import pdfplumber
        except ImportError as e:
            raise RuntimeError("reading PDF needs pdfplumber on the workers") from e
        import io

        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                with pdfplumber.open(io.BytesIO(content)) as doc:
                    yield pd.DataFrame([(p, k, page.extract_text() or "") for k, page in enumerate(doc.pages, 1)], columns=["path", "page", "text"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[pP][dD][fF]").load(path)
    return files.select("path", "content").mapInPandas(pages, "path string, page int, text string").where("trim(text) <> ''")
