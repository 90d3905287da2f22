"""Queries over characters and parsed texts: lines, columns, renderings, segments, chunks with context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles as O
from .books import Query
from .sources import chars as C

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: Parts' names as printed lines: twelve a page, in two columns on every other page, some in bold or slanted type.
CHARS = """
lns AS (SELECT p_partkey // 120 AS doc_id, p_partkey % 120 // 24 + 1 AS page, p_partkey % 24 // CASE WHEN p_partkey % 120 // 24 % 2 = 0 THEN 2 ELSE 1 END AS line, CASE WHEN p_partkey % 120 // 24 % 2 = 0 THEN p_partkey % 2 ELSE 0 END AS side, p_size,
  CASE p_size % 7 WHEN 0 THEN p_size || '. ' || p_name WHEN 1 THEN 'CHAPTER ' || p_size WHEN 2 THEN '김철수, 이영희' WHEN 3 THEN p_name || ': ' || p_type || ' that goes on' ELSE p_name || ' ' || p_type END AS t FROM part),
chars AS (SELECT doc_id, page, line, side * 1000 + n AS n, t[n] AS text, (9 + p_size % 5 * 2 + CASE WHEN n % 5 = 0 THEN 0.5 ELSE 0 END)::DOUBLE AS size, (40 + side * 290 + n * 4)::DOUBLE AS x0, (50 + line * 20)::DOUBLE AS top,
  CASE WHEN n % 4 = 0 THEN 'ABCDEF+Plain' WHEN p_size % 5 = 0 THEN 'GHIJKL+Serif-Bold' WHEN p_size % 5 = 1 THEN 'Sans,Oblique' WHEN p_size % 5 = 2 THEN '' ELSE 'Sans Text' END AS fontname FROM (SELECT *, unnest(range(1, length(t) + 1)) AS n FROM lns)),
pgs AS (SELECT DISTINCT doc_id, page, 600.0::DOUBLE AS width, 800.0::DOUBLE AS height FROM lns)"""


def chars(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    key, n = F.col("p_partkey"), F.col("p_size")
    page = F.floor(key % 120 / 24) + 1
    two = page % 2 == 1
    t = F.when(n % 7 == 0, F.concat(n.cast("string"), F.lit(". "), "p_name")).when(n % 7 == 1, F.concat(F.lit("CHAPTER "), n.cast("string"))).when(n % 7 == 2, "김철수, 이영희").when(n % 7 == 3, F.concat("p_name", F.lit(": "), "p_type", F.lit(" that goes on"))).otherwise(F.concat("p_name", F.lit(" "), "p_type"))
    lns = spark.read.parquet(f"{sf}/part.parquet").select(F.floor(key / 120).alias("doc_id"), page.cast("int").alias("page"), F.floor(key % 24 / F.when(two, 2).otherwise(1)).alias("line"), F.when(two, key % 2).otherwise(0).alias("side"), "p_size", t.alias("t"))
    c = lns.withColumn("k", F.explode(F.sequence(F.lit(1), F.char_length("t"))))
    k, s = F.col("k"), F.col("p_size") % 5
    font = F.when(k % 4 == 0, "ABCDEF+Plain").when(s == 0, "GHIJKL+Serif-Bold").when(s == 1, "Sans,Oblique").when(s == 2, "").otherwise("Sans Text")
    c = c.select(
        "doc_id", "page", "line", (F.col("side") * 1000 + k).alias("n"), F.substring(F.col("t"), k, F.lit(1)).alias("text"), (9 + s * 2 + F.when(k % 5 == 0, 0.5).otherwise(0.0)).cast("double").alias("size"),
        (40 + F.col("side") * 290 + k * 4).cast("double").alias("x0"), (50 + F.col("line") * 20).cast("double").alias("top"), font.alias("fontname"),
    )
    return c, lns.select("doc_id", "page", F.lit(600.0).alias("width"), F.lit(800.0).alias("height")).distinct()


_TWO = "twos AS (SELECT doc_id, page, count(*) >= 160 AND count(*) FILTER (x0 < 280) >= 80 AND count(*) FILTER (x0 > 320) >= 80 AND count(*) FILTER (x0 < 280) / greatest(1, count(*) FILTER (x0 < 280 OR x0 > 320)) >= 0.25 AND count(*) FILTER (x0 > 320) / greatest(1, count(*) FILTER (x0 < 280 OR x0 > 320)) >= 0.25 AS two FROM chars WHERE trim(text) <> '' GROUP BY ALL)"
_BODY = "body AS (SELECT doc_id, page, median(size) FILTER (trim(text) <> '') AS body_size FROM chars GROUP BY ALL)"
_LAID = f"""sided AS (SELECT c.*, CASE WHEN NOT two THEN '' WHEN x0 < 296 THEN 'L' WHEN x0 >= 304 THEN 'R' END AS side FROM chars c JOIN twos USING (doc_id, page)),
grp AS (SELECT doc_id, page, side, line, median(size) AS s, min(x0) AS x, min(top) AS y, trim({O.sub("string_agg(text, '' ORDER BY n)", '[ \\t]+', ' ')}, E' \\t\\n') AS text FROM sided WHERE side IS NOT NULL GROUP BY ALL),
fnt AS (SELECT doc_id, page, side, line, fontname FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, side, line ORDER BY k DESC, first) AS rn FROM (SELECT doc_id, page, side, line, fontname, count(*) AS k, min(n) AS first FROM sided WHERE side IS NOT NULL AND fontname <> '' GROUP BY ALL)) WHERE rn = 1),
ord AS (SELECT g.*, fontname, left(regexp_replace(regexp_replace(coalesce(fontname, ''), '^[^+]*\\+', ''), '[^A-Za-z0-9_\\-]', '', 'g'), 24) AS fn, row_number() OVER (PARTITION BY doc_id, page ORDER BY side, line) AS source_order FROM grp g LEFT JOIN fnt USING (doc_id, page, side, line) WHERE g.text <> ''),
nums AS (SELECT doc_id, fn, 'f' || row_number() OVER (PARTITION BY doc_id ORDER BY a, b) AS f FROM (SELECT doc_id, fn, min(page * 100000 + source_order) AS a, 0 AS b FROM ord WHERE fn <> '' GROUP BY ALL)),
laid AS (SELECT doc_id, page, source_order, nullif(side, '') AS "column", s, s / body_size AS r, x, y, regexp_matches(lower(coalesce(fontname, '')), 'bold|black|heavy|semibold|demi|medium')::INT AS b, regexp_matches(lower(coalesce(fontname, '')), 'italic|oblique')::INT AS i, coalesce(f, 'f0') AS f, fontname, text, body_size FROM ord LEFT JOIN nums USING (doc_id, fn) JOIN body USING (doc_id, page))"""
LAID = (CHARS, _TWO, _BODY, _LAID)
_TAG = "printf('s=%.1f r=%.2f x=%.0f y=%.0f b=%d i=%d f=%s', s, r, x, y, b, i, f)"


@query(O.query("SELECT * FROM body", CHARS, _BODY))
def page_body_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return C.body_sizes(chars(spark, sf)[0])


@query(O.query("SELECT p.doc_id, p.page, coalesce(two, false) AS two FROM pgs p LEFT JOIN twos USING (doc_id, page)", CHARS, _TWO))
def two_column_pages(spark: SparkSession, sf: str) -> DataFrame:
    return C.two_columns(*chars(spark, sf))


@query(O.query("SELECT * REPLACE (round(r, 6) AS r) FROM laid", *LAID))
def laid_out_lines(spark: SparkSession, sf: str) -> DataFrame:
    return C.layout_lines(*chars(spark, sf)).withColumn("r", F.round("r", 6))


_SHAPES = r"(?i)^CHAPTER(?:\s+\d+)?$|(?i)^SECTION(?:\s+\d+)?$|^\d{1,3}\s+[가-힣A-Za-z]|^\d{1,3}\.\s*[가-힣A-Za-z]|^\d{1,3}\)\s*[가-힣A-Za-z]|^\(\d{1,3}\)\s*[가-힣A-Za-z]|^[가-힣]\.\s*[가-힣A-Za-z]|^(?-i:[A-Z])\.\s+[A-Za-z가-힣]"


@query(O.query(f"""SELECT doc_id, page, source_order, text FROM (SELECT *, round(s, 1) AS s1, round(r, 2) AS r2 FROM laid) WHERE NOT regexp_matches(text, '^[가-힣]{{2,4}}(?:,\\s*[가-힣]{{2,4}})+(?:\\s*\\(.+\\))?$') AND abs(r2 - 1.0) > 0.08 AND length(text) <= 140
  AND (regexp_matches(text, '{_SHAPES}') OR r2 >= 1.25 OR (b <> 0 AND r2 >= 0.95 AND length(text) <= 80) OR (s1 >= CASE WHEN r2 <> 0 THEN s1 / r2 ELSE s1 END + 2.0 AND length(text) <= 120))""", *LAID))
def heading_like_lines(spark: SparkSession, sf: str) -> DataFrame:
    return C.headings_only(C.layout_lines(*chars(spark, sf))).select("doc_id", "page", "source_order", "text")


@query(O.query(f"SELECT doc_id, page, string_agg('[L ' || {_TAG} || coalesce(' c=' || \"column\", '') || '] ' || text, chr(10) ORDER BY source_order) AS text FROM laid GROUP BY ALL", *LAID))
def column_page_texts(spark: SparkSession, sf: str) -> DataFrame:
    return C.page_texts(C.layout_lines(*chars(spark, sf)), C.tag(F.col("column")))


@query(O.query(f"SELECT doc_id, page, string_agg('[L source_order=' || source_order || ' ' || {_TAG} || '] ' || text, chr(10) ORDER BY source_order) AS text FROM laid GROUP BY ALL", *LAID))
def ordered_page_texts(spark: SparkSession, sf: str) -> DataFrame:
    return C.page_texts(C.layout_lines(*chars(spark, sf)), C.tag(order=F.col("source_order")))


@query(O.query("""SELECT doc_id, string_agg(t, chr(10) ORDER BY page) || chr(10) AS text FROM (SELECT doc_id, page, printf('[PAGE P=%d W=%.1f H=%.1f BODY=%.2f]', page, 600.0, 800.0, max(body_size)) || chr(10) ||
  string_agg(printf('[L P=%d O=%d S=%.2f R=%.3f X=%.1f Y=%.1f B=%d I=%d F=%s] ', page, source_order, round(s, 3), round(r, 3), round(x, 1), round(y, 1), b, i, left(regexp_replace(regexp_replace(coalesce(fontname, ''), '^[^+]*\\+', ''), '[^A-Za-z0-9_\\-]', '', 'g'), 40)) || text, chr(10) ORDER BY source_order) AS t FROM laid GROUP BY doc_id, page) GROUP BY doc_id""", *LAID))
def upper_case_texts(spark: SparkSession, sf: str) -> DataFrame:
    c, p = chars(spark, sf)
    return C.upper_text(C.typed_pages(C.layout_lines(c, p), p))


@query(O.query("SELECT doc_id, count(DISTINCT page)::INT AS page_count, count(source_order)::INT AS line_count FROM pgs LEFT JOIN laid USING (doc_id, page) GROUP BY ALL", *LAID))
def typed_layouts_of_pages(spark: SparkSession, sf: str) -> DataFrame:
    c, p = chars(spark, sf)
    return C.typed_pages(C.layout_lines(c, p), p).drop("pages")


_EXPLAIN = " OR ".join(f"(instr(text, '{d}') > 0 AND length(trim(text[:instr(text, '{d}') - 1])) >= 2 AND length(trim(text[instr(text, '{d}') + {len(d)}:])) >= 8 AND (regexp_matches(lower(text[instr(text, '{d}') + {len(d)}:]), '{'|'.join(C.PROSE)}') OR (length(trim(text[instr(text, '{d}') + {len(d)}:])) >= 16 AND regexp_matches(text[instr(text, '{d}') + {len(d)}:], '[가-힣]{{2,}}'))))" for d in C.DELIMITERS)


@query(O.query(f"SELECT doc_id, page, source_order, {_EXPLAIN} AS explains FROM laid", *LAID))
def explanations(spark: SparkSession, sf: str) -> DataFrame:
    return C.layout_lines(*chars(spark, sf)).select("doc_id", "page", "source_order", C.is_explanation(F.col("text")).alias("explains"))
