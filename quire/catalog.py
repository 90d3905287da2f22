"""Queries over the tables for the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import books, chunked, headings, parsed, reviews, tables, written
from . import oracles as O
from .functions import numbers as N
from .functions import predicates as P
from .functions import text as T
from .functions.jsonx import read_answer
from .functions.numbering import decimal_path, number_info
from .operators import chunks, lines, models, reports, toc
from .plans import pipelines
from .session import ship
from .sources import layout

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- adapters ----------------------------------------------------------------------------------


def doc_lines(spark: SparkSession, sf: str) -> DataFrame:
    return layout.document_lines(table(spark, sf, "documents"))


def html(spark: SparkSession, sf: str) -> DataFrame:
    return layout.html_lines(table(spark, sf, "pages"))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(F.concat(F.lit("Doc"), F.col("user_id") % 40).alias("source"), F.col("event_type").alias("provider"), F.concat(F.lit("m"), F.col("user_id") % 3).alias("model"), F.col("value").cast("decimal(18,4)").alias("elapsed_seconds"))


RUNS = "runs AS (SELECT 'Doc' || user_id % 40 AS source, event_type AS provider, 'm' || user_id % 3 AS model, value::DECIMAL(18,4) AS elapsed_seconds FROM events)"


def titles(spark: SparkSession, sf: str) -> DataFrame:
    k, n, size = F.col("p_partkey") % 8, F.col("p_name"), F.col("p_size").cast("string")
    t = (
        F.when(k == 0, F.concat(F.lit("제"), size, F.lit("장 "), n)).when(k == 1, F.concat(F.lit("1."), size, F.lit(" "), n)).when(k == 2, F.concat(size, F.lit(". "), n))
        .when(k == 3, F.concat(F.lit("("), size, F.lit(") "), n)).when(k == 4, F.concat(size, F.lit(") "), n)).when(k == 5, F.concat(size, F.lit(" "), n))
        .when(k == 6, F.concat(F.lit("1.2."), size, F.lit(". "), n)).otherwise(F.concat(n, F.lit(" ..... "), size))
    )
    return table(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), t.alias("title"))


def toc_rows(spark: SparkSession, sf: str) -> DataFrame:
    key, q = F.col("p_partkey"), F.col("p_size") % 4
    return table(spark, sf, "part").select(
        F.floor(key / 50).alias("doc_id"), (key % 50).alias("pos"), F.when(key % 9 == 0, 1).otherwise(q + 1).alias("level"),
        F.when(key % 5 == 0, F.col("p_name")).otherwise(F.concat_ws(" ", "p_name", "p_brand", (key % 7).cast("string"))).alias("chapter"),
        (F.floor(key % 50 / 4) + 1).cast("int").alias("page"), (10 + q * 2).cast("double").alias("font_size"), (1 + q / 5).cast("double").alias("size_ratio"),
    )


def hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), pos.alias("pos"), (F.col("l_quantity").cast("int") % 5 + 1).alias("level"), (pos * 3).alias("page"), "l_linenumber", "l_quantity"
    )


# --- reports -----------------------------------------------------------------------------------


@_query(O.query("SELECT provider, model, count(*) AS runs, sum(elapsed_seconds)::DOUBLE AS total_seconds, sum(elapsed_seconds)::DOUBLE / count(*) AS avg_seconds FROM runs GROUP BY ALL", RUNS))
def runs_by_model(spark: SparkSession, sf: str) -> DataFrame:
    return reports.by_model(runs(spark, sf)).withColumn("total_seconds", F.col("total_seconds").cast("double"))


@_query(O.query("SELECT source, provider, model, elapsed_seconds::DOUBLE AS elapsed_seconds FROM runs", RUNS))
def runs_by_file(spark: SparkSession, sf: str) -> DataFrame:
    return reports.by_file(runs(spark, sf).withColumn("elapsed_seconds", F.col("elapsed_seconds").cast("double")))


@_query("SELECT o_orderkey AS source_key, lower(c_name) AS name FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 2 = 0")
def runs_filtered(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("CUSTOMER#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("source"))
    inputs = table(spark, sf, "customer").where("c_custkey % 2 = 0").select(F.col("c_name").alias("name"))
    return reports.of_inputs(o, inputs).select(F.col("o_orderkey").alias("source_key"), F.lower("source").alias("name"))


@_query("SELECT c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def runs_missing_inputs(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.concat(F.lit("CUSTOMER#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("source"))
    return reports.without_runs(table(spark, sf, "customer").select(F.col("c_name").alias("name")), o)


@_query("""SELECT provider, model, sum(prompt_tokens)::BIGINT AS prompt_tokens, sum(completion_tokens)::BIGINT AS completion_tokens,
  CASE WHEN sum(total_tokens) = 0 THEN sum(prompt_tokens) + sum(completion_tokens) ELSE sum(total_tokens) END::BIGINT AS total_tokens FROM (
  SELECT event_type AS provider, 'm' || user_id % 3 AS model, event_id % 1000 AS prompt_tokens, user_id % 100 AS completion_tokens, CASE WHEN user_id % 3 = 0 THEN 0 ELSE event_id % 1000 + user_id % 100 END AS total_tokens FROM events) GROUP BY ALL""")
def usage_totals(spark: SparkSession, sf: str) -> DataFrame:
    p, c = F.col("event_id") % 1000, F.col("user_id") % 100
    u = table(spark, sf, "events").select(F.col("event_type").alias("provider"), F.concat(F.lit("m"), F.col("user_id") % 3).alias("model"), p.alias("prompt_tokens"), c.alias("completion_tokens"), F.when(F.col("user_id") % 3 == 0, 0).otherwise(p + c).alias("total_tokens"))
    return reports.usage_totals(u)


# --- text --------------------------------------------------------------------------------------


@_query(O.query(f"SELECT doc_id, line_index, page, source_order, {O.clean('text')} AS clean, {O.norm_key('text')} AS norm_key, {O.edge_key('text')} AS edge_key, {O.match_key('text')} AS match_key, {O.norm('text')} AS norm FROM doc_lines", O.DOC_LINES))
def clean_lines(spark: SparkSession, sf: str) -> DataFrame:
    t = "text"
    return doc_lines(spark, sf).select("doc_id", "line_index", "page", "source_order", T.clean_text(t).alias("clean"), T.norm_key(t).alias("norm_key"), T.header_footer_key(t).alias("edge_key"), T.match_key(t).alias("match_key"), T.norm(t).alias("norm"))


_RUN = r"[∙·ㆍ.\-–—|:]"
_T1 = O.sub(O.sub(O.clean("title"), rf"^\s*\d{{2,}}\s*{_RUN}\s*"), rf"\s*{_RUN}\s*\d+\s*$")


@_query(O.query(f"""SELECT doc_id, lower(regexp_replace(CASE WHEN len(string_split_regex(trim(t), ' +')) >= 3 THEN {O.sub(O.sub("t", r"^\s*\d{2,}\s+"), r"\s+\d+\s*$")} ELSE t END, '\\s+', '', 'g')) AS title_key,
  CASE WHEN length(t0) <= 12 THEN t0 ELSE rtrim(t0[:11]) || '...' END AS short FROM (SELECT doc_id, {O.clean("title")} AS t0, {_T1} AS t FROM titles)""", O.TITLES))
def dup_title_keys(spark: SparkSession, sf: str) -> DataFrame:
    return titles(spark, sf).select("doc_id", T.duplicate_title_key("title").alias("title_key"), T.short_title("title", 12).alias("short"))


@_query(f"SELECT p_partkey, {O.shape('p_name')} AS name_shape, {O.shape('p_brand')} AS brand_shape, {O.shape('p_type')} AS type_shape, len(regexp_extract_all(p_name, '\\S+')) AS n_tokens FROM part")
def token_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", *[T.token_shape(f"p_{c}").alias(f"{c}_shape") for c in ("name", "brand", "type")], F.size(T.tokens("p_name")).cast("long").alias("n_tokens"))


@_query("""SELECT p_partkey, left(regexp_replace(regexp_replace(f, '^[^+]*\\+', ''), '[^A-Za-z0-9_\\-]', '', 'g'), 24) AS font,
  regexp_matches(lower(f), 'bold|black|heavy|semibold|demi|medium')::INT AS bold, regexp_matches(lower(f), 'italic|oblique')::INT AS italic
  FROM (SELECT p_partkey, 'ABCDEF+' || p_type || CASE p_partkey % 3 WHEN 0 THEN '-Bold' WHEN 1 THEN ',Italic' ELSE ' Medium' END AS f FROM part)""")
def font_flags(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    f = F.concat(F.lit("ABCDEF+"), "p_type", F.when(k == 0, "-Bold").when(k == 1, ",Italic").otherwise(" Medium"))
    return table(spark, sf, "part").select("p_partkey", T.font_name(f).alias("font"), T.font_bold(f).alias("bold"), T.font_italic(f).alias("italic"))


_D = r"^(\d+(?:\.\d+){1,5})\.?\s*(\S.*)$"
_KO = r"^제\s*(\d+)\s*(편|부|장|절)\s*(.*)$"


def _number_sql() -> str:
    shapes = [("arabic_dot", r"^(\d{1,2})\.\s*(\S.*)$", "n || '.'", "3"), ("arabic_paren_wrap", r"^\((\d{1,2})\)\s*(\S.*)$", "'(' || n || ')'", "NULL"), ("arabic_paren", r"^(\d{1,2})\)\s*(\S.*)$", "n || ')'", "NULL"), ("bare_number", r"^(\d{1,2})\s+(\S.*)$", "n", "NULL")]
    arms = [f"SELECT doc_id, t, 1 AS k, CASE regexp_extract(t, '{_KO}', 2) WHEN '장' THEN 'ko_chapter' WHEN '절' THEN 'ko_section' ELSE 'ko_part' END AS style, regexp_extract(t, '{_KO}', 1)::INT AS number, '제' || regexp_extract(t, '{_KO}', 1)::INT || regexp_extract(t, '{_KO}', 2) AS number_text, trim(regexp_extract(t, '{_KO}', 3)) AS body, CASE regexp_extract(t, '{_KO}', 2) WHEN '장' THEN 2 WHEN '절' THEN 3 ELSE 1 END AS level FROM c WHERE regexp_matches(t, '{_KO}')"]
    dots = f"(length(regexp_extract(t, '{_D}', 1)) - length(replace(regexp_extract(t, '{_D}', 1), '.', '')))"
    arms.append(f"SELECT doc_id, t, 2, 'arabic_decimal_' || {dots}, string_split(regexp_extract(t, '{_D}', 1), '.')[-1]::INT, regexp_extract(t, '{_D}', 1), trim(regexp_extract(t, '{_D}', 2)), least(3 + {dots}, 6) FROM c WHERE regexp_matches(t, '{_D}')")
    for k, (style, p, form, level) in enumerate(shapes, 3):
        arms.append(f"SELECT doc_id, t, {k}, '{style}', n::INT, {form}, body, {level} FROM (SELECT doc_id, t, regexp_extract(t, '{p}', 1)::INT AS n, trim(regexp_extract(t, '{p}', 2)) AS body FROM c WHERE regexp_matches(t, '{p}'))")
    return O.query(
        f"SELECT c.doc_id, style, number, number_text, body, level, CASE WHEN regexp_matches(c.t, '^\\s*\\d+(?:\\.\\d+)+') THEN regexp_extract(c.t, '^\\s*(\\d+(?:\\.\\d+)+)', 1) END AS path FROM c LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS rn FROM ({' UNION ALL '.join(arms)})) x ON x.doc_id = c.doc_id AND rn = 1",
        O.TITLES, f"c AS (SELECT doc_id, {O.clean('title')} AS t FROM titles)",
    )


@_query(_number_sql())
def number_infos(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("title")
    return titles(spark, sf).select("doc_id", number_info(t).alias("n"), T.number_path_text(decimal_path(t)).alias("path")).select("doc_id", "n.*", "path")


_C = O.clean("title")
_MARK = r"(?i)^(?:chapter|part|section|unit)\s*\d+[a-z]?\b|(?i)^제\s*\d+\s*[장절편부]|(?i)^\d+(?:\.\d+)+\b|^\d+\s*[.)]|^\([^)]+\)|(?i)^[a-z]\s*[.)]|^[가-힣]\s*[.)]"


@_query(O.query(f"""SELECT doc_id, {O.like(_C, r"(?i)^(?:(?:chapter|part|section|unit)\s*\d+[a-z]?|제\s*\d+\s*[장절편부]|\d+(?:\.\d+)*[.)]?)$")} AS marker_only, {O.like(_C, _MARK)} AS marker,
  {O.like(_C, r"[·ㆍ.]{3,}\s*\d+\s*$")} OR {O.like(_C, r"\S\s+\d{1,4}$")} AS listing, {O.like(_C, r"(?i)^(?:표|그림|figure|fig\.|table|box)\s*[\dIVXivx가-힣.:\-]")} AS visual,
  {_C} = '' OR length({_C}) > 180 OR {O.like(_C, r"^[\d\s.,;:()\-_/]+$")} OR {O.like(_C, r"^[•●▪▫\-–—*]\s+")} OR {O.like(_C, r"(?i)^(?:table|figure|fig\.|box|표|그림)\s*[\dIVXivx가-힣.:\-]")} OR (length({_C}) > 80 AND {O.like(_C, r"(?:다|요|니다|였다|한다|있다|된다|\.|;|:)$")}) AS non_heading
  FROM (SELECT doc_id, title FROM titles UNION ALL SELECT doc_id, text AS title FROM doc_lines)""", O.TITLES, O.DOC_LINES))
def title_predicates(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("title")
    both = titles(spark, sf).unionByName(doc_lines(spark, sf).select("doc_id", F.col("text").alias("title")))
    return both.select("doc_id", P.is_marker_only(t).alias("marker_only"), P.has_structural_marker(t).alias("marker"), P.is_toc_listing(t).alias("listing"), P.is_visual_caption(t).alias("visual"), P.is_probable_non_heading(t).alias("non_heading"))


@_query("""SELECT a.p_partkey, (abs(a.p_size - b.p_size) + abs(a.p_size - b.p_size) * 8.0 + abs(a.p_size - b.p_size) * 0.08)::DOUBLE + CASE WHEN a.p_size % 2 <> b.p_size % 2 THEN 2.0 ELSE 0.0 END
  + CASE WHEN a.p_type <> b.p_type THEN 1.0 ELSE 0.0 END AS distance0 FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1""".join(("SELECT p_partkey, round(distance0, 4) AS distance FROM (", ")")))
def style_distances(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_type")
    j = p.alias("a").join(p.alias("b"), F.col("b.p_partkey") == F.col("a.p_partkey") + 1)
    style = lambda x: {"font_size": F.col(f"{x}.p_size"), "size_ratio": F.col(f"{x}.p_size"), "left_indent": F.col(f"{x}.p_size"), "bold": F.col(f"{x}.p_size") % 2, "italic": F.lit(None), "font_id": F.col(f"{x}.p_type")}
    return j.select("a.p_partkey", F.round(N.style_distance(style("a"), style("b")), 4).alias("distance"))


# --- layout and lines ---------------------------------------------------------------------------


@_query(O.query("SELECT * FROM html_lines", O.HTML_LINES))
def html_layout_lines(spark: SparkSession, sf: str) -> DataFrame:
    return html(spark, sf)


@_query(O.query("SELECT doc_id, 1 AS page, row_number() OVER (PARTITION BY doc_id ORDER BY source_order) AS source_order, s, x, y, b, f, text FROM html_lines", O.HTML_LINES))
def parse_layout_text(spark: SparkSession, sf: str) -> DataFrame:
    """Lines rendered in the layout grammar and parsed again."""
    tag = T.layout_tag(*[F.col(c) for c in ("s", "r", "x", "y", "b", "i", "f", "text")])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_order", tag.alias("t")))), lambda v: v["t"]), "\n")
    texts = html(spark, sf).groupBy("doc_id").agg(F.concat(F.lit("[PAGE 1]\n"), text).alias("text"))
    return layout.parse_layout(texts).select("doc_id", "page", F.col("source_order").cast("long").alias("source_order"), "s", "x", "y", "b", "f", "text")


@_query(O.query("""SELECT doc_id, source_order, greatest(0.0, y0 - coalesce(lag(y1) OVER w, 0.0)) AS prev_gap, greatest(0.0, coalesce(lead(y0) OVER w, 842.0) - y1) AS next_gap
  FROM (SELECT doc_id, source_order, y AS y0, y + s AS y1, x + source_order / 1000 AS x0 FROM html_lines) WINDOW w AS (PARTITION BY doc_id ORDER BY y0, x0)""", O.HTML_LINES))
def line_gaps(spark: SparkSession, sf: str) -> DataFrame:
    d = html(spark, sf).withColumns({"page": F.lit(1), "y0": F.col("y"), "y1": F.col("y") + F.col("s"), "x0": F.col("x") + F.col("source_order") / 1000, "page_height": F.lit(842.0)})
    return lines.gaps(d).select("doc_id", "source_order", "prev_gap", "next_gap")


_NUM = r"(?i)^(?:page\s*)?\d+(?:\s*/\s*\d+)?$|^-\s*\d+\s*-$"
_DOTS, _ROM = r"[∙·•ㆍ\-–—]*", r"[ivxlcdm]{1,12}"
_PAGE = f"({O.match_key('text')} NOT IN ('차례','목차','contents','찾아보기','색인','index') AND ({O.like(O.match_key('text'), f'^{_DOTS}(?:{_ROM}|\\d{{1,4}}){_DOTS}$')} OR {O.like(O.match_key('text'), f'^(?:{_ROM})?{_DOTS}(?:차례|목차|찾아보기|색인){_DOTS}(?:{_ROM})?$')}))"


@_query(O.query(f"""SELECT doc_id, line_index, text FROM k LEFT JOIN (
    SELECT doc_id, key FROM k WHERE edge AND length(key) >= 3 GROUP BY ALL HAVING count(DISTINCT page) >= 3) r USING (doc_id, key)
  WHERE NOT (edge AND (r.key IS NOT NULL OR {O.like(O.clean("text"), _NUM)} OR {_PAGE}))""".replace("LEFT JOIN (\n    SELECT doc_id, key", "LEFT JOIN (\n    SELECT doc_id, key").replace("r.key IS NOT NULL", "r.again IS NOT NULL").replace("SELECT doc_id, key FROM k WHERE edge", "SELECT doc_id, key, true AS again FROM k WHERE edge"),
    O.DOC_LINES, f"k AS (SELECT *, rel_y0 <= 0.10 OR rel_y1 >= 0.90 AS edge, {O.edge_key('text')} AS key FROM doc_lines)"))
def header_footer_removed(spark: SparkSession, sf: str) -> DataFrame:
    return lines.remove_headers_footers(doc_lines(spark, sf)).select("doc_id", "line_index", "text")



# --- tables of contents --------------------------------------------------------------------------


@_query(O.query(f"""SELECT doc_id, chunk, pos, level, chapter, page, row_number() OVER (PARTITION BY doc_id ORDER BY page, chunk, pos) - 1 AS merged_pos FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, page, {O.norm("chapter")} ORDER BY chunk, pos) AS rn FROM (SELECT *, 1 AS chunk FROM toc WHERE pos < 30 UNION ALL SELECT *, 2 AS chunk FROM toc WHERE pos >= 20)) WHERE rn = 1""", O.TOC))
def merged_partials(spark: SparkSession, sf: str) -> DataFrame:
    t = toc_rows(spark, sf)
    both = t.where("pos < 30").withColumn("chunk", F.lit(1)).unionByName(t.where("pos >= 20").withColumn("chunk", F.lit(2)))
    return toc.merge_partials(both).select("doc_id", "chunk", "pos", "level", "chapter", "page", "merged_pos")


@_query(O.query(f"""SELECT doc_id, title_key, page, level_before, level_after, CASE WHEN level_before IS NULL THEN 'added' WHEN level_after IS NULL THEN 'removed' WHEN level_before <> level_after THEN 'level_changed' ELSE 'same' END AS status
  FROM (SELECT doc_id, {O.match_key("chapter")} AS title_key, page, arg_max(level, pos) AS level_before FROM toc WHERE pos % 7 <> 3 GROUP BY ALL)
  FULL JOIN (SELECT doc_id, {O.match_key("chapter")} AS title_key, page, arg_max(CASE WHEN pos % 6 = 0 THEN level + 1 ELSE level END, pos) AS level_after FROM toc WHERE pos % 5 <> 2 GROUP BY ALL) USING (doc_id, title_key, page)""", O.TOC))
def toc_diff(spark: SparkSession, sf: str) -> DataFrame:
    t = toc_rows(spark, sf)
    after = t.where("pos % 5 <> 2").withColumn("level", F.when(F.col("pos") % 6 == 0, F.col("level") + 1).otherwise(F.col("level")))
    return toc.diff(t.where("pos % 7 <> 3"), after)


@_query(O.query(f"""SELECT doc_id, pos, chapter, page, tier, source_order, line_text FROM (SELECT t.doc_id, t.pos, t.chapter, 1 AS page, CASE WHEN a = w THEN 5 WHEN prefix(w, a) THEN 4 WHEN contains(w, a) THEN 3 WHEN length(w) >= 4 AND contains(a, w) THEN 2 END AS tier, l.source_order, l.text AS line_text,
    row_number() OVER (PARTITION BY t.doc_id, t.pos ORDER BY CASE WHEN a = w THEN 5 WHEN prefix(w, a) THEN 4 WHEN contains(w, a) THEN 3 WHEN length(w) >= 4 AND contains(a, w) THEN 2 ELSE 0 END DESC, abs(length(a) - length(w)), l.source_order) AS rn
  FROM (SELECT doc_id, source_order AS pos, text AS chapter, {O.norm("text")} AS a FROM html_lines WHERE tag = 'h1') t JOIN (SELECT *, {O.norm("text")} AS w FROM html_lines WHERE tag <> 'h1') l USING (doc_id) WHERE w <> '' AND a <> '') WHERE rn = 1 AND tier IS NOT NULL""", O.HTML_LINES))
def title_line_match(spark: SparkSession, sf: str) -> DataFrame:
    d = html(spark, sf).withColumn("page", F.lit(1))
    t = d.where("tag = 'h1'").select("doc_id", F.col("source_order").alias("pos"), F.col("text").alias("chapter"), "page")
    return toc.match_lines(t, d.where("tag <> 'h1'"))


# --- hierarchy ---------------------------------------------------------------------------------


@_query(O.query("SELECT doc_id, pos, level, dense_rank() OVER (PARTITION BY doc_id ORDER BY level) AS dense_level FROM hierarchy", O.HIERARCHY))
def dense_levels(spark: SparkSession, sf: str) -> DataFrame:
    return toc.dense_levels(hierarchy(spark, sf)).select("doc_id", "pos", "level", "dense_level")


@_query(O.query("SELECT doc_id, level, min(pos) AS pos FROM hierarchy GROUP BY ALL", O.HIERARCHY))
def level_examples(spark: SparkSession, sf: str) -> DataFrame:
    return toc.level_examples(hierarchy(spark, sf)).select("doc_id", "level", "pos")


# --- chunks ------------------------------------------------------------------------------------

_PAGES = "pg AS (SELECT doc_id, page, '[PAGE ' || page || ']' || chr(10) || string_agg(text, chr(10) ORDER BY source_order) AS text, row_number() OVER (PARTITION BY doc_id ORDER BY page) - 1 AS rk, count(*) OVER (PARTITION BY doc_id) AS np FROM doc_lines GROUP BY doc_id, page)"


@_query(O.query("""SELECT c.doc_id, k + 1 AS chunk, max(c.total) AS total, min(page) FILTER (rk // 3 = k) AS target_start_page, max(page) FILTER (rk // 3 = k) AS target_end_page, min(page) AS context_start_page, max(page) AS context_end_page,
  CASE WHEN length(string_agg(text, chr(10) ORDER BY page)) = 0 THEN 0 ELSE greatest(1, floor(length(string_agg(text, chr(10) ORDER BY page)) / 2.2)) END::INT AS estimated_tokens, string_agg(text, chr(10) ORDER BY page) AS text
  FROM (SELECT doc_id, unnest(range(0, (max(np) + 2) // 3)) AS k, (max(np) + 2) // 3 AS total FROM pg GROUP BY doc_id) c JOIN pg ON pg.doc_id = c.doc_id AND rk >= k * 3 - 1 AND rk <= k * 3 + 3 GROUP BY c.doc_id, k""", O.DOC_LINES, _PAGES))
def page_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.page_chunks(chunks.page_texts(doc_lines(spark, sf)))


# --- answers of models --------------------------------------------------------------------------


@_query("SELECT p_partkey AS doc_id, p_size AS level, p_name AS chapter FROM part")
def json_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged answers, read again: a fence, an unquoted key, a missing comma, a trailing one, a cut end."""
    ship(spark)
    k = F.col("p_partkey") % 5
    form = lambda p: F.format_string(p, F.col("p_size"), F.col("p_name"))
    text = (
        F.when(k == 0, form('Here it is:\n```json\n{"level": %d, "chapter": "%s"}\n```')).when(k == 1, form('{level: %d, chapter: "%s"}'))
        .when(k == 2, form('{"level": %d "chapter": "%s"}')).when(k == 3, form('{"level": %d, "chapter": "%s",}')).otherwise(form('{"level": %d, "chapter": "%s"'))
    )
    d = table(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), read_answer(text, "level int, chapter string").alias("a"))
    return d.select("doc_id", "a.*")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to styled lines to learned rules to a table of contents."""
    return pipelines.rule_toc(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Query]:
    return _QUERIES | books.QUERIES | chunked.QUERIES | headings.QUERIES | parsed.QUERIES | reviews.QUERIES | tables.QUERIES | written.QUERIES


def oracle_sql() -> dict[str, str]:
    return _SQL | books.SQL | chunked.SQL | headings.SQL | parsed.SQL | reviews.SQL | tables.SQL | written.SQL
