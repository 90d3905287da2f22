"""Queries over documents as books: pages of styled lines, and tables of contents that are right, wrong and partly known."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles as O
from .functions.text import clean_text, match_key, settled
from .operators import attach
from .session import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def book_lines(spark: SparkSession, sf: str) -> DataFrame:
    def line(t: Column, p: Column) -> Column:
        part = (F.floor(p / 8) + 1).cast("string")
        text = (
            F.when(p % 8 == 0, F.concat(F.lit("제"), part, F.lit("장 "), t)).when(p % 8 == 2, F.concat(part, F.lit("."), (p % 3 + 1).cast("string"), F.lit(" "), t))
            .when(p % 8 == 5, F.concat(F.lit("Figure "), p.cast("string"), F.lit(". "), t)).when(p % 8 == 6, F.concat(F.lit("("), (p % 9 + 1).cast("string"), F.lit(") "), t)).otherwise(t)
        )
        return F.when(t != "", F.struct(p.alias("p"), text.alias("text")))

    # Lines come out of a generator with their texts made: what is asked of them later is asked of a column, not of how it was made.
    rows = F.array_compact(F.transform(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), clean_text), line))
    d = spread(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")).select("doc_id", F.inline(rows))
    p = F.col("p")
    size = (10 + p * 7 % 4 * 2).cast("double")
    return d.select(
        "doc_id", p.alias("line_index"), (F.floor(p / 6) + 1).cast("int").alias("page"), (p % 6 + 1).alias("source_order"), size.alias("s"), (size / 10).alias("r"), (40 + 16 * (p % 3)).cast("double").alias("x"),
        (50 + 120 * (p % 6)).cast("double").alias("y"), (p % 5 == 0).cast("int").alias("b"), (p % 7 == 3).cast("int").alias("i"), F.concat(F.lit("f"), (p % 2 + 1).cast("string")).alias("f"), "text",
    )


def book_toc(spark: SparkSession, sf: str) -> DataFrame:
    d = book_lines(spark, sf).where("line_index % 2 = 0").select("doc_id", "line_index", "page", "source_order", "text")
    pos, text = F.floor(F.col("line_index") / 2).cast("int"), F.col("text")
    chapter = F.when(pos % 5 == 1, F.substring(text, F.lit(1), (F.floor(F.char_length("text") / 2) + 1).cast("int"))).when(pos % 5 == 2, F.concat(text, F.lit(" and more"))).when(pos % 5 == 3, F.concat(F.lit("Unknown "), F.col("line_index").cast("string"))).otherwise(text)
    return settled(d, {"chapter": chapter}).select(
        "doc_id", pos.alias("pos"), (pos % 4 + 1).alias("level"), "chapter", F.when(pos % 7 == 0, F.col("page") + 1).otherwise(F.col("page")).alias("page"),
        F.when(pos % 6 == 0, F.col("source_order")).alias("source_order"), F.when(pos % 3 == 0, F.concat(F.lit("because "), F.col("line_index").cast("string"))).alias("level_reason"),
    )


def book_styled(spark: SparkSession, sf: str) -> DataFrame:
    pos, level = F.col("pos"), F.col("level")
    known = lambda c, kind="double": F.when(pos % 3 != 1, c).cast(kind)
    return book_toc(spark, sf).select(
        "doc_id", "pos", "level", "chapter", "page", "level_reason", known(40 + pos % 5).alias("x"), known(50 + 60 * (pos % 13)).alias("y"), known(10 + level).alias("font_size"), known(1 + level / 10).alias("size_ratio"),
        F.when(pos % 3 == 0, F.col("chapter")).when(pos % 3 == 2, F.concat("chapter", F.lit(" tail"))).alias("layout_text"), known(F.col("page"), "int").alias("layout_page"), known(pos % 2, "int").alias("bold"), known(F.lit(0), "int").alias("italic"),
        F.when(pos % 9 == 0, pos * 2).alias("source_order"), F.when(pos % 4 == 2, pos).alias("merge_order"),
    )


BOOK = (O.BOOK_LINES, O.BOOK_TOC)
STYLED = (*BOOK, O.BOOK_STYLED)

# --- entries and lines --------------------------------------------------------------------------

_TIER = "CASE WHEN a = w THEN 5 WHEN prefix(w, a) THEN 4 WHEN contains(w, a) THEN 3 WHEN length(w) >= 4 AND contains(a, w) THEN 2 END"
_ATTACH = (
    f"ln AS (SELECT *, {O.norm('text')} AS w FROM book_lines)",
    f"en AS (SELECT *, {O.norm('chapter')} AS a FROM book_toc)",
    "by_id AS (SELECT e.doc_id, e.pos, l.line_index FROM en e JOIN ln l ON l.doc_id = e.doc_id AND l.page = e.page AND l.source_order = e.source_order)",
    f"""by_title AS (SELECT doc_id, pos, line_index FROM (SELECT e.doc_id, e.pos, l.line_index, row_number() OVER (PARTITION BY e.doc_id, e.pos ORDER BY {_TIER} DESC, abs(length(a) - length(w)), l.source_order) AS n
      FROM en e JOIN ln l ON l.doc_id = e.doc_id AND l.page = e.page WHERE a <> '' AND w <> '' AND {_TIER} IS NOT NULL AND (e.doc_id, e.pos) NOT IN (SELECT doc_id, pos FROM by_id)) WHERE n = 1)""",
)
_ANYWHERE = """anywhere AS (SELECT doc_id, pos, line_index FROM (SELECT *, sum(tier = 1) OVER k AS n1, sum(tier <= 2) OVER k AS n2, count(*) OVER k AS n3 FROM (
      SELECT e.doc_id, e.pos, l.line_index, CASE WHEN a = w THEN 1 WHEN prefix(w, a) THEN 2 ELSE 3 END AS tier FROM en e JOIN ln l ON l.doc_id = e.doc_id AND contains(w, a) WHERE a <> '')
    WINDOW k AS (PARTITION BY doc_id, pos)) WHERE tier <= CASE WHEN n1 = 1 THEN 1 WHEN n2 = 1 THEN 2 WHEN n3 = 1 THEN 3 ELSE 0 END)"""
_PLACED = """SELECT e.doc_id, e.pos, e.level, e.chapter, coalesce(l.page, e.page) AS page, CASE WHEN l.page <> e.page THEN trim(coalesce(e.level_reason, '') || ' Page corrected from ' || e.page || ' to ' || l.page || ' by parsed layout match.') ELSE e.level_reason END AS level_reason,
    l.line_index IS NOT NULL AS matched, l.source_order AS line_order, l.y, l.text AS source_text, coalesce(l.page <> e.page, false) AS page_corrected, a
  FROM en e LEFT JOIN by_id USING (doc_id, pos) LEFT JOIN by_title t USING (doc_id, pos) """


@query(O.query(f"""SELECT * EXCLUDE (a, n), row_number() OVER (PARTITION BY doc_id ORDER BY page, line_order NULLS LAST, y NULLS LAST, pos) AS sorted_pos FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, a, page ORDER BY pos) AS n FROM (
  {_PLACED} LEFT JOIN anywhere w USING (doc_id, pos) LEFT JOIN ln l ON l.doc_id = e.doc_id AND l.line_index = coalesce(by_id.line_index, t.line_index, w.line_index))) WHERE n = 1 AND matched""", *BOOK, *_ATTACH, _ANYWHERE))
def attached_lines(spark: SparkSession, sf: str) -> DataFrame:
    return attach.attach_lines(book_toc(spark, sf), book_lines(spark, sf)).drop("s", "r", "x", "b", "i", "f")


@query(O.query(f"""SELECT * EXCLUDE (a), row_number() OVER (PARTITION BY doc_id ORDER BY page, line_order NULLS LAST, y NULLS LAST, pos) AS sorted_pos FROM (
  {_PLACED} LEFT JOIN ln l ON l.doc_id = e.doc_id AND l.line_index = coalesce(by_id.line_index, t.line_index))""", *BOOK, *_ATTACH))
def attached_keeping_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    return attach.attach_lines(book_toc(spark, sf), book_lines(spark, sf), any_page=False, keep_unmatched=True).drop("s", "r", "x", "b", "i", "f")


_BEST = f"""best AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, pos ORDER BY match_score DESC, line_index) AS n FROM (
  SELECT e.doc_id, e.pos, e.chapter, e.page, round({O.title_score('t', 'k', 'l.text', 'l.s', 'l.r', 'l.y')}, 4) AS match_score, l.line_index, l.x, l.y, l.s, l.r, l.text, l.page AS line_page, l.b, l.i
  FROM (SELECT *, {O.match_key('chapter')} AS t FROM book_toc) e JOIN (SELECT *, {O.match_key('text')} AS k FROM book_lines) l ON l.doc_id = e.doc_id AND l.page = e.page) WHERE match_score IS NOT NULL) WHERE n = 1)"""


@query(O.query("SELECT doc_id, pos, chapter, page, match_score, line_index AS source_order, x, y, s AS font_size, r AS size_ratio, text AS layout_text, line_page AS layout_page, b AS bold, i AS italic FROM best", *BOOK, _BEST))
def best_page_layout(spark: SparkSession, sf: str) -> DataFrame:
    return attach.best_layout(book_toc(spark, sf), book_lines(spark, sf))


def _better(a: str, b: str) -> str:
    return f"coalesce(({b}) IS NOT NULL AND (({a}) IS NULL OR ({b}) > ({a}) + 5.0), false)"


_OWN = f"{O.title_score(O.match_key('c.chapter'), O.match_key('c.layout_text'), 'c.layout_text', 'c.font_size', 'c.size_ratio', 'c.y')}"
_SOURCED = f"""sourced AS (SELECT doc_id, pos, level, chapter, page, level_reason, {", ".join(f"CASE WHEN better THEN coalesce(n_{c}, {c}) ELSE coalesce({c}, n_{c}) END AS {c}" for c in attach.LAYOUT)} FROM (
  SELECT c.*, {_better(_OWN, O.title_score(O.match_key('c.chapter'), O.match_key('b.text'), 'b.text', 'b.s', 'b.r', 'b.y'))} AS better, b.x AS n_x, b.y AS n_y, b.s AS n_font_size, b.r AS n_size_ratio, b.text AS n_layout_text, b.line_page AS n_layout_page, b.b AS n_bold, b.i AS n_italic, coalesce(b.line_index, c.pos) AS n_source_order
  FROM book_styled c LEFT JOIN best b USING (doc_id, pos)))"""


@query(O.query("SELECT * EXCLUDE (level_reason) FROM sourced", *STYLED, _BEST, _SOURCED))
def source_layouts(spark: SparkSession, sf: str) -> DataFrame:
    return attach.with_source_layout(book_styled(spark, sf), book_lines(spark, sf)).drop("level_reason", "merge_order")


_LOC = "'page=' || l.page || ', line=' || l.line_index || ', s=' || l.s || ', r=' || l.r || ', x=' || l.x || ', y=' || l.y || ': \"' || CASE WHEN length({0}) <= 90 THEN {0} ELSE rtrim({0}[:89]) || '...' END || '\"'".format(O.clean("l.text"))
_EVID = f"evid AS (SELECT e.doc_id, e.pos, k = t AS exact, l.line_index, {_LOC} AS example FROM (SELECT *, {O.match_key('chapter')} AS t FROM book_toc) e JOIN (SELECT *, {O.match_key('text')} AS k FROM book_lines) l ON l.doc_id = e.doc_id AND l.page = e.page AND k <> '' AND contains(k, t) WHERE t <> '')"


@query(O.query("""SELECT doc_id, pos, count(*) FILTER (exact) AS exact_count, count(*) FILTER (NOT exact) AS embedded_count, coalesce(array_to_string(list(example ORDER BY line_index) FILTER (exact)[:3], '; '), '') AS exact_examples,
  coalesce(array_to_string(list(example ORDER BY line_index) FILTER (NOT exact)[:3], '; '), '') AS embedded_examples FROM evid GROUP BY ALL""".replace("list(example ORDER BY line_index) FILTER (exact)[:3]", "(list(example ORDER BY line_index) FILTER (exact))[:3]").replace("list(example ORDER BY line_index) FILTER (NOT exact)[:3]", "(list(example ORDER BY line_index) FILTER (NOT exact))[:3]"), *BOOK, _EVID))
def title_evidences(spark: SparkSession, sf: str) -> DataFrame:
    e = attach.title_evidence(book_toc(spark, sf), book_lines(spark, sf))
    return e.withColumns({c: F.array_join(c, "; ") for c in ("exact_examples", "embedded_examples")})


_VISUAL = r"(?i)^(?:표|그림|figure|fig\.|table|box)\s*[\dIVXivx가-힣.:\-]"
_MARKER = r"(?i)^(?:chapter|part|section|unit)\s*\d+[a-z]?\b|(?i)^제\s*\d+\s*[장절편부]|(?i)^\d+(?:\.\d+)+\b|^\d+\s*[.)]|^\([^)]+\)|(?i)^[a-z]\s*[.)]|^[가-힣]\s*[.)]"


@query(O.query(f"""SELECT doc_id, pos, least(coalesce(sum(caption) FILTER (near), 0), 4) AS visual_caption_count, least(coalesce(sum(small) FILTER (near), 0), 4) AS small_label_count FROM (
  SELECT m.doc_id, m.pos, l.line_index IS NOT NULL AS near, {O.like(O.clean('l.text'), _VISUAL)}::INT AS caption, (NOT {O.like(O.clean('l.text'), _VISUAL)} AND l.r <= 0.9 AND l.s <= 9 AND NOT {O.like(O.clean('l.text'), _MARKER)})::INT AS small
  FROM (SELECT * FROM (SELECT e.doc_id, e.pos, l.page, l.line_index, l.y, row_number() OVER (PARTITION BY e.doc_id, e.pos ORDER BY l.line_index) AS n FROM (SELECT *, {O.match_key('chapter')} AS t FROM book_toc) e JOIN (SELECT *, {O.match_key('text')} AS k FROM book_small) l ON l.doc_id = e.doc_id AND l.page = e.page AND contains(k, t) WHERE t <> '') WHERE n <= 3) m
  LEFT JOIN book_small l ON l.doc_id = m.doc_id AND l.page = m.page AND l.line_index <> m.line_index AND (abs(l.y - m.y) <= 80 OR abs(l.line_index - m.line_index) <= 8)) GROUP BY ALL""", *BOOK, "book_small AS (SELECT * REPLACE (s * 0.7 AS s, r * 0.7 AS r) FROM book_lines)"))
def visual_contexts(spark: SparkSession, sf: str) -> DataFrame:
    small = book_lines(spark, sf).withColumns({c: F.col(c) * 0.7 for c in ("s", "r")})
    return attach.visual_context(book_toc(spark, sf), small)


@query(O.query(f"SELECT DISTINCT l.doc_id, l.page, l.line_index FROM book_lines l JOIN book_lines c ON c.doc_id = l.doc_id AND c.page = l.page AND c.line_index <> l.line_index AND (abs(l.y - c.y) <= 80 OR abs(l.line_index - c.line_index) <= 8) WHERE {O.like(O.clean('c.text'), _VISUAL)}", O.BOOK_LINES))
def lines_near_captions(spark: SparkSession, sf: str) -> DataFrame:
    return attach.near_captions(book_lines(spark, sf))


@query(("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_size + 0.5 WHEN 1 THEN p_size::DOUBLE END AS x, NULL::DOUBLE AS y, (p_size % 7)::DOUBLE AS font_size, 1.25::DOUBLE AS size_ratio, p_name AS layout_text, CASE WHEN p_size % 2 = 0 THEN p_size END AS layout_page, 1 AS bold, NULL::INT AS italic, p_partkey::INT AS source_order FROM part"))
def typed_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Raw entries with old names, texts that are no numbers and numbers that aren't whole."""
    n = F.col("p_size")
    pair = lambda k, v: F.when(v.isNotNull(), F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")))
    raw = F.map_from_entries(F.array_compact(F.array(
        pair("left_indent", F.when(n % 3 == 0, n + 0.5).when(n % 3 == 1, n)), pair("y", F.lit("high")), pair("layout_font_size", n % 7), pair("size_ratio", F.lit(" 1.25 ")), pair("r", F.lit(9)), pair("source_text", F.concat(F.lit(" "), "p_name", F.lit("  "))),
        pair("_layout_page", F.when(n % 2 == 0, n.cast("string")).otherwise(F.concat(n.cast("string"), F.lit(".5")))), pair("b", F.lit(1)), pair("italic", F.lit("no")), pair("source_order", F.col("p_partkey")),
    )))
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", *[c.alias(k) for k, c in attach.typed_layout(raw).items()])


# --- reasons, partial and earlier tables ------------------------------------------------------------

_REF = "refs AS (SELECT doc_id, level, row_number() OVER (PARTITION BY doc_id, level ORDER BY pos) AS rank, chapter AS title, font_size, size_ratio, x, bold, italic FROM book_styled WHERE pos % 3 <> 1 AND pos % 2 = 0)"
_DIST = " + ".join([*(f"coalesce(abs(e.{c} - r.{c}) * {w}, 0)" for c, w in (("font_size", 1.0), ("size_ratio", 8.0), ("x", 0.08))), *(f"CASE WHEN e.{c} <> r.{c} THEN {w} ELSE 0 END" for c, w in (("bold", 2.0), ("italic", 1.0)))])
_CLOSE = "close AS (SELECT * EXCLUDE (n) FROM (SELECT e.doc_id, e.pos, r.level AS closest_level, r.title AS closest_title, round({0}, 6) AS distance, row_number() OVER (PARTITION BY e.doc_id, e.pos ORDER BY round({0}, 6), r.level, r.rank) AS n FROM {1} e JOIN refs r USING (doc_id) WHERE coalesce(e.font_size, e.size_ratio, e.x, e.bold, e.italic) IS NOT NULL) WHERE n = 1)"


def references(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    d = book_styled(spark, sf).where("pos % 3 <> 1 and pos % 2 = 0")
    return d.select("doc_id", "level", F.row_number().over(Window.partitionBy("doc_id", "level").orderBy("pos")).alias("rank"), F.col("chapter").alias("title"), "font_size", "size_ratio", "x", "bold", "italic")


@query(O.query("SELECT doc_id, pos, closest_level, closest_title, distance::DOUBLE AS distance FROM close", *STYLED, _REF, _CLOSE.format(_DIST, "book_styled")))
def closest_references(spark: SparkSession, sf: str) -> DataFrame:
    return attach.closest_reference(book_styled(spark, sf), references(spark, sf))


_KEYS = {"font_size": "s", "size_ratio": "r", "x": "x", "y": "y", "bold": "b", "italic": "i"}
_WORDS = "concat_ws(', ', " + ", ".join(f"'{k}=' || {c}" for c, k in _KEYS.items()) + ")"


@query(O.query(f"""SELECT doc_id, pos, CASE WHEN coalesce(trim(level_reason), '') <> '' THEN level_reason ELSE concat_ws('; ', 'level ' || level || ': ' || CASE level WHEN 1 THEN '상위 장/대단원' WHEN 2 THEN '중간 절/하위 단원' WHEN 3 THEN '소절' ELSE '세부 항목' END || ' 계층으로 분류됨',
    CASE WHEN {_WORDS} <> '' THEN '현재 줄 layout(' || {_WORDS} || ')' ELSE '현재 chunk에서 대응 layout tag를 찾지 못해 제목 계층과 주변 문맥 기준' END,
    CASE WHEN closest_level = level THEN '이전 level ' || level || ' 예시' || CASE WHEN {O.clean('closest_title')} <> '' THEN ' "' || {O.clean('closest_title')} || '"' ELSE '' END || '와 가장 가까운 style 패턴' WHEN closest_level IS NOT NULL THEN '이전 style 기준으로는 level ' || closest_level || '와 가장 가까우나, 현재 문서의 제목 계층/문맥상 level ' || level || '로 유지' ELSE '이전 level style 기준 없음' END) || '.' END AS level_reason
  FROM sourced LEFT JOIN close USING (doc_id, pos)""", *STYLED, _BEST, _SOURCED, _REF, _CLOSE.format(_DIST, "sourced")))
def level_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return attach.add_reasons(book_styled(spark, sf), book_lines(spark, sf), references(spark, sf)).select("doc_id", "pos", "level_reason")


def partials(spark: SparkSession, sf: str) -> DataFrame:
    """Two partial tables that overlap, the second with other layouts."""
    d = book_styled(spark, sf)
    other = d.where("pos % 2 = 1").withColumns({"font_size": F.col("font_size") + 20, "level_reason": F.concat(F.lit("later "), F.col("pos").cast("string"))})
    return d.where("pos % 4 < 3").withColumn("chunk", F.lit(1)).unionByName(other.withColumn("chunk", F.lit(2)))


def bare(spark: SparkSession, sf: str) -> DataFrame:
    """The final table: some layouts and reasons are lost, some texts are others."""
    pos = F.col("pos")
    d = book_styled(spark, sf)
    lost = {c: F.when(pos % 5 < 2, F.col(c)) for c in ("y", "x", "font_size", "size_ratio", "layout_text", "layout_page", "bold", "italic", "source_order", "merge_order")}
    return d.withColumns({**lost, "level_reason": F.when(pos % 2 == 0, F.col("level_reason")), "level": F.when(pos % 6 == 5, F.col("level") + 1).otherwise(F.col("level"))})


_PARTIAL = "partial AS (SELECT *, 1 AS chunk FROM book_styled WHERE pos % 4 < 3 UNION ALL SELECT * REPLACE (font_size + 20 AS font_size, 'later ' || pos AS level_reason), 2 FROM book_styled WHERE pos % 2 = 1)"
_LOST = ("y", "x", "font_size", "size_ratio", "layout_text", "layout_page", "bold", "italic", "source_order", "merge_order")
_BARE = "bare AS (SELECT * REPLACE (" + ", ".join(f"CASE WHEN pos % 5 < 2 THEN {c} END AS {c}" for c in _LOST) + ", CASE WHEN pos % 2 = 0 THEN level_reason END AS level_reason, CASE WHEN pos % 6 = 5 THEN level + 1 ELSE level END AS level) FROM book_styled)"
_FIRSTR = f"firstr AS (SELECT * EXCLUDE (n) FROM (SELECT doc_id, {O.match_key('chapter')} AS key, page, {O.clean('level_reason')} AS reason, level AS reason_level, row_number() OVER (PARTITION BY doc_id, {O.match_key('chapter')}, page ORDER BY chunk, pos) AS n FROM partial WHERE {O.clean('level_reason')} <> '' AND {O.match_key('chapter')} <> '') WHERE n = 1)"
_FIRSTL = f"firstl AS (SELECT * EXCLUDE (n) FROM (SELECT doc_id, {O.match_key('chapter')} AS key, page, {', '.join(attach.CARRIED)}, row_number() OVER (PARTITION BY doc_id, {O.match_key('chapter')}, page ORDER BY chunk, pos) AS n FROM partial WHERE {O.match_key('chapter')} <> '' AND coalesce({', '.join(c + '::VARCHAR' for c in attach.CARRIED)}) IS NOT NULL) WHERE n = 1)"


@query(O.query("SELECT * FROM firstr", *STYLED, _PARTIAL, _FIRSTR))
def partial_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return attach.first_reasons(partials(spark, sf))


@query(O.query("SELECT * FROM firstl", *STYLED, _PARTIAL, _FIRSTL))
def partial_layouts(spark: SparkSession, sf: str) -> DataFrame:
    return attach.first_layouts(partials(spark, sf))


@query(O.query(f"SELECT b.doc_id, b.pos, CASE WHEN {O.clean('level_reason')} = '' AND reason_level = level THEN reason ELSE level_reason END AS level_reason FROM bare b LEFT JOIN firstr f ON f.doc_id = b.doc_id AND f.page = b.page AND f.key = {O.match_key('b.chapter')}", *STYLED, _PARTIAL, _BARE, _FIRSTR))
def reasons_restored(spark: SparkSession, sf: str) -> DataFrame:
    return attach.restore_reasons(bare(spark, sf), partials(spark, sf)).select("doc_id", "pos", "level_reason")


def _restored(name: str, known: str, on: str) -> str:
    other = O.title_score(O.match_key("c.chapter"), O.match_key("k.layout_text"), "k.layout_text", "k.font_size", "k.size_ratio", "k.y")
    kept = ", ".join(f"CASE WHEN better THEN coalesce(k_{c}, {c}) ELSE coalesce({c}, k_{c}) END AS {c}" for c in attach.CARRIED)
    return f"{name} AS (SELECT doc_id, pos, level, chapter, page, level_reason, k_level, k_reason, bold, italic, {kept} FROM (SELECT c.*, {_better(_OWN, other)} AS better, {', '.join(f'k.{c} AS k_{c}' for c in attach.CARRIED)}, k.level AS k_level, k.level_reason AS k_reason FROM bare c LEFT JOIN {known} k ON {on}))"


_LAY = _restored("lay", "(SELECT *, NULL AS level, NULL AS level_reason FROM firstl)", f"k.doc_id = c.doc_id AND k.page = c.page AND k.key = {O.match_key('c.chapter')}")


@query(O.query("SELECT * EXCLUDE (level, chapter, level_reason, k_level, k_reason) REPLACE (coalesce(merge_order, pos) AS merge_order) FROM lay", *STYLED, _PARTIAL, _BARE, _FIRSTL, _LAY))
def layouts_restored(spark: SparkSession, sf: str) -> DataFrame:
    return attach.restore_layouts(bare(spark, sf), partials(spark, sf)).drop("level", "chapter", "level_reason")


_LASTS = f"lasts AS (SELECT * EXCLUDE (n) FROM (SELECT *, {O.match_key('chapter')} AS key, row_number() OVER (PARTITION BY doc_id, {O.match_key('chapter')}, page ORDER BY pos DESC) AS n FROM book_styled WHERE {O.match_key('chapter')} <> '') WHERE n = 1)"
_SRC = _restored("src", "lasts", f"k.doc_id = c.doc_id AND k.page = c.page AND k.key = {O.match_key('c.chapter')}")


@query(O.query("SELECT * EXCLUDE (chapter, k_level, k_reason) REPLACE (CASE WHEN level_reason IS NULL AND k_level = level THEN k_reason ELSE level_reason END AS level_reason) FROM src", *STYLED, _BARE, _LASTS, _SRC))
def metadata_restored(spark: SparkSession, sf: str) -> DataFrame:
    return attach.restore_from_source(bare(spark, sf), book_styled(spark, sf)).drop("chapter")


_ORDER = """page, CASE WHEN source_order IS NOT NULL THEN 0 WHEN merge_order IS NOT NULL THEN 1 WHEN y IS NOT NULL THEN 2 ELSE 3 END, coalesce(source_order, merge_order, y, 999999),
  CASE WHEN coalesce(source_order, merge_order) IS NOT NULL THEN coalesce(y, 999999) ELSE coalesce(x, 999999) END, CASE WHEN coalesce(source_order, merge_order) IS NOT NULL THEN coalesce(x, 999999) ELSE 999999 END, level"""


def _validated(rows: str, depth: int) -> str:
    return f"SELECT doc_id, pos, greatest(1, least(level, {depth})) AS level, {O.clean('chapter')} AS chapter, greatest(page, 1) AS page FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, {O.match_key('chapter')}, greatest(page, 1) ORDER BY pos) AS n FROM {rows} WHERE {O.clean('chapter')} <> '') WHERE n = 1"


@query(O.query(_validated("ordered", 3), *STYLED, _PARTIAL, "placed AS (SELECT * REPLACE (coalesce(merge_order, row_number() OVER (PARTITION BY doc_id ORDER BY chunk, pos) - 1) AS merge_order), pos AS old FROM partial)", f"ordered AS (SELECT * REPLACE (row_number() OVER (PARTITION BY doc_id ORDER BY {_ORDER}, chunk, old) - 1 AS pos) FROM placed)"))
def partials_merged_locally(spark: SparkSession, sf: str) -> DataFrame:
    return attach.merge_locally(partials(spark, sf), 3).select("doc_id", "pos", "level", "chapter", "page")


@query(O.query(_validated("ordered", 6), *STYLED, _PARTIAL, _BARE, _FIRSTL, _LAY, "placed AS (SELECT * REPLACE (coalesce(merge_order, pos) AS merge_order), pos AS old FROM lay)", f"ordered AS (SELECT * REPLACE (row_number() OVER (PARTITION BY doc_id ORDER BY {_ORDER}, old) - 1 AS pos) FROM placed)"))
def sorted_by_restored_layout(spark: SparkSession, sf: str) -> DataFrame:
    return attach.sort_restored(bare(spark, sf), partials(spark, sf)).select("doc_id", "pos", "level", "chapter", "page")


@query(O.query(f"SELECT doc_id, list_sort(list(DISTINCT {O.match_key('chapter')})) AS titles FROM book_toc WHERE {O.match_key('chapter')} <> '' GROUP BY ALL".replace("list_sort(list(DISTINCT", "array_to_string(list_sort(list(DISTINCT").replace(")) AS titles", ")), '|') AS titles"), *BOOK))
def normalized_titles(spark: SparkSession, sf: str) -> DataFrame:
    d = book_toc(spark, sf).select("doc_id", match_key("chapter").alias("k")).where("k <> ''")
    return d.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("k")), "|").alias("titles"))
