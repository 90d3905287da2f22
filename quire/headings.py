"""Queries over broken headings: what numbers and words say about a line, fragments put together, levels, titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles as O
from .books import Query, book_lines
from .functions import predicates as P
from .functions.numbering import number_info, prefix_info
from .functions.text import settled
from .operators import fragments as G
from .session import spread

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def pieces(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    pos = key % 40
    step = (20 + F.floor(pos / 10) * 30).cast("double")
    y0 = 40 + key % 10 * step
    kind = (key * 7 + F.col("p_size")) % len(O._PIECES)
    # The texts' expressions are the same in both languages.
    text = F.expr("CASE kind " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(O._PIECES)) + " END")
    d = settled(spread(spark.read.parquet(f"{sf}/part.parquet")).withColumn("kind", kind), {"text": text})
    n = F.col("p_size")
    return d.select(
        F.floor(key / 40).alias("doc_id"), pos.cast("int").alias("pos"), pos.cast("int").alias("line_index"), (F.floor(pos / 10) + 1).cast("int").alias("page"), (10 + n % 5).cast("double").alias("s"), (n % 2).cast("int").alias("b"), F.lit(0).alias("i"),
        (60 + n % 3 * 40).cast("double").alias("x0"), y0.alias("y0"), (200 + n).cast("double").alias("x1"), (y0 + 12).alias("y1"), F.lit(595.0).alias("page_width"), (n % 11).cast("double").alias("score"), (n % 6 + 1).cast("int").alias("level"), "text",
    )


V = O.numbered("pieces")
_PREFIX = r"^(\d+(?:\.\d+){1,5})\.?$"


@query(O.query("SELECT doc_id, pos, is_numbered, fixed, CASE WHEN NOT bad THEN fixed END AS numbered, lone, after_number, after_plain, label, bad_fragment, bad, ref_head, ref_item FROM v", O.PIECES, V))
def heading_numbers(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    d = settled(pieces(spark, sf).select("doc_id", "pos", "text"), {"f": P.heading_facts(t)})
    return d.select(
        "doc_id", "pos", F.col("f.numbered").alias("is_numbered"), F.col("f.fixed_level").alias("fixed"), F.col("f.numbered_level").alias("numbered"), F.col("f.lone").alias("lone"), P.merges_after_number(t).alias("after_number"), P.merges_after_plain(t).alias("after_plain"),
        G.label_kind(t).alias("label"), F.col("f.bad_fragment").alias("bad_fragment"), F.col("f.bad").alias("bad"), F.col("f.reference_heading").alias("ref_head"), F.col("f.reference_item").alias("ref_item"),
    )


_ALONE = f"""alone AS (SELECT *, CASE WHEN {O.like('c', _PREFIX)} THEN regexp_extract(c, '{_PREFIX}', 1) WHEN {O.like('c', r'^[0-9]{1,2}[.]$')} THEN trim(c, '.')::INT || '.' WHEN {O.like('c', r'^[(][0-9]{1,2}[)]$')} THEN '(' || trim(c, '()')::INT || ')' WHEN {O.like('c', r'^[0-9]{1,2}[)]$')} THEN trim(c, ')')::INT || ')' END AS num,
  CASE WHEN {O.like('c', _PREFIX)} THEN least(3 + length(c) - length(replace(c, '.', '')) - CASE WHEN suffix(c, '.') THEN 1 ELSE 0 END, 6) WHEN {O.like('c', r'^[0-9]{1,2}[.]$')} THEN 3 END AS alone_level FROM v)"""


@query(O.query("SELECT doc_id, pos, num AS number_text, alone_level::INT AS level FROM alone", O.PIECES, V, _ALONE))
def number_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    return pieces(spark, sf).select("doc_id", "pos", prefix_info(F.col("text")).alias("n")).select("doc_id", "pos", "n.number_text", "n.level")


_WALK = """walk AS (SELECT *, false AS taken, joins AS first FROM w1 WHERE place = 1 UNION ALL SELECT n.*, w.first AS taken, n.joins AND NOT w.first AS first FROM walk w JOIN w1 n ON n.doc_id = w.doc_id AND n.page = w.page AND n.place = w.place + 1)"""
_NUMS = """w1 AS (SELECT *, row_number() OVER k AS place, coalesce(num IS NOT NULL AND lead(style IS NULL AND NOT front_back AND NOT page_mark AND NOT ref_head AND NOT formula) OVER k AND greatest(0, lead(y0) OVER k - y1) <= greatest(s * 3, 60), false) AS joins FROM alone WINDOW k AS (PARTITION BY doc_id, page ORDER BY y0, x0, line_index))"""


@query("WITH RECURSIVE " + ",".join([O.PIECES, V, _ALONE, _NUMS, _WALK]) + """
SELECT a.doc_id, a.page, CASE WHEN a.first THEN n.line_index ELSE a.line_index END AS line_index, CASE WHEN a.first THEN a.num || ' ' || n.c ELSE a.text END AS text, CASE WHEN a.first THEN greatest(a.s, n.s) ELSE a.s END AS s,
  CASE WHEN a.first THEN greatest(a.b, n.b) ELSE a.b END AS b, CASE WHEN a.first THEN least(a.x0, n.x0) ELSE a.x0 END AS x0, CASE WHEN a.first THEN greatest(a.y1, n.y1) ELSE a.y1 END AS y1
FROM walk a LEFT JOIN walk n ON n.doc_id = a.doc_id AND n.page = a.page AND n.place = a.place + 1 WHERE a.first OR (a.num IS NULL AND NOT a.taken)""")
def number_lines_merged(spark: SparkSession, sf: str) -> DataFrame:
    return G.merge_number_lines(pieces(spark, sf)).select("doc_id", "page", "line_index", "text", "s", "b", "x0", "y1")


_TAKE = """t1 AS (SELECT *, coalesce(style LIKE 'arabic_decimal%' AND length(k) > 40 AND lag(style) OVER o IS NULL AND NOT lag(bad) OVER o AND length(lag(k) OVER o) BETWEEN 1 AND 20 AND greatest(0, y0 - lag(y1) OVER o) <= greatest(s * 2, 40) AND abs(x0 - lag(x0) OVER o) <= page_width * 0.2, false) AS takes,
  lag(c) OVER o AS pc, lag(s) OVER o AS ps, lag(b) OVER o AS pb, lag(x0) OVER o AS px0, lag(y0) OVER o AS py0 FROM v WINDOW o AS (PARTITION BY doc_id, page ORDER BY y0, x0, line_index))"""


@query(O.query("""SELECT doc_id, page, line_index, CASE WHEN takes THEN number_text || ' ' || pc ELSE text END AS text, CASE WHEN takes THEN greatest(s, ps) ELSE s END AS s, CASE WHEN takes THEN greatest(b, pb) ELSE b END AS b, CASE WHEN takes THEN least(x0, px0) ELSE x0 END AS x0, CASE WHEN takes THEN least(y0, py0) ELSE y0 END AS y0
  FROM (SELECT *, coalesce(lead(takes) OVER (PARTITION BY doc_id, page ORDER BY y0, x0, line_index), false) AS goes FROM t1) WHERE NOT goes""", O.PIECES, V, _TAKE))
def decimal_lines_merged(spark: SparkSession, sf: str) -> DataFrame:
    return G.merge_decimal_lines(pieces(spark, sf)).select("doc_id", "page", "line_index", "text", "s", "b", "x0", "y0")


_GLUE = "CASE WHEN {b} = '' THEN {a} WHEN regexp_matches(replace({a}, ' ', ''), '\\p{{Nd}}$') AND regexp_matches({b}, '^[\\x{{AC00}}-\\x{{D7A3}}\\x{{3130}}-\\x{{318F}}\\x{{1100}}-\\x{{11FF}}\\x{{4E00}}-\\x{{9FFF}}]') THEN {a} || replace({b}, ' ', '') WHEN regexp_matches({a}, '(?:과|와|및|의|에|로|으로)$') THEN {a} || {b} ELSE {a} || ' ' || {b} END"
_TWO = _GLUE.format(a="c", b="c1")
_LABELS = f"""l1 AS (SELECT *, CASE WHEN label IN ('편', '부') THEN 2 WHEN label IS NOT NULL OR after_number OR after_plain THEN 1 ELSE 0 END AS most, NOT bad AND label IS NULL AND style IS NULL AS follows FROM v),
l2 AS (SELECT *, coalesce(lead(page) OVER o = page AND lead(y0) OVER o >= y0 AND lead(follows) OVER o AND lead(y0) OVER o - y1 <= greatest(s * 3, 60), false) AS fit1,
  coalesce(lead(page, 2) OVER o = page AND lead(y0, 2) OVER o >= y0 AND lead(follows, 2) OVER o AND lead(y0, 2) OVER o - lead(y1) OVER o <= greatest(s * 3, 60), false) AS fit2, lead(c) OVER o AS c1, lead(c, 2) OVER o AS c2, lead(s) OVER o AS s1, lead(s, 2) OVER o AS s2, lead(score) OVER o AS r1, lead(score, 2) OVER o AS r2, row_number() OVER o AS place
  FROM l1 WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
l3 AS (SELECT *, CASE WHEN most >= 2 AND fit1 AND fit2 THEN 2 WHEN most >= 1 AND fit1 THEN 1 ELSE 0 END AS n FROM l2),
l4 AS (SELECT *, 0 AS skip FROM l3 WHERE place = 1 UNION ALL SELECT x.*, CASE WHEN w.skip = 0 THEN w.n ELSE w.skip - 1 END AS skip FROM l4 w JOIN l3 x ON x.doc_id = w.doc_id AND x.place = w.place + 1),
merged AS (SELECT doc_id, page, pos, CASE n WHEN 2 THEN {_GLUE.format(a='two', b='c2')} WHEN 1 THEN two ELSE text END AS text, CASE n WHEN 2 THEN greatest(s, s1, s2) WHEN 1 THEN greatest(s, s1) ELSE s END AS s, CASE n WHEN 2 THEN greatest(score, r1, r2) WHEN 1 THEN greatest(score, r1) ELSE score END AS score, y0, level
  FROM (SELECT *, {_TWO} AS two FROM l4) WHERE skip = 0)"""
_REC = "WITH RECURSIVE " + ",".join([O.PIECES, V, _LABELS])


@query(_REC + " SELECT doc_id, page, pos, text, s, score FROM merged")
def labels_merged(spark: SparkSession, sf: str) -> DataFrame:
    return G.merge_labels(pieces(spark, sf)).select("doc_id", "page", "pos", "text", "s", "score")


_CHAPTERS = "chapters AS (SELECT doc_id, pos, level, text FROM pieces)"
_CV = O.numbered("chapters", "h")
_KEPT = "kept AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place FROM h WHERE NOT bad AND NOT lone)"


def _limit(source: str, name: str, level: str, depth: int) -> str:
    given = f"CASE WHEN style IN ('arabic_paren', 'arabic_paren_wrap') THEN greatest(1, least({level}, {depth})) WHEN fixed IS NOT NULL THEN greatest(1, least(fixed, {depth})) END"
    own = f"greatest(1, least({level}, {depth}))"
    return f"{name} AS (SELECT *, coalesce({given}, {own})::INT AS {name}_level FROM {source} WHERE place = 1 UNION ALL SELECT x.*, coalesce({given.replace(level, 'x.' + level).replace('style', 'x.style').replace('fixed', 'x.fixed')}, least(greatest(1, least(x.{level}, {depth})), w.{name}_level + 1))::INT FROM {name} w JOIN {source} x ON x.doc_id = w.doc_id AND x.place = w.place + 1)"


def _context(source: str, name: str, level: str, depth: int) -> str:
    def arm(x: str, before: str, last: str, below: str) -> tuple[str, str]:
        own = f"greatest(1, least({x}{level}, {depth}))"
        style = f"coalesce({x}style, '')"
        new = f"""CASE WHEN {style} = 'ko_part' THEN 1 WHEN {style} = 'ko_chapter' THEN 2 WHEN {style} IN ('ko_section', 'arabic_dot') THEN 3 WHEN {style} LIKE 'arabic_decimal%' THEN greatest(4, least({x}num_level, {depth}))
      WHEN {style} = 'arabic_paren_wrap' THEN CASE WHEN {depth} >= 6 AND ({below} OR ({before} = 'arabic_paren' AND {last} = 5)) THEN 6 ELSE least(5, {depth}) END WHEN {style} = 'arabic_paren' THEN CASE WHEN {below} AND {depth} >= 5 THEN 5 ELSE least(4, {depth}) END
      WHEN {last} IN (3, 4) AND {own} <= {last} THEN 4 ELSE {own} END"""
        under = f"CASE WHEN {style} IN ('ko_part', 'ko_chapter', 'ko_section', 'arabic_dot') THEN false WHEN {style} LIKE 'arabic_decimal%' THEN true WHEN {style} IN ('arabic_paren', 'arabic_paren_wrap') THEN {below} WHEN {last} IN (3, 4) AND {own} <= {last} THEN true ELSE {own} >= 4 END"
        return f"greatest(1, least({new}, {depth}))::INT", under

    a, b = arm("", "''", "0", "false"), arm("x.", "coalesce(w.style, '')", f"w.{name}_level", f"w.{name}_below")
    return f"{name} AS (SELECT *, {a[0]} AS {name}_level, {a[1]} AS {name}_below FROM {source} WHERE place = 1 UNION ALL SELECT x.*, {b[0]}, {b[1]} FROM {name} w JOIN {source} x ON x.doc_id = w.doc_id AND x.place = w.place + 1)"


_HEAD = [O.PIECES, _CHAPTERS, _CV]
_ALL = "every AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place FROM h)"


def chapters(spark: SparkSession, sf: str) -> DataFrame:
    return pieces(spark, sf).select("doc_id", "pos", "level", F.col("text").alias("chapter"))


@query(O.query("SELECT doc_id, pos, (CASE WHEN fixed IS NOT NULL THEN least(fixed, 5) ELSE greatest(1, least(level, 5)) END)::INT AS level, c AS chapter FROM h", *_HEAD))
def number_levels(spark: SparkSession, sf: str) -> DataFrame:
    return G.enforce_number_levels(chapters(spark, sf), 5)


@query("WITH RECURSIVE " + ",".join([*_HEAD, _ALL, _limit("every", "lim", "level", 6)]) + " SELECT doc_id, pos, lim_level AS level FROM lim")
def limited_levels(spark: SparkSession, sf: str) -> DataFrame:
    return G.limit_jumps(chapters(spark, sf)).select("doc_id", "pos", "level")


@query("WITH RECURSIVE " + ",".join([*_HEAD, _ALL, _context("every", "ctx", "level", 6)]) + " SELECT doc_id, pos, ctx_level AS level FROM ctx")
def contextual_levels(spark: SparkSession, sf: str) -> DataFrame:
    return G.contextual_levels(chapters(spark, sf)).select("doc_id", "pos", "level")


_ENF = "enf AS (SELECT *, coalesce(fixed, greatest(1, least(level, 6)))::INT AS enf_level FROM kept)"
_FINISH = [_ENF, _limit("enf", "l_a", "enf_level", 6), _context("l_a", "l_b", "l_a_level", 6), _limit("l_b", "l_c", "l_b_level", 6)]


@query("WITH RECURSIVE " + ",".join([*_HEAD, _KEPT, *_FINISH]) + " SELECT doc_id, pos, l_c_level AS level, c AS chapter FROM l_c")
def finished_chapters(spark: SparkSession, sf: str) -> DataFrame:
    return G.finish(chapters(spark, sf))


@query("WITH RECURSIVE " + ",".join([O.PIECES, "chapters AS (SELECT doc_id, pos, CASE WHEN pos % 11 = 3 THEN NULL WHEN pos % 5 = 4 THEN 1 ELSE level END AS level, pos % 7 = 6 AS bad_page, page, text FROM pieces WHERE pos % 11 <> 3)", _CV, _KEPT.replace("NOT bad AND", "NOT bad_page AND NOT bad AND"), *_FINISH]) + " SELECT doc_id, pos, l_c_level AS level, c AS chapter, page FROM l_c")
def strictly_validated(spark: SparkSession, sf: str) -> DataFrame:
    """Levels that are missing (1), and levels and pages that are no numbers (gone)."""
    p = pieces(spark, sf)
    level = F.when(F.col("pos") % 11 == 3, "two").when(F.col("pos") % 5 == 4, None).otherwise(F.col("level").cast("string"))
    raw = p.select("doc_id", "pos", level.alias("level"), F.col("text").alias("chapter"), F.when(F.col("pos") % 7 == 6, "vii").otherwise(F.col("page").cast("string")).alias("page"))
    return G.validate_strict(raw)


_SIZES = """szs AS (SELECT doc_id, list_sort(list(DISTINCT round(s, 1)), 'DESC') AS l FROM (SELECT doc_id, s * 1.2 - pos % 7 * 0.4 AS s FROM pieces) GROUP BY doc_id),
cl AS (SELECT doc_id, l, 1 AS k, [l[1]] AS cur, []::DOUBLE[] AS done FROM szs UNION ALL SELECT doc_id, l, k + 1, CASE WHEN abs(l[k + 1] - (list_sum(cur) / len(cur))) <= 0.6 THEN list_append(cur, l[k + 1]) ELSE [l[k + 1]] END, CASE WHEN abs(l[k + 1] - (list_sum(cur) / len(cur))) <= 0.6 THEN done ELSE list_append(done, round((list_sum(cur) / len(cur)), 1)) END FROM cl WHERE k < len(l))"""


@query("WITH RECURSIVE " + ",".join([O.PIECES, _SIZES]) + " SELECT doc_id, array_to_string(list_append(done, round((list_sum(cur) / len(cur)), 1))[:5], ' ') AS clusters FROM cl WHERE k = len(l)")
def size_clusters(spark: SparkSession, sf: str) -> DataFrame:
    d = pieces(spark, sf).withColumn("s", F.col("s") * 1.2 - F.col("pos") % 7 * 0.4)
    return G.size_clusters(d).select("doc_id", F.array_join(F.transform("clusters", lambda x: x.cast("string")), " ").alias("clusters"))


@query()
def built_chapters(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates to chapters: merged, by type size or number, finished."""
    p = pieces(spark, sf)
    ids = p.select("doc_id").distinct()
    return G.build_chapters(p, ids.withColumn("title", F.lit("1. small ring")), ids.withColumn("body_size", F.lit(10.0)))


_BEST = """firsts AS (SELECT doc_id, min(page) AS page FROM pieces GROUP BY doc_id),
cand AS (SELECT * FROM (SELECT v.*, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, score DESC, y0, line_index) AS n FROM v SEMI JOIN firsts USING (doc_id, page) WHERE y0 / 842 < 0.7 AND length(text) <= 120 AND NOT bad AND score >= 5 AND NOT regexp_matches(c, '(?i)^(?:그림|도표|표)\\s*\\d+[-.\\s]|(?i)^(?:figure|fig\\.?|table)\\s*\\d+[-.\\s:]')) WHERE n = 1),
lin AS (SELECT * FROM (SELECT v.*, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, b DESC, y0, line_index) AS n FROM v SEMI JOIN firsts USING (doc_id, page) WHERE y0 / 842 < 0.7 AND length(text) BETWEEN 3 AND 120 AND NOT bad) WHERE n = 1)"""
_METAS = ["Good title", "Untitled", "<ABCDEF0123.hwp>", "", "stem %d", "abcdefABCDEF", "a_very_long_file_name_for_a.PDF", "A + B"]


@query(O.query(f"""SELECT f.doc_id, CASE WHEN f.doc_id % 8 = 0 THEN 'Good title' WHEN c.s >= 12.2 OR c.b > 0 THEN c.text WHEN l.s >= 12.2 OR l.b > 0 THEN l.text ELSE 'stem ' || f.doc_id END AS title FROM firsts f LEFT JOIN cand c USING (doc_id) LEFT JOIN lin l USING (doc_id)""", O.PIECES, V, _BEST))
def inferred_titles(spark: SparkSession, sf: str) -> DataFrame:
    p = pieces(spark, sf).withColumn("rel_y0", F.col("y0") / 842)
    k = F.col("doc_id") % 8
    meta = F.lit(None).cast("string")
    for n, m in enumerate(_METAS):
        meta = F.when(k == n, F.concat(F.lit("stem "), F.col("doc_id").cast("string")) if "%d" in m else F.lit(m)).otherwise(meta)
    docs = p.select("doc_id").distinct().select("doc_id", meta.alias("metadata_title"), F.concat(F.lit("stem "), F.col("doc_id").cast("string")).alias("stem"), F.lit(11.0).alias("body_size"))
    return G.infer_titles(docs, p.where("score >= 5"), p)


_DOCV = O.numbered("book_lines")


@query(O.query("SELECT doc_id, line_index, noise, bad AS bad_heading, page_mark AS page_marker, formula FROM v", O.BOOK_LINES, _DOCV))
def heading_vetoes(spark: SparkSession, sf: str) -> DataFrame:
    d = settled(book_lines(spark, sf).select("doc_id", "line_index", "text"), {"f": P.heading_facts(F.col("text"))})
    return d.select("doc_id", "line_index", F.col("f.noise").alias("noise"), F.col("f.bad").alias("bad_heading"), F.col("f.page_marker").alias("page_marker"), F.col("f.formula").alias("formula"))


@query(O.query("SELECT doc_id, line_index, style, number_text, body, num_level AS level FROM v", O.BOOK_LINES, _DOCV))
def line_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return book_lines(spark, sf).select("doc_id", "line_index", number_info(F.col("text")).alias("n")).select("doc_id", "line_index", "n.style", "n.number_text", "n.body", "n.level")
