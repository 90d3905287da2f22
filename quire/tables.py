"""Queries over tables of contents: rules, references, outlines, ranges, duplicates, and which files belong together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles as O
from .books import BOOK, STYLED, Query, book_lines, book_styled, book_toc
from .operators import jobs, rules, toc

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- learned rules ------------------------------------------------------------------------------

_SCORE = "CASE WHEN w = a THEN 4 WHEN contains(w, a) THEN 3 WHEN suffix(a, w) AND length(w) >= 4 THEN 2 WHEN suffix(w, a) AND length(a) >= 4 THEN 1 ELSE 0 END"
#: Some titles run over two lines, some over three.
_REFS = f"refs AS (SELECT t.doc_id, t.pos, t.level, t.page, {O.clean('CASE t.pos % 5 WHEN 4 THEN l.text || l2.text WHEN 3 THEN l.text || l2.text || coalesce(l3.text, chr(32)) ELSE t.chapter END')} AS chapter FROM book_toc t JOIN book_lines l ON l.doc_id = t.doc_id AND l.line_index = t.pos * 2 LEFT JOIN book_lines l2 ON l2.doc_id = t.doc_id AND l2.line_index = t.pos * 2 + 1 LEFT JOIN book_lines l3 ON l3.doc_id = t.doc_id AND l3.line_index = t.pos * 2 + 2 WHERE t.pos % 5 < 3 OR l2.text IS NOT NULL)"
_MATCH = f"""ln AS (SELECT *, {O.norm('text')} AS w, length({O.norm('text')}) AS n FROM book_lines),
rf AS (SELECT *, {O.norm('chapter')} AS a FROM refs WHERE chapter <> ''),
m1 AS (SELECT * EXCLUDE (k) FROM (SELECT rf.doc_id, rf.pos, rf.level, rf.chapter, rf.page, {_SCORE} AS score, l.source_order, l.s, l.r, l.x, l.y, l.b, l.i, l.f, l.text, row_number() OVER (PARTITION BY rf.doc_id, rf.pos ORDER BY {_SCORE} DESC, n DESC, l.s DESC, l.source_order) AS k FROM rf JOIN ln l ON l.doc_id = rf.doc_id AND l.page = rf.page WHERE {_SCORE} > 0) WHERE k = 1)"""
_LIST = "list({c}) OVER (PARTITION BY doc_id, page ORDER BY source_order ROWS BETWEEN CURRENT ROW AND {k} FOLLOWING)"
_SPANS = f"""sp AS (SELECT doc_id, page, source_order AS start, sz, items[:sz] AS items FROM (SELECT doc_id, page, source_order, list(struct_pack(s := s, n := n, back := -source_order, source_order := source_order, r := r, x := x, y := y, b := b, i := i, f := f, text := text)) OVER (PARTITION BY doc_id, page ORDER BY source_order ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS items FROM ln), (VALUES (2), (3), (4)) v(sz) WHERE len(items) >= sz),
sq AS (SELECT doc_id, page, start, sz, {O.norm("array_to_string(list_transform(items, lambda q: q.text), ' ')")} AS w, list_max(CASE WHEN len(list_filter(items, lambda q: q.n >= 4)) > 0 THEN list_filter(items, lambda q: q.n >= 4) ELSE items END) AS rep FROM sp),
m2 AS (SELECT doc_id, pos, level, chapter, page, score, rep.source_order, rep.s, rep.r, rep.x, rep.y, rep.b, rep.i, rep.f, rep.text FROM (SELECT rf.doc_id, rf.pos, rf.level, rf.chapter, rf.page, {_SCORE} AS score, rep, row_number() OVER (PARTITION BY rf.doc_id, rf.pos ORDER BY {_SCORE} DESC, abs(length(w) - length(a)), sz, rep.s DESC, start) AS k FROM rf JOIN sq ON sq.doc_id = rf.doc_id AND sq.page = rf.page WHERE {_SCORE} > 0 AND (rf.doc_id, rf.pos) NOT IN (SELECT doc_id, pos FROM m1)) WHERE k = 1),
matched AS (SELECT * FROM m1 UNION ALL SELECT * FROM m2)"""
_RULES = f"""shaped AS (SELECT *, {O.shape("coalesce(list_filter(regexp_extract_all(text, '\\S+'), lambda t: " + O.norm('t') + " <> '' AND contains(" + O.norm('chapter') + ", " + O.norm('t') + "))[1], regexp_extract(chapter, '\\S+'))")} AS shape FROM matched),
rules AS (SELECT level, s, r, b, i, f, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max, list_sort(list(DISTINCT shape)) AS start_shapes, count(*) AS reference_count, list(chapter ORDER BY doc_id, pos)[:8] AS examples FROM shaped GROUP BY level, s, r, b, i, f)""".replace("list(chapter ORDER BY doc_id, pos)[:8]", "(list(chapter ORDER BY doc_id, pos))[:8]")
LEARNED = (*BOOK, _REFS, _MATCH, _SPANS, _RULES)


def references(spark: SparkSession, sf: str) -> DataFrame:
    from .functions.text import clean_text, settled

    ln = book_lines(spark, sf)
    line = lambda k: ln.select("doc_id", (F.col("line_index") - k).alias("_at"), F.col("text").alias(f"_{k}"))
    t = book_toc(spark, sf).withColumn("_at", F.col("pos") * 2)
    for k in range(3):
        t = t.join(line(k), ["doc_id", "_at"], "left")
    k = F.col("pos") % 5
    t = settled(t.where("pos % 5 < 3 or _1 is not null").withColumnRenamed("chapter", "_was"), {"chapter": clean_text(F.when(k == 4, F.concat("_0", "_1")).when(k == 3, F.concat("_0", "_1", F.coalesce("_2", F.lit(" ")))).otherwise(F.col("_was")))})
    return t.select("doc_id", "pos", "level", "page", "chapter")


@query(O.query("SELECT * EXCLUDE (start_shapes, examples), array_to_string(start_shapes, ' ') AS start_shapes, array_to_string(examples, '|') AS examples FROM rules", *LEARNED))
def learned_rules(spark: SparkSession, sf: str) -> DataFrame:
    r = rules.learn_rules(references(spark, sf), book_lines(spark, sf), spans=True)
    return r.withColumns({"start_shapes": F.array_join("start_shapes", " "), "examples": F.array_join("examples", "|")})


@query(O.query("SELECT doc_id, pos, page, score, source_order, s, text FROM matched", *LEARNED[:-1]))
def reference_lines(spark: SparkSession, sf: str) -> DataFrame:
    return rules.match_reference(references(spark, sf), book_lines(spark, sf), spans=True).select("doc_id", "pos", "page", "score", "source_order", "s", "text")


@query(O.query("SELECT doc_id, pos, level, page, chapter FROM refs WHERE (doc_id, pos) NOT IN (SELECT doc_id, pos FROM m1)", *LEARNED[:-2]))
def unmatched_references(spark: SparkSession, sf: str) -> DataFrame:
    return rules.unmatched(references(spark, sf), book_lines(spark, sf))


@query(O.query(f"""SELECT doc_id, page, source_order, level, chapter FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, {O.norm('chapter')} ORDER BY source_order) AS n FROM (
  SELECT doc_id, page, source_order, level, array_to_string(words[spot:len(words)], ' ') AS chapter, row_number() OVER (PARTITION BY doc_id, page, source_order ORDER BY distance, level, -rs, f, rr) AS k FROM (
    SELECT l.doc_id, l.page, l.source_order, l.f, r.level, r.s AS rs, r.r AS rr, words, list_min(list_filter(list_transform(shapes, lambda z, j: CASE WHEN list_contains(r.start_shapes, z) THEN j END), lambda z: z IS NOT NULL)) AS spot, round(abs(l.s - r.s) + 0.2 * abs(l.r - r.r) + 0.002 * abs(l.x - (r.x_min + r.x_max) / 2), 9) AS distance
    FROM (SELECT *, list_transform(words, lambda z: {O.shape('z')}) AS shapes FROM (SELECT *, regexp_extract_all({O.clean('text')}, '\\S+') AS words FROM book_lines)) l JOIN rules r ON r.b = l.b AND r.i = l.i AND r.f = l.f AND abs(l.s - r.s) <= 0.02 AND abs(l.r - r.r) <= 0.02) WHERE spot IS NOT NULL) WHERE k = 1) WHERE n = 1""", *LEARNED))
def rule_toc(spark: SparkSession, sf: str) -> DataFrame:
    d = book_lines(spark, sf)
    return rules.apply_rules(d, rules.learn_rules(references(spark, sf), d, spans=True))


# --- references of levels, gaps ---------------------------------------------------------------------

_STYLES = "styles AS (SELECT * REPLACE (CASE WHEN pos % 17 = 4 THEN font_size * 2 WHEN pos % 13 = 5 THEN font_size * 0.5 ELSE font_size END AS font_size, CASE WHEN pos % 17 = 4 THEN size_ratio * 2 WHEN pos % 13 = 5 THEN size_ratio * 0.5 ELSE size_ratio END AS size_ratio) FROM book_styled)"
_OUT = """outs AS (SELECT *, font_size IS NOT NULL AND size_ratio IS NOT NULL AND ((mf >= 12 AND font_size < mf * 0.7 AND mr >= 1.25 AND size_ratio < mr * 0.75) OR (mr >= 1.5 AND size_ratio <= 1.12 AND font_size < mf * 0.9) OR (mf >= 8 AND mr >= 0.8 AND font_size > mf * 1.8 AND size_ratio > mr * 1.8)) AS outlier FROM styles
  LEFT JOIN (SELECT doc_id, level, median(font_size) AS mf, median(size_ratio) AS mr, count(*) AS styled FROM styles WHERE font_size IS NOT NULL AND size_ratio IS NOT NULL GROUP BY ALL) USING (doc_id, level))"""


def styles(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("pos")
    odd = lambda c: F.when(p % 17 == 4, F.col(c) * 2).when(p % 13 == 5, F.col(c) * 0.5).otherwise(F.col(c))
    return book_styled(spark, sf).withColumns({c: odd(c) for c in ("font_size", "size_ratio")})


@query(O.query("SELECT doc_id, pos, level, mf AS median_font, coalesce(outlier, false) AS outlier FROM outs", *STYLED, _STYLES, _OUT))
def style_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return toc.style_outliers(styles(spark, sf)).select("doc_id", "pos", "level", "median_font", "outlier")


@query(O.query("SELECT doc_id, pos, level, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, level ORDER BY pos) AS rank FROM (SELECT *, bool_and(coalesce(outlier, false)) OVER (PARTITION BY doc_id, level) AS everyone FROM outs) WHERE NOT (coalesce(styled, 0) >= 3 AND NOT everyone AND coalesce(outlier, false))) WHERE rank <= 5", *STYLED, _STYLES, _OUT))
def level_reference_examples(spark: SparkSession, sf: str) -> DataFrame:
    return toc.reference_examples(styles(spark, sf)).select("doc_id", "pos", "level", "rank")


@query()
def running_level_references(spark: SparkSession, sf: str) -> DataFrame:
    return toc.level_references(styles(spark, sf))


_GAPS = """gaps AS (SELECT doc_id, n + 1 AS first, nx - 1 AS last, before, after FROM (SELECT doc_id, n, before, lead(n) OVER w AS nx, lead(before) OVER w AS after
  FROM (SELECT doc_id, l_quantity::INT AS n, arg_max('1.' || l_quantity::INT || ' line ' || pos, pos) AS before FROM hierarchy GROUP BY ALL) WINDOW w AS (PARTITION BY doc_id ORDER BY n)) WHERE nx > n + 1)"""


def gap_rows(spark: SparkSession, sf: str) -> DataFrame:
    from .catalog import hierarchy

    return hierarchy(spark, sf).select("doc_id", "pos", F.concat(F.lit("1."), F.col("l_quantity").cast("int"), F.lit(" line "), F.col("pos")).alias("chapter"))


@query(O.query("SELECT doc_id, '1' AS prefix, first, last, before, after FROM gaps", O.HIERARCHY, _GAPS))
def numbering_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return toc.numbering_gaps(gap_rows(spark, sf))


@query(O.query("SELECT doc_id, '1.' || n AS number, before, after FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS k FROM (SELECT doc_id, unnest(range(first, last + 1)) AS n, before, after FROM gaps)) WHERE k <= 20", O.HIERARCHY, _GAPS))
def missing_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return toc.missing_numbers(toc.numbering_gaps(gap_rows(spark, sf)))


@query(O.query(f"SELECT doc_id, array_to_string(list_sort(list(DISTINCT regexp_extract(c, '^\\s*(\\d+(?:\\.\\d+)+)', 1))), '|') AS paths FROM (SELECT doc_id, {O.clean('chapter')} AS c FROM book_toc) WHERE regexp_matches(c, '^\\s*\\d+(?:\\.\\d+)+') GROUP BY ALL", *BOOK))
def decimal_paths(spark: SparkSession, sf: str) -> DataFrame:
    from .functions.numbering import decimal_path
    from .functions.text import number_path_text

    d = book_toc(spark, sf).select("doc_id", number_path_text(decimal_path(F.col("chapter"))).alias("p")).where("p is not null")
    return d.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("p")), "|").alias("paths"))


# --- outlines ---------------------------------------------------------------------------------------


@query(O.query("SELECT a.doc_id, a.pos, a.level, max(b.pos) AS parent_pos FROM hierarchy a LEFT JOIN hierarchy b ON a.doc_id = b.doc_id AND b.pos < a.pos AND b.level < a.level GROUP BY ALL", O.HIERARCHY))
def ancestors(spark: SparkSession, sf: str) -> DataFrame:
    from .catalog import hierarchy

    return toc.ancestors(hierarchy(spark, sf)).select("doc_id", "pos", "level", "parent_pos")


@query(O.query("SELECT a.doc_id, a.pos, coalesce(string_agg(b.pos, '>' ORDER BY b.pos), '') AS path FROM hierarchy a LEFT JOIN hierarchy b ON a.doc_id = b.doc_id AND b.pos < a.pos AND b.level < a.level AND NOT EXISTS (SELECT 1 FROM hierarchy c WHERE c.doc_id = a.doc_id AND c.pos > b.pos AND c.pos < a.pos AND c.level <= b.level) GROUP BY ALL", O.HIERARCHY))
def open_paths(spark: SparkSession, sf: str) -> DataFrame:
    from .catalog import hierarchy

    return toc.ancestors(hierarchy(spark, sf)).select("doc_id", "pos", F.array_join(F.transform("path", lambda p: p.cast("string")), ">").alias("path"))


@query(O.query("SELECT a.doc_id, a.pos, a.level, coalesce(min(b.page), 999) AS end_page FROM hierarchy a LEFT JOIN hierarchy b ON a.doc_id = b.doc_id AND b.pos > a.pos AND b.level <= a.level GROUP BY ALL", O.HIERARCHY))
def section_ends(spark: SparkSession, sf: str) -> DataFrame:
    from .catalog import hierarchy

    return toc.section_ends(hierarchy(spark, sf), F.lit(999)).select("doc_id", "pos", "level", "end_page")


_RAW = "raw AS (SELECT doc_id, pos, CASE pos % 6 WHEN 2 THEN 'x' WHEN 3 THEN NULL ELSE (level * 3 - 4)::VARCHAR END AS level, chapter AS text, CASE WHEN pos % 10 = 9 THEN '1e' ELSE (page - 1)::VARCHAR END AS page, CASE WHEN pos % 4 = 0 THEN NULL ELSE (pos % 7)::VARCHAR END AS \"order\", level_reason AS reason FROM book_toc)"


@query(O.query(f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY page, ord, pos) AS pos, dense_rank() OVER (PARTITION BY doc_id ORDER BY level) AS level, text, page, ord AS "order", reason FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, ord, lower(text) ORDER BY pos) AS n FROM (
  SELECT doc_id, pos, {O.clean('text')} AS text, greatest(1, least(coalesce(level, '1')::INT, 5)) AS level, greatest(1, least(coalesce(page, '1')::INT, 4)) AS page, greatest(1, coalesce("order", '1')::INT) AS ord, {O.clean('reason')} AS reason FROM raw WHERE coalesce(level, '') <> 'x' AND page <> '1e' AND {O.clean('text')} <> '')) WHERE n = 1""", *BOOK, _RAW))
def validated_headings(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("pos")
    raw = book_toc(spark, sf).select(
        "doc_id", "pos", F.when(p % 6 == 2, "x").when(p % 6 == 3, None).otherwise((F.col("level") * 3 - 4).cast("string")).alias("level"), F.col("chapter").alias("text"),
        F.when(p % 10 == 9, "1e").otherwise((F.col("page") - 1).cast("string")).alias("page"), F.when(p % 4 != 0, (p % 7).cast("string")).alias("order"), F.col("level_reason").alias("reason"),
    )
    return toc.validate_headings(raw, F.lit(4), 5)


_DEEP = """deep AS (SELECT doc_id, min(pos) AS target FROM hierarchy h WHERE level = (SELECT max(level) FROM hierarchy g WHERE g.doc_id = h.doc_id) GROUP BY doc_id),
path AS (SELECT h.doc_id, h.pos, h.level, h.page FROM hierarchy h JOIN deep d ON d.doc_id = h.doc_id AND h.pos <= d.target WHERE NOT EXISTS (SELECT 1 FROM hierarchy c WHERE c.doc_id = h.doc_id AND c.pos > h.pos AND c.pos <= d.target AND c.level <= h.level))"""


@query(O.query("SELECT * FROM path", O.HIERARCHY, _DEEP))
def deepest_paths(spark: SparkSession, sf: str) -> DataFrame:
    from .catalog import hierarchy

    return toc.deepest_path(hierarchy(spark, sf))


_GROUPS = """grp AS (SELECT doc_id, d.target, mx, a AS start_level, least(a + 2, mx) AS end_level FROM (SELECT d.doc_id, d.target, h.level AS mx FROM deep d JOIN hierarchy h ON h.doc_id = d.doc_id AND h.pos = d.target) d, (VALUES (1), (3), (5)) v(a) WHERE a = 1 OR a < mx),
onpath AS (SELECT g.*, coalesce((SELECT arg_max(struct_pack(pos := p.pos, page := p.page), p.pos) FROM path p WHERE p.doc_id = g.doc_id AND p.level <= g.end_level), (SELECT arg_min(struct_pack(pos := p.pos, page := p.page), p.pos) FROM path p WHERE p.doc_id = g.doc_id)) AS onp,
  (SELECT arg_min(struct_pack(pos := h.pos, page := h.page), h.pos) FROM hierarchy h WHERE h.doc_id = g.doc_id AND h.level = g.end_level) AS firsth FROM grp g),
ended AS (SELECT *, CASE WHEN start_level = 1 THEN coalesce(firsth, onp) ELSE onp END AS e FROM onpath),
begun AS (SELECT *, coalesce((SELECT arg_max(h.page, h.pos) FROM hierarchy h WHERE h.doc_id = ended.doc_id AND h.pos <= e.pos AND h.level = start_level), (SELECT arg_max(h.page, h.pos) FROM hierarchy h WHERE h.doc_id = ended.doc_id AND h.pos <= e.pos AND h.level <= start_level), (SELECT arg_min(h.page, h.pos) FROM hierarchy h WHERE h.doc_id = ended.doc_id)) AS sp,
  (SELECT arg_min(h.page, h.pos) FROM hierarchy h WHERE h.doc_id = ended.doc_id AND h.pos > target AND h.level < mx) AS nextp, (SELECT h.page FROM hierarchy h WHERE h.doc_id = ended.doc_id AND h.pos = target) AS tp FROM ended)"""


@query(O.query("SELECT doc_id, start_level, end_level, greatest(1, least(sp, 15)) AS start_page, greatest(greatest(1, least(sp, 15)), least(CASE WHEN end_level >= mx THEN greatest(tp, coalesce(nextp, 15)) ELSE greatest(1, least(e.page, 15)) END, 15)) AS end_page, e.pos AS end_pos FROM begun", O.HIERARCHY, _DEEP, _GROUPS))
def level_group_ranges(spark: SparkSession, sf: str) -> DataFrame:
    from .catalog import hierarchy

    return toc.group_ranges(hierarchy(spark, sf), F.lit(15))


# --- files --------------------------------------------------------------------------------------

_FILES = """docs AS (SELECT p_name || ' ' || p_brand AS stem, '/in/' || p_partkey || '.pdf' AS path FROM part WHERE p_size < 12),
tocs AS (SELECT p_partkey, '/out/' || p_partkey || '_toc.json' AS path, upper(p_name) || '-' || p_brand || '_' || p_size || '.json' AS name, p_size AS modified FROM part),
keyed AS (SELECT regexp_replace(lower(stem), '[^0-9a-z가-힣]', '', 'g') AS k, stem, path FROM docs),
linked AS (SELECT path, doc_path, doc_stem FROM (SELECT t.path, d.path AS doc_path, d.stem AS doc_stem, row_number() OVER (PARTITION BY t.path ORDER BY length(d.k) DESC, d.path DESC) AS n FROM (SELECT path, regexp_replace(lower(regexp_replace(name, '[.][^.]*$', '')), '[^0-9a-z가-힣]', '', 'g') AS k FROM tocs) t JOIN keyed d ON prefix(t.k, d.k) AND d.k <> '') WHERE n = 1)"""


def files(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(documents, tables of contents with the names they go by)."""
    from .session import spread

    p, text = spread(spark.read.parquet(f"{sf}/part.parquet")), lambda *c: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in c])
    key = F.col("p_partkey").cast("string")
    docs = p.where("p_size < 12").select(text(F.col("p_name"), " ", F.col("p_brand")).alias("stem"), text("/in/", key, ".pdf").alias("path"))
    name = text(F.upper("p_name"), "-", F.col("p_brand"), "_", F.col("p_size").cast("string"), ".json")
    return docs, p.select("p_partkey", text("/out/", key, "_toc.json").alias("path"), name.alias("name"), F.col("p_size").alias("modified"), F.array(name).alias("names"))


@query("WITH " + _FILES + " SELECT * FROM linked")
def documents_of_tables(spark: SparkSession, sf: str) -> DataFrame:
    docs, tocs = files(spark, sf)
    return jobs.match_documents(tocs, docs)


_ENTRIES = "entries AS (SELECT '/out/' || p_partkey || '_toc.json' AS path, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size * 2 - q END AS page FROM part, (VALUES (0), (1), (2)) v(q))"


@query("WITH " + _FILES + ", " + _ENTRIES + """, facts AS (SELECT path, max(coalesce(page, 0)) AS max_page FROM entries GROUP BY path HAVING bool_or(coalesce(page, 0) BETWEEN 20 AND 60))
SELECT doc_path, path, max_page FROM (SELECT l.doc_path, t.path, max_page, row_number() OVER (PARTITION BY l.doc_path ORDER BY max_page >= 60 DESC, CASE WHEN max_page >= 60 THEN 0 ELSE max_page END DESC, t.modified DESC, t.name DESC, t.path DESC) AS n FROM linked l JOIN tocs t USING (path) JOIN facts USING (path)) WHERE n = 1""")
def chosen_sources(spark: SparkSession, sf: str) -> DataFrame:
    docs, tocs = files(spark, sf)
    linked = jobs.match_documents(tocs, docs).join(tocs.select("path", "name", "modified"), "path")
    entries = spark.read.parquet(f"{sf}/part.parquet").select(F.concat(F.lit("/out/"), F.col("p_partkey").cast("string"), F.lit("_toc.json")).alias("path"), F.explode(F.array(*[F.lit(q) for q in range(3)])).alias("q"), "p_size")
    entries = entries.select("path", F.when(F.col("p_size") % 5 != 0, F.col("p_size") * 2 - F.col("q")).alias("page"))
    return jobs.choose_source(linked, entries, 20, 60)


@query("SELECT p_brand AS doc, min(a)::INT AS start_page, max(b)::INT AS end_page FROM (SELECT p_brand, CASE WHEN p_size % 3 = 0 THEN p_size ELSE p_size + 1 END AS a, CASE WHEN p_size % 3 = 0 THEN p_size + 2 ELSE p_size * 2 END AS b FROM part) WHERE a >= 1 AND b >= a GROUP BY p_brand")
def chunk_ranges(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("p_size")
    said = lambda c: F.when(n % 3 == 0, c.cast("string")).otherwise("?")
    d = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_brand").alias("doc"), F.concat(F.lit("chunk_1_pages_"), (n + 1).cast("string"), F.lit("_"), (n * 2).cast("string"), F.lit(".json")).alias("name"), said(n).alias("start_page"), said(n + 2).alias("end_page"))
    return jobs.chunk_range(d)


@query(O.query("SELECT doc_id, pos, chapter, page FROM book_toc WHERE pos % 9 <> 4 AND page BETWEEN 2 AND 3", *BOOK))
def trimmed_tables(spark: SparkSession, sf: str) -> DataFrame:
    t = book_toc(spark, sf).withColumn("page", F.when(F.col("pos") % 9 == 4, "iv").otherwise(F.col("page").cast("string")))
    return jobs.trim_to_range(t, 2, 3).select("doc_id", "pos", "chapter", "page")


_DIRS = ["a_parsed.txt", "Notes.TXT", "chunk_1.json", "my_toc.json", "x_toc_chunk1.json", "other.json", "y_reference_chunk1.json", "B_PARSED.txt"]
_DIR = "dirs AS (SELECT p_partkey // 5 AS dir, p_size AS modified, CASE p_size % 8 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(_DIRS)) + " END AS name, p_partkey AS k FROM part)"


@query("WITH " + _DIR + """, kinds AS (SELECT *, CASE WHEN regexp_matches(lower(name), 'parsed.*[.]txt$') THEN 'parsed' WHEN lower(name) LIKE '%.txt' THEN 'text' WHEN regexp_matches(name, 'toc|reference') THEN 'reference' WHEN contains(name, 'chunk') THEN 'chunk' END AS kind FROM dirs)
SELECT dir, 'parsed' AS kind, name FROM (SELECT dir, name, rank, count(*) OVER (PARTITION BY dir, rank) AS n, min(rank) OVER (PARTITION BY dir) AS best FROM (SELECT *, (kind = 'text')::INT AS rank FROM kinds WHERE kind IN ('parsed', 'text'))) WHERE rank = best AND n = 1
UNION ALL SELECT dir, 'chunk', min(name) FROM kinds WHERE kind = 'chunk' GROUP BY dir HAVING count(*) = 1
UNION ALL SELECT dir, 'reference', name FROM (SELECT dir, name, rank, count(*) OVER (PARTITION BY dir, rank) AS n, min(rank) OVER (PARTITION BY dir) AS best, row_number() OVER (PARTITION BY dir, rank ORDER BY modified DESC, name DESC) AS k FROM (SELECT *, (NOT name LIKE '%_chunk1.json')::INT AS rank FROM kinds WHERE kind = 'reference')) WHERE rank = best AND k = 1 AND (n = 1 OR rank = 0)""")
def discovered_inputs(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.expr("CASE p_size % 8 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(_DIRS)) + " END")
    d = spark.read.parquet(f"{sf}/part.parquet").select(F.floor(F.col("p_partkey") / 5).alias("dir"), F.col("p_size").alias("modified"), kind.alias("name"), F.col("p_partkey").cast("string").alias("path"))
    d = d.withColumn("stem", jobs.stem_of(F.col("name")))
    out = None
    for k in ("parsed", "chunk", "reference"):
        f = jobs.discover(d, k).select("dir", F.lit(k).alias("kind"), "name")
        out = f if out is None else out.unionByName(f)
    return out


_JOBS = """refs AS (SELECT '/r/' || p_partkey || '_chunk1.json' AS reference, CASE WHEN p_size % 3 = 0 THEN 'run' || p_size % 7 END AS run, regexp_replace(lower(CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_name || p_size END), '[^0-9a-z]', '', 'g') AS key FROM part WHERE p_partkey % 4 = 0),
chs AS (SELECT '/c/' || p_partkey AS path, 'c' || p_partkey AS name, p_size AS modified, 'run' || p_size % 20 AS run, p_name AS source, regexp_replace(lower(p_name), '[^0-9a-z]', '', 'g') AS key FROM part WHERE p_partkey % 3 = 0),
own AS (SELECT r.reference, c.*, row_number() OVER (PARTITION BY r.reference ORDER BY c.modified DESC, c.name DESC) AS n FROM refs r JOIN chs c ON c.run = r.run),
same AS (SELECT r.reference, c.*, row_number() OVER (PARTITION BY r.reference ORDER BY c.modified DESC, c.name DESC) AS n FROM refs r JOIN chs c ON c.key = r.key WHERE r.reference NOT IN (SELECT reference FROM own)),
got AS (SELECT reference, path AS chunk, run, key FROM own WHERE n = 1 UNION ALL SELECT reference, path, run, key FROM same WHERE n = 1),
prs AS (SELECT '/p/' || p_partkey AS path, p_name || p_partkey || '_parsed_pdf.txt' AS name, p_size AS modified, CASE WHEN p_size % 5 = 0 THEN 'run' || p_size % 20 END AS run, regexp_replace(lower(p_name || p_partkey || '_parsed_pdf'), '[^0-9a-z]', '', 'g') AS key FROM part WHERE p_partkey % 5 = 0),
exact AS (SELECT g.reference, g.chunk, p.path, row_number() OVER (PARTITION BY g.reference ORDER BY p.modified DESC, p.name DESC) AS n FROM got g JOIN prs p ON p.run = g.run),
alike AS (SELECT g.reference, g.chunk, p.path, row_number() OVER (PARTITION BY g.reference ORDER BY p.modified DESC, p.name DESC) AS n FROM got g JOIN prs p ON prefix(p.key, g.key) WHERE g.reference NOT IN (SELECT reference FROM exact))"""


@query("WITH " + _JOBS + " SELECT reference, chunk, path AS parsed FROM exact WHERE n = 1 UNION ALL SELECT reference, chunk, path FROM alike WHERE n = 1")
def document_jobs(spark: SparkSession, sf: str) -> DataFrame:
    from .session import spread

    p = spread(spark.read.parquet(f"{sf}/part.parquet"))
    key, n, name = F.col("p_partkey").cast("string"), F.col("p_size"), F.col("p_name")
    t = lambda *c: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in c])
    refs = p.where("p_partkey % 4 = 0").select(t("/r/", key, "_chunk1.json").alias("path"), F.when(n % 2 == 0, t("C:\\in\\", name, ".pdf")).alias("source_input"), t(name, n).alias("title"), F.when(n % 3 == 0, t("/runs/run", n % 7)).alias("run"))
    chunks = p.where("p_partkey % 3 = 0").select(t("/c/", key).alias("path"), t("c", key).alias("name"), n.alias("modified"), t("run", n % 20).alias("run"), t("/in/", name, ".PDF").alias("source_pdf"))
    parsed = p.where("p_partkey % 5 = 0").select(t("/p/", key).alias("path"), t(name, key, "_parsed_pdf.txt").alias("name"), n.alias("modified"), F.when(n % 5 == 0, t("run", n % 20)).alias("run"))
    return jobs.resolve(refs, chunks, parsed)
