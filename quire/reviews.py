"""Queries over reviews of tables of contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles as O
from .books import _BARE, _MARKER, _PARTIAL, _VISUAL, BOOK, STYLED, Query, bare, book_lines, book_styled, book_toc, partials
from .functions.text import match_key
from .operators import review as R

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def after(spark: SparkSession, sf: str) -> DataFrame:
    """The table after a review: some entries gone, some renamed, some levels changed."""
    p = F.col("pos")
    d = bare(spark, sf).where("pos % 7 <> 2")
    return d.withColumns({"chapter": F.when(p % 11 == 3, F.concat(F.lit("New "), "chapter")).otherwise(F.col("chapter")), "level": F.when(p % 4 == 1, F.col("level") + 1).otherwise(F.col("level"))})


_AFTER = "aft AS (SELECT * REPLACE (CASE WHEN pos % 11 = 3 THEN 'New ' || chapter ELSE chapter END AS chapter, CASE WHEN pos % 4 = 1 THEN level + 1 ELSE level END AS level) FROM bare WHERE pos % 7 <> 2)"
_KEYED = lambda name, src: f"{name} AS (SELECT * EXCLUDE (n) FROM (SELECT *, {O.match_key('chapter')} AS key, row_number() OVER (PARTITION BY doc_id, {O.match_key('chapter')}, page ORDER BY pos DESC) AS n FROM {src} WHERE {O.match_key('chapter')} <> '') WHERE n = 1)"
_CHANGES = f"""changes AS (SELECT doc_id, kind, row_number() OVER (PARTITION BY doc_id, kind ORDER BY coalesce(nullif(page, 0), 0), coalesce(nullif(source_order, 0), nullif(merge_order, 0), 0), coalesce(y, 0), title, key, kp) AS place, before_level, after_level, title AS chapter, page FROM (
  SELECT doc_id, key, page AS kp, CASE WHEN b.doc_id IS NULL THEN 'added' WHEN a.doc_id IS NULL THEN 'removed' WHEN a.level <> b.level THEN 'level_changed' END AS kind, b.level AS before_level, a.level AS after_level, {O.clean('CASE WHEN a.doc_id IS NULL THEN b.chapter ELSE a.chapter END')} AS title, page,
    CASE WHEN a.doc_id IS NULL THEN b.source_order ELSE a.source_order END AS source_order, CASE WHEN a.doc_id IS NULL THEN b.merge_order ELSE a.merge_order END AS merge_order, CASE WHEN a.doc_id IS NULL THEN b.y ELSE a.y END AS y FROM bk b FULL JOIN ak a USING (doc_id, key, page)) WHERE kind IS NOT NULL)"""
_REVIEWED = (*STYLED, _BARE, _AFTER, _KEYED("bk", "book_styled"), _KEYED("ak", "aft"), _CHANGES)


@query(O.query("SELECT * FROM changes", *_REVIEWED))
def review_changes(spark: SparkSession, sf: str) -> DataFrame:
    return R.changes(book_styled(spark, sf), after(spark, sf)).drop("before", "after")


@query(O.query("SELECT doc_id, count(*) FILTER (kind = 'level_changed') AS level_change_count, count(*) FILTER (kind = 'added') AS added_count, count(*) FILTER (kind = 'removed') AS removed_count FROM changes GROUP BY ALL", *_REVIEWED))
def review_change_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.change_counts(R.changes(book_styled(spark, sf), after(spark, sf)))


@query(O.query("SELECT doc_id, pos, " + ", ".join(f"nullif({O.clean(c)}, '') AS {c}" for c in R.SNAPSHOT) + " FROM book_styled", *STYLED))
def entry_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return book_styled(spark, sf).select("doc_id", "pos", R.snapshot().alias("s")).select("doc_id", "pos", *[F.try_element_at("s", F.lit(c)).alias(c) for c in R.SNAPSHOT])


@query(O.query(f"""SELECT doc_id, pos, '{{"level":' || level || ',"chapter":' || to_json({O.clean('chapter')}) || ',"page":' || page || '}}' AS entry FROM book_toc WHERE {O.clean('chapter')} <> ''""", *BOOK))
def compact_entries(spark: SparkSession, sf: str) -> DataFrame:
    return R.compact(book_toc(spark, sf))


_PATH = r"^\s*(\d+(?:\.\d+)+)"
_PLIST = lambda c: f"list_transform(string_split(regexp_extract({c}, '{_PATH}', 1), '.'), lambda v: v::INT)"
_SOME = "partly AS (SELECT * FROM book_styled WHERE pos % 3 = 0)"
_NUMBERED = f"""cands AS (SELECT doc_id, 'source_text' AS source, {O.clean('text')} AS title, page, NULL AS chunk, line_index, s AS font_size, r AS size_ratio, x, y, line_index AS spot FROM book_lines UNION ALL
  SELECT doc_id, 'partial_toc', {O.clean('chapter')}, page, chunk, source_order, font_size, size_ratio, x, y, -row_number() OVER (PARTITION BY doc_id ORDER BY chunk, pos) AS spot FROM partial),
miss AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, path ORDER BY source <> 'source_text', spot) AS n FROM (SELECT *, {_PLIST('title')} AS path FROM cands WHERE regexp_matches(title, '{_PATH}')) c
  WHERE NOT EXISTS (SELECT 1 FROM partly t WHERE t.doc_id = c.doc_id AND regexp_matches({O.clean('t.chapter')}, '{_PATH}') AND {_PLIST(O.clean('t.chapter'))} = c.path) AND NOT EXISTS (SELECT 1 FROM partly t WHERE t.doc_id = c.doc_id AND {O.match_key('t.chapter')} = {O.match_key('c.title')})) WHERE n = 1)"""


@query(O.query("SELECT doc_id, rank, array_to_string(path, '.') AS number, source, title, page, chunk, line_index, font_size, size_ratio, x, y FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY path) AS rank FROM miss) WHERE rank <= 30", *STYLED, _PARTIAL, _SOME, _NUMBERED))
def missing_numbered_headings(spark: SparkSession, sf: str) -> DataFrame:
    return R.missing_numbered(book_styled(spark, sf).where("pos % 3 = 0"), book_lines(spark, sf), partials(spark, sf))


_PROF = "prof AS (SELECT DISTINCT doc_id, font_size AS pf, size_ratio AS pr FROM partly WHERE font_size IS NOT NULL OR size_ratio IS NOT NULL)"
_C = O.clean("l.text")
_NON = f"({_C} = '' OR length({_C}) > 180 OR {O.like(_C, chr(94) + '[0-9 .,;:()/_-]+$')} OR {O.like(_C, '^[•●▪▫–—*-] +')} OR {O.like(_C, '(?i)^(?:table|figure|fig[.]|box|표|그림) *[0-9IVXivx가-힣.:-]')} OR (length({_C}) > 80 AND {O.like(_C, '(?:다|요|니다|였다|한다|있다|된다|[.]|;|:)$')}))"
_STYLED_MISS = f"""kn AS (SELECT l.*, {O.match_key('l.text')} AS key, EXISTS (SELECT 1 FROM prof p WHERE p.doc_id = l.doc_id AND ((coalesce(abs(l.s - pf) <= 1.0, false) AND (coalesce(abs(round(l.r, 2) - pr) <= 0.12, false) OR pr IS NULL)) OR (coalesce(abs(round(l.r, 2) - pr) <= 0.12, false) AND (coalesce(abs(l.s - pf) <= 1.0, false) OR pf IS NULL)))) AS known FROM book_lines l),
cand AS (SELECT *, row_number() OVER (PARTITION BY doc_id, key ORDER BY line_index) AS n FROM kn l WHERE key NOT IN (SELECT {O.match_key('chapter')} FROM partly t WHERE t.doc_id = l.doc_id) AND NOT {_NON} AND NOT (r <= 1.08 AND b = 0 AND i = 0 AND NOT {O.like(_C, _MARKER)}) AND (known OR r >= 1.18 OR (b > 0 AND r >= 1.03) OR (i > 0 AND r >= 1.08))),
scored AS (SELECT *, round(greatest(0, r - 1) * 5 + CASE WHEN b > 0 THEN 1.4 ELSE 0 END + CASE WHEN i > 0 THEN 0.5 ELSE 0 END + CASE WHEN known THEN 2.0 ELSE 0 END + CASE WHEN s >= 14 THEN 0.5 ELSE 0 END, 6)::DOUBLE AS score FROM cand WHERE n = 1)"""


@query(O.query(f"SELECT doc_id, page, line_index, {O.clean('text')} AS title, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, page, line_index) AS k FROM scored) WHERE k <= 40", *STYLED, _SOME, _PROF, _STYLED_MISS))
def missing_styled_headings(spark: SparkSession, sf: str) -> DataFrame:
    return R.missing_styled(book_styled(spark, sf).where("pos % 3 = 0"), book_lines(spark, sf))


@query(O.query(f"SELECT doc_id, level, font_size, size_ratio, x AS left_indent, {O.clean('chapter')} AS title FROM book_styled WHERE font_size IS NOT NULL OR size_ratio IS NOT NULL", *STYLED))
def heading_style_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return R.style_profiles(book_styled(spark, sf))


@query()
def invalid_headings(spark: SparkSession, sf: str) -> DataFrame:
    return R.invalid_headings(book_styled(spark, sf), book_lines(spark, sf)).withColumn("reasons", F.array_join("reasons", "|"))


@query()
def invalid_headings_told(spark: SparkSession, sf: str) -> DataFrame:
    return R.told(R.invalid_headings(book_styled(spark, sf), book_lines(spark, sf)))


_LISTED = f"({O.like(O.clean('layout_text'), '[·ㆍ.]{3,} *[0-9]+ *$')} OR {O.like(O.clean('layout_text'), '[^ ] +[0-9]{1,4}$')})"
_RUN = "coalesce((coalesce(font_size <= 10.5, false) OR coalesce(size_ratio <= 1.05, false)) AND (y <= 65 OR y >= 735), false)"
_MOVED = "moved AS (SELECT * REPLACE (CASE WHEN pos % 5 = 0 THEN 1 WHEN pos % 7 = 3 THEN 2 ELSE level END AS level, CASE WHEN pos % 6 = 0 THEN font_size * 2 ELSE font_size END AS font_size) FROM book_styled)"


def moved(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of which some have another level than their style, and some larger type."""
    p = F.col("pos")
    return book_styled(spark, sf).withColumns({"level": F.when(p % 5 == 0, 1).when(p % 7 == 3, 2).otherwise(F.col("level")), "font_size": F.when(p % 6 == 0, F.col("font_size") * 2).otherwise(F.col("font_size"))})


_ST = f"st AS (SELECT *, round(font_size, 1) AS sf, round(size_ratio, 2) AS sr FROM moved WHERE {O.clean('chapter')} <> '' AND ({O.title_score(O.match_key('chapter'), O.match_key('layout_text'), 'layout_text', 'font_size', 'size_ratio', 'y')}) IS NOT NULL AND NOT {_LISTED} AND NOT {_RUN} AND (font_size IS NOT NULL OR size_ratio IS NOT NULL))"


@query(O.query("""SELECT doc_id, level, rank, style, count, x_min, x_max, examples FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, level ORDER BY count DESC, style) AS rank FROM (
  SELECT doc_id, level, 'font_size=' || sf || ', size_ratio=' || sr AS style, count(*) AS count, min(x) AS x_min, max(x) AS x_max, array_to_string((list(CASE WHEN length(c) <= 60 THEN c ELSE rtrim(c[:59]) || '...' END ORDER BY pos))[:3], '|') AS examples FROM (SELECT *, {} AS c FROM st) GROUP BY doc_id, level, sf, sr)) WHERE rank <= 5""".format(O.clean("chapter")), *STYLED, _MOVED, _ST))
def level_style_summaries(spark: SparkSession, sf: str) -> DataFrame:
    return R.level_styles(moved(spark, sf)).withColumn("examples", F.array_join("examples", "|"))


_CONF = """nn AS (SELECT *, max(n) OVER (PARTITION BY doc_id, level) AS top, first_value(level) OVER (PARTITION BY doc_id, sf, sr ORDER BY n DESC, level) AS best, max(n) OVER (PARTITION BY doc_id, sf, sr) AS bn FROM (SELECT doc_id, level, sf, sr, count(*) AS n FROM st GROUP BY ALL)),
lead1 AS (SELECT doc_id, arg_max(sf, (coalesce(sf, 0), coalesce(sr, 0), n)) AS lf, arg_max(sr, (coalesce(sf, 0), coalesce(sr, 0), n)) AS lr FROM nn WHERE level = 1 GROUP BY doc_id HAVING count(*) >= 2),
jj AS (SELECT s.doc_id, s.pos, s.level, s.sf, s.sr, n, top, best, bn, lf, lr FROM st s JOIN nn ON nn.doc_id = s.doc_id AND nn.level = s.level AND nn.sf IS NOT DISTINCT FROM s.sf AND nn.sr IS NOT DISTINCT FROM s.sr LEFT JOIN lead1 l ON l.doc_id = s.doc_id)"""


@query(O.query("""SELECT doc_id, rank, pos, kind, level, better_level FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY kind DESC, pos) AS rank FROM (
  SELECT doc_id, pos, 'smaller' AS kind, level, NULL::INT AS better_level FROM jj WHERE level = 1 AND lf IS NOT NULL AND NOT (sf = lf AND sr = lr) AND NOT (sf / lf > 0.82 AND sr / lr > 0.82)
  UNION ALL SELECT doc_id, pos, 'other', level, best::INT FROM jj WHERE NOT (best = level AND n >= top) AND NOT (best <> level AND bn < greatest(2, n + 1)))) WHERE rank <= 20""", *STYLED, _MOVED, _ST, _CONF))
def style_level_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return R.style_conflicts(moved(spark, sf))


def chunked(spark: SparkSession, sf: str) -> DataFrame:
    d = partials(spark, sf).withColumn("page", F.when(F.col("doc_id") % 5 > 0, F.col("page") * F.when(F.col("doc_id") % 3 == 0, 20).otherwise(1)))
    return d.withColumns({"start_page": F.col("chunk") * 10 - 9, "end_page": F.col("chunk") * 10})


_CHUNKED = "chunked AS (SELECT doc_id, chunk, pos, CASE WHEN doc_id % 5 > 0 THEN page * CASE WHEN doc_id % 3 = 0 THEN 20 ELSE 1 END END AS page, chunk * 10 - 9 AS start_page, chunk * 10 AS end_page FROM partial)"


@query(O.query("SELECT doc_id, coalesce(min(page), min(start_page)) AS start_page, coalesce(max(page), max(end_page)) AS end_page, count(page) AS entries, coalesce(max(page), 0) AS max_page FROM chunked GROUP BY ALL", *STYLED, _PARTIAL, _CHUNKED))
def partial_page_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return R.partial_bounds(chunked(spark, sf))


@query(O.query("""SELECT doc_id, coalesce(om IS NOT NULL AND sm IS NOT NULL AND ((sm - om >= 10 AND late >= 3) OR (n >= 50 AND oc < greatest(10, n // 5) AND sm - om >= 5)), false) AS truncated FROM (
  SELECT c.doc_id, max(c.page) AS sm, count(*) AS n, count(*) FILTER (c.page > om + 3) AS late, max(om) AS om, max(oc) AS oc FROM chunked c LEFT JOIN (SELECT doc_id, max(page) AS om, count(*) AS oc FROM book_toc WHERE pos < 6 GROUP BY ALL) o ON o.doc_id = c.doc_id GROUP BY c.doc_id)""", *STYLED, _PARTIAL, _CHUNKED))
def truncated_merges(spark: SparkSession, sf: str) -> DataFrame:
    return R.truncated(book_toc(spark, sf).where("pos < 6"), chunked(spark, sf))


@query(O.query(f"SELECT doc_id, 'Review document ' || doc_id || chr(10) || chr(10) || '[titles]' || chr(10) || string_agg({O.clean('chapter')}, chr(10) ORDER BY pos) AS prompt FROM book_toc WHERE {O.clean('chapter')} <> '' GROUP BY doc_id", *BOOK))
def review_prompts(spark: SparkSession, sf: str) -> DataFrame:
    from .functions.text import clean_text

    d = book_toc(spark, sf).withColumn("c", clean_text("chapter")).where("c <> ''")
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "c"))), lambda v: v["c"]), "\n")
    base = d.select("doc_id").distinct().select("doc_id", F.concat(F.lit("Review document "), F.col("doc_id").cast("string")).alias("text"))
    return R.prompt(base, titles=d.groupBy("doc_id").agg(lines.alias("text")), notes=base.withColumn("text", F.lit("  ")))


@query(O.query(f"SELECT doc_id, count(DISTINCT {O.match_key('chapter')}) AS titles, count(*) FILTER ({O.like(O.clean('chapter'), _VISUAL)}) AS captions FROM book_toc GROUP BY ALL", *BOOK))
def table_title_counts(spark: SparkSession, sf: str) -> DataFrame:
    from .functions.predicates import is_visual_caption

    return book_toc(spark, sf).groupBy("doc_id").agg(F.countDistinct(match_key("chapter")).alias("titles"), F.count(F.when(is_visual_caption(F.col("chapter")), 1)).alias("captions"))
