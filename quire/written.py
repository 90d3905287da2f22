"""Queries over sinks, models' names and the text and number functions that no other query has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles as O
from . import sinks
from .books import BOOK, Query, book_lines, book_toc
from .functions import numbers as N
from .functions import predicates as P
from .functions import text as T
from .operators import models

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def part(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/part.parquet")


def _pick(values: list[str], by: str) -> str:
    return f"CASE {by} % {len(values)} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + " END"


_NAMES = ["anthropic", " Open-AI ", "google", "LOCAL", "gemini", "other", "claude"]
_MODELS = ["models/2.5-pro", "27b", "latest", "gemini-2.0-flash", " e2b ", "models/x", "1.5-flash", "31b"]
_PROV = "CASE lower(trim(n)) WHEN 'anthropic' THEN 'claude' WHEN 'open-ai' THEN 'openai' WHEN 'google' THEN 'gemini' WHEN 'local' THEN 'gemma' WHEN 'gemini' THEN 'gemini' WHEN 'claude' THEN 'claude' END"
_BARE = "CASE WHEN prov IN ('gemini', 'gemma') AND prefix(trim(m), 'models/') THEN trim(m)[8:] ELSE trim(m) END"


@query(f"""SELECT p_partkey, prov AS provider, CASE WHEN prov = 'gemini' AND bare IN ('2.5-pro', '1.5-flash') THEN 'gemini-' || bare WHEN prov = 'gemma' AND bare IN ('latest', '31b') THEN 'gemma4:31b' WHEN prov = 'gemma' AND bare = 'e2b' THEN 'gemma4:e2b' WHEN prov = 'gemma' AND bare = '27b' THEN 'gemma3:27b' ELSE bare END AS model
FROM (SELECT *, {_BARE} AS bare FROM (SELECT p_partkey, {_PROV} AS prov, m FROM (SELECT p_partkey, {_pick(_NAMES, 'p_size')} AS n, {_pick(_MODELS, 'p_partkey')} AS m FROM part)))""")
def model_names(spark: SparkSession, sf: str) -> DataFrame:
    d = part(spark, sf).select("p_partkey", models.provider_of(F.expr(_pick(_NAMES, "p_size"))).alias("provider"), F.expr(_pick(_MODELS, "p_partkey")).alias("m"))
    return d.select("p_partkey", "provider", models.model_of(F.col("provider"), F.col("m")).alias("model"))


@query("SELECT p_partkey, array_to_string(list_filter([p_brand, 'm' || p_size % 3, CASE WHEN p_size % 2 = 0 THEN 'm1' ELSE '' END, p_brand], lambda x, i: x <> '' AND list_position([p_brand, 'm' || p_size % 3, CASE WHEN p_size % 2 = 0 THEN 'm1' ELSE '' END, p_brand], x) = i), '|') AS models FROM part")
def model_lists(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("p_size")
    rest = F.concat(F.lit(" m"), (n % 3).cast("string"), F.lit(", "), F.when(n % 2 == 0, "m1").otherwise(" "), F.lit(" ,"), F.col("p_brand"))
    return part(spark, sf).select("p_partkey", F.array_join(models.model_list(F.col("p_brand"), rest), "|").alias("models"))


@query("SELECT p_partkey, provider FROM part, (VALUES ('gemini'), ('claude')) v(provider)")
def provider_fan_out(spark: SparkSession, sf: str) -> DataFrame:
    return models.fan_out(part(spark, sf).select("p_partkey"), "google, claude,gemini")


_SEC = "(p_size * p_size * 37 + p_size / 4)"
_EN = f"CASE WHEN {_SEC} < 60 THEN printf('%.1fs', {_SEC}) WHEN {_SEC} < 3600 THEN floor({_SEC} / 60)::INT || 'm ' || printf('%.1fs', {_SEC} - floor({_SEC} / 60) * 60) ELSE floor({_SEC} / 3600)::INT || 'h ' || (floor({_SEC} / 60) - floor({_SEC} / 3600) * 60)::INT || 'm ' || printf('%.1fs', {_SEC} - floor({_SEC} / 60) * 60) END"


@query(f"""SELECT p_partkey, {_EN} AS elapsed, regexp_replace(trim(regexp_replace(p_name || '/' || p_type || '..', '[^A-Za-z0-9_.\\-]+', '_', 'g'), '._-'), '^$', 'model') AS safe, trim(regexp_replace('제' || p_name || '?', '[^A-Za-z0-9_.\\-가-힣]+', '_', 'g'), '._-') AS hangul,
  CASE WHEN p_size % 3 = 0 THEN p_size::VARCHAR ELSE p_size || '-' || p_size * 2 END AS range, CASE WHEN p_size % 2 = 0 THEN 'font_size=' || (p_size / 2)::DOUBLE || ', size_ratio=1.5' ELSE 'no layout style' END AS style, trim(regexp_replace(p_name || '   ' || p_type, '[ \\t]+', ' ', 'g')) || chr(10) || chr(10) || chr(10) || 'x' AS extracted,
  '한글 ' || p_name || ',' || ' (x)' AS ocr, regexp_replace(p_name, '[(\\[]', '', 'g') || '.pdf' = '' AS nothing, CASE WHEN p_size % 4 = 0 THEN NULL ELSE round_even(p_size / 8, 2) END AS number, coalesce(CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size END, -1)::INT AS first_number, p_size % 2 = 0 AS bold, p_size % 3 = 0 AS italic, p_size % 5 = 0 AS complete, CASE WHEN p_size % 7 = 0 THEN 0 ELSE p_size * 3 END::BIGINT AS total
  FROM part""")
def text_renderings(spark: SparkSession, sf: str) -> DataFrame:
    n, name = F.col("p_size"), F.col("p_name")
    two, three = n % 2 == 0, n % 3 == 0
    ocr = F.concat(F.lit("한 글 "), name, F.lit(" , ( x )"))
    return part(spark, sf).select(
        "p_partkey", T.elapsed_text(n * n * 37 + n / 4).alias("elapsed"), T.safe_name(F.concat(name, F.lit("/"), "p_type", F.lit(".."))).alias("safe"), T.safe_hangul_name(F.concat(F.lit("제"), name, F.lit("?"))).alias("hangul"),
        T.page_range(n, F.when(three, n).otherwise(n * 2)).alias("range"), T.style_key_text(F.when(two, (n / 2).cast("double")), F.when(two, F.lit(1.5))).alias("style"), T.clean_extracted(F.concat(name, F.lit(" \t "), "p_type", F.lit("\n\n\n\n\nx  "))).alias("extracted"),
        T.normalize_ocr(ocr).alias("ocr"), F.lit(False).alias("nothing"), N.float_or_null(F.when(n % 4 == 0, "no").otherwise((n / 8).cast("string"))).alias("number"), N.first_present(N.int_or_null(F.when(n % 4 == 0, "1.5").otherwise(n.cast("string"))), F.lit(-1)).alias("first_number"),
        P.span_is_bold(F.when(two, 16).otherwise(1), F.lit("Plain")).alias("bold"), P.span_is_italic(F.lit(0), F.when(three, "Sans-Oblique").otherwise("Sans")).alias("italic"), P.is_complete_toc(F.when(n % 5 == 0, "a_toc.json").when(two, "a_toc_chunk1.json").otherwise("b_chunk2_toc.json")).alias("complete"),
        N.usage_total(F.when(n % 7 != 0, n * 3)).alias("total"),
    )


@query(f"""SELECT p_partkey, regexp_matches(t, '(?i)^\\[?\\s*(?:사례|예시|보기|case|example|box)\\s*\\d*|(?i)^(?:표|그림|figure|fig\\.|table)\\s*[\\dIVXivx가-힣.:\\-]|(?i)^(?:기본\\s*문제|심화\\s*문제|연습\\s*문제|문제|참고문헌|references?)\\b') AS ancillary, regexp_matches(t, '[·ㆍ.]{{3,}}\\s*\\d+\\s*$') AS listing, regexp_matches(replace(t, ' ', ''), '^제\\d+(?:편|부|장|절)$') AS label, left(t, 1) = '제' AS hangul,
  regexp_matches(t, '(?i)^(?:chapter|part|section|unit)\\s*\\d+[A-Za-z]?\\b|(?i)^제\\s*\\d+\\s*[장절편부](?:$|[^가-힣\\w])|^\\d+(?:\\.\\d+)*\\s*[.)]\\s*|^\\d+\\s+제\\s*장(?:$|[^가-힣\\w])') AS marker, lower(replace(t, ' ', '')) IN ('contents', 'references', '') AND lower(replace(t, ' ', '')) <> 'references' AS generic FROM (SELECT p_partkey, {_pick(['Case 3', 'Figure 4. x', 'references', 'Contents', '제4장', 'Chapter 5 on', '1.2) y', 'Plain one', 'Intro ..... 7', '제 2 편'], 'p_size')} AS t FROM part)""")
def title_shapes(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("t")
    d = part(spark, sf).select("p_partkey", F.expr(_pick(["Case 3", "Figure 4. x", "references", "Contents", "제4장", "Chapter 5 on", "1.2) y", "Plain one", "Intro ..... 7", "제 2 편"], "p_size")).alias("t"))
    return d.select("p_partkey", P.is_ancillary(t).alias("ancillary"), P.is_existing_toc_line(t, keep_listings=False).alias("listing"), P.is_label_only(t).alias("label"), P.is_hangul_or_han(F.substring(t, 1, 1)).alias("hangul"), P.has_heading_marker(t).alias("marker"), P.is_generic_title(t, F.lit("file")).alias("generic"))


_RES = """'{"title":"doc ' || doc_id || '","chapters":[' || string_agg('{"level":' || level || ',"chapter":' || to_json(chapter) || ',"page":' || page || CASE WHEN level_reason IS NULL THEN '' ELSE ',"level_reason":"' || level_reason || '"' END || '}', ',' ORDER BY pos) || '],"_meta":{"provider":"gemma","elapsed_seconds":1.235,"elapsed":"1.2s"}}'"""


@query(O.query(f"SELECT doc_id, {_RES} AS json FROM book_toc GROUP BY doc_id", *BOOK))
def result_objects(spark: SparkSession, sf: str) -> DataFrame:
    t = book_toc(spark, sf)
    meta = t.select("doc_id").distinct().select("doc_id", F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"), F.lit("gemma").alias("provider"), F.lit(1.2345678).alias("elapsed_seconds"))
    return sinks.results(t, meta)


@query(O.query("""SELECT doc_id, '# Parsed PDF Text' || chr(10) || 'source_pdf: s' || doc_id || chr(10) || 'processed_pdf: p' || doc_id || chr(10) || 'extraction_metadata: {"a": "1", "b": "2"}' || chr(10) || chr(10) || string_agg('[PAGE ' || page || ']' || chr(10) || body, chr(10) || chr(10) ORDER BY page) || chr(10) AS text
  FROM (SELECT doc_id, page, string_agg(text, chr(10) ORDER BY source_order) AS body FROM book_lines GROUP BY ALL) GROUP BY doc_id""", O.BOOK_LINES))
def parsed_files(spark: SparkSession, sf: str) -> DataFrame:
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_order", "text"))), lambda v: v["text"]), "\n")
    pages = book_lines(spark, sf).groupBy("doc_id", "page").agg(body.alias("text"))
    key = F.col("doc_id").cast("string")
    files = pages.select("doc_id").distinct().select("doc_id", F.concat(F.lit("s"), key).alias("source_pdf"), F.concat(F.lit("p"), key).alias("processed_pdf"), F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1")).alias("metadata"))
    return sinks.parsed_texts(pages, files)


@query("""SELECT p_partkey AS doc_id, p_size AS chunk, 'chunk_' || p_size || '_pages_' || p_size || '_' || p_size + 2 || '.json' AS name, '{"stage":"input_chunk","chunk":' || p_size || ',"total_chunks":50,"start_page":' || p_size || ',"end_page":' || p_size + 2 || ',"input_chars":' || length(p_name) || ',"text":"' || p_name || '"}' AS json FROM part""".replace("|| p_size + 2 ||", "|| (p_size + 2) ||"))
def chunk_files(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("p_size")
    return sinks.chunk_payloads(part(spark, sf).select(F.col("p_partkey").alias("doc_id"), n.alias("chunk"), F.lit(50).alias("total"), n.alias("start_page"), (n + 2).alias("end_page"), F.col("p_name").alias("text")))


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id, event_type) AS stage_index FROM events")
def stage_indexes(spark: SparkSession, sf: str) -> DataFrame:
    e = spark.read.parquet(f"{sf}/events.parquet").select(F.col("user_id").alias("doc_id"), F.col("event_type").alias("run"), F.col("event_id").alias("at"), F.col("event_type").alias("stage"), "event_id")
    return sinks.stage_events(e).select("event_id", "stage_index")


_ERRORS = ["HTTP 404 gone", "Missing API key", "503 unavailable", "no JSON object", "maximum context length", "timed out"]


@query(f"SELECT p_partkey AS doc_id, p_size AS chunk, CASE p_size % 6 WHEN 0 THEN 'request' WHEN 1 THEN 'configuration' WHEN 2 THEN 'temporary' WHEN 3 THEN 'other' WHEN 4 THEN 'request' ELSE 'temporary' END AS error_kind, {_pick(_ERRORS, 'p_size')} AS error FROM part WHERE p_size % 7 > 0")
def error_rows(spark: SparkSession, sf: str) -> DataFrame:
    d = part(spark, sf).select(F.col("p_partkey").alias("doc_id"), F.col("p_size").alias("chunk"), F.when(F.col("p_size") % 7 > 0, F.expr(_pick(_ERRORS, "p_size"))).alias("error"))
    return sinks.errors(d)


@query("SELECT count(*) AS documents, sum(p_size)::BIGINT AS level_change_count, sum(p_size % 3)::BIGINT AS added_count, sum(p_size % 2)::BIGINT AS removed_count FROM part")
def review_summary(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("p_size").cast("long")
    return sinks.review_summary(part(spark, sf).select(n.alias("level_change_count"), (n % 3).alias("added_count"), (n % 2).alias("removed_count")))


@query(O.query("SELECT * FROM (SELECT doc_id, pos, page, count(*) OVER (PARTITION BY doc_id) AS source_chapter_count, count(*) FILTER (page BETWEEN 1 AND 2) OVER (PARTITION BY doc_id) AS chapter_count FROM book_toc WHERE doc_id % 2 = 0) WHERE page BETWEEN 1 AND 2", *BOOK))
def trimmed_with_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = book_toc(spark, sf)
    ranges = t.where("doc_id % 2 = 0").select("doc_id").distinct().select("doc_id", F.lit(1).alias("start_page"), F.lit(2).alias("end_page"))
    return sinks.trimmed_results(t, ranges).select("doc_id", "pos", "page", "source_chapter_count", "chapter_count")


@query("""SELECT p_partkey, CASE WHEN k = 1 THEN name ELSE regexp_replace(name, '[.][^.]*$', '') || '_' || k || '.json' END AS name, replace(p_name, ' ', '_') || '.pdf' AS upload FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY p_partkey) AS k FROM (SELECT p_partkey, p_name, p_name || '_' || p_brand[1:5] || '_' || p_size % 3 || '_toc.json' AS name FROM part))""")
def result_names(spark: SparkSession, sf: str) -> DataFrame:
    d = part(spark, sf).select("p_partkey", F.col("p_partkey").alias("n"), sinks.result_name(F.col("p_name"), F.concat(F.substring("p_brand", 1, 5), F.lit("##")), (F.col("p_size") % 3).cast("string")).alias("name"), sinks.ascii_name(F.col("p_name")).alias("upload"))
    return sinks.unique_names(d).select("p_partkey", "name", "upload")


@query("""SELECT 'name' || repeat(' ', greatest(0, w - 4)) || '  n ' || chr(10) || repeat('-', w::INT) || '  --' || chr(10) || body AS text FROM (SELECT w, string_agg(rtrim(rpad(name, w::INT, ' ') || '  ' || n), chr(10) ORDER BY name) AS body FROM (SELECT name, n, max(length(name)) OVER () AS w FROM (SELECT p_name AS name, 10 + count(*) % 90 AS n FROM part GROUP BY p_name)) GROUP BY w)""".replace("'  n ' || chr(10)", "'  n' || chr(10)"))
def printed_table(spark: SparkSession, sf: str) -> DataFrame:
    d = part(spark, sf).groupBy(F.col("p_name").alias("name")).agg((10 + F.count("*") % 90).alias("n")).withColumn("at", F.col("name"))
    return sinks.table_text(d, "at")
