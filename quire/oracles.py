"""DuckDB SQL of the text functions and of the adapters over the tables, as pieces of the queries' SQL."""

from __future__ import annotations

CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{200B}\x{FEFF}]"
SPACE = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SEPARATORS = r"[\s\x{00A0}\x{2000}-\x{200A}\x{3000}\-–—_:;,.·•∙ㆍ|/\\()\[\]{}]+"


def sub(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def clean(x: str) -> str:
    return f"trim({sub(sub(f'coalesce({x}::VARCHAR, {chr(39) * 2})', CONTROL), SPACE + '+', ' ')})"


def compact(x: str) -> str:
    return f"replace({clean(x)}, ' ', '')"


def match_key(x: str) -> str:
    return f"lower({compact(x)})"


def norm(x: str) -> str:
    return f"replace(replace({sub(f'coalesce({x}::VARCHAR, {chr(39) * 2})', SPACE + '+')}, '–', '-'), '—', '-')"


def norm_key(x: str) -> str:
    return sub(f"lower({clean(x)})", SEPARATORS)


def edge_key(x: str) -> str:
    return sub(sub(f"lower({clean(x)})", r"\p{Nd}+"), SEPARATORS)


def shape(x: str) -> str:
    return sub(sub(x, r"\p{L}+", "A"), r"\p{N}+", "#")


def like(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, '{pattern}')"


DOC_LINES = """
doc_lines AS (
  SELECT doc_id, p - 1 AS line_index, (p - 1) // 20 + 1 AS page, (p - 1) % 20 + 1 AS source_order, ((p - 1) % 20) / 20 AS rel_y0, ((p - 1) % 20 + 1) / 20 AS rel_y1, l[p] AS text
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS p FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
)"""

_UNSEEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<title\b[^>]*>.*?</title>"
_INLINE = r"(?i)</?(?:a|b|i|em|strong|span|u|small|sup|sub|code|font|mark|abbr|cite|q|time|img|label)(?:\s[^>]*)?/?>"
_UNESCAPED = "replace(replace(replace(replace(replace(regexp_replace(m, '^<[^>]*>', ''), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&nbsp;', ' '), '&amp;', '&')"
HTML_LINES = f"""
html_lines AS (
  SELECT doc_id, n AS source_order, tag, s, s / 10 AS r, x, CASE WHEN tag = 'footer' THEN 780.0 ELSE 60.0 + 17.0 * (n % 40) END AS y, b, 0 AS i, 'f1' AS f, text FROM (
    SELECT doc_id, n, tag, CASE tag WHEN 'h1' THEN 24.0 WHEN 'h2' THEN 18.0 WHEN 'h3' THEN 14.0 WHEN 'li' THEN 9.0 WHEN 'td' THEN 9.0 WHEN 'footer' THEN 8.0 WHEN 'nav' THEN 8.0 ELSE 10.0 END::DOUBLE AS s, CASE WHEN tag IN ('li', 'nav') THEN 40.0 ELSE 72.0 END::DOUBLE AS x, CASE WHEN tag IN ('h1', 'h2', 'h3') THEN 1 ELSE 0 END AS b, {clean(_UNESCAPED)} AS text
    FROM (SELECT doc_id, n, ms[n] AS m, lower(regexp_extract(ms[n], '^<(/?[A-Za-z][A-Za-z0-9]*)', 1)) AS tag FROM (
      SELECT doc_id, ms, unnest(range(1, len(ms) + 1)) AS n FROM (
        SELECT page_id AS doc_id, regexp_extract_all({sub(sub("coalesce(html, '')", _UNSEEN), _INLINE)}, '<(?:/?[A-Za-z][A-Za-z0-9]*)[^>]*>[^<]*') AS ms FROM pages)))) WHERE text <> ''
)"""

#: Titles with every kind of number in front.
TITLES = """
titles AS (
  SELECT p_partkey AS doc_id, CASE p_partkey % 8
    WHEN 0 THEN '제' || p_size || '장 ' || p_name WHEN 1 THEN '1.' || p_size || ' ' || p_name WHEN 2 THEN p_size || '. ' || p_name WHEN 3 THEN '(' || p_size || ') ' || p_name
    WHEN 4 THEN p_size || ') ' || p_name WHEN 5 THEN p_size || ' ' || p_name WHEN 6 THEN '1.2.' || p_size || '. ' || p_name ELSE p_name || ' ..... ' || p_size END AS title
  FROM part
)"""

#: Tables of contents: a document of 50 parts each; styles and levels go together but for every ninth.
TOC = """
toc AS (
  SELECT p_partkey // 50 AS doc_id, p_partkey % 50 AS pos, CASE WHEN p_partkey % 9 = 0 THEN 1 ELSE p_size % 4 + 1 END AS level,
    CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE p_name || ' ' || p_brand || ' ' || p_partkey % 7 END AS chapter, p_partkey % 50 // 4 + 1 AS page,
    (10 + p_size % 4 * 2)::DOUBLE AS font_size, (1 + p_size % 4 / 5)::DOUBLE AS size_ratio FROM part
)"""

HIERARCHY = """
hierarchy AS (
  SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS pos,
    l_quantity::INT % 5 + 1 AS level, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) * 3 AS page, l_linenumber, l_quantity FROM lineitem
)"""


def query(select: str, *parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


#: Documents as books: 6 lines a page, styles and numbering by the line's place.
BOOK_LINES = f"""
book_lines AS (
  SELECT doc_id, p AS line_index, p // 6 + 1 AS page, p % 6 + 1 AS source_order, (10 + p * 7 % 4 * 2)::DOUBLE AS s, ((10 + p * 7 % 4 * 2) / 10)::DOUBLE AS r, (40 + 16 * (p % 3))::DOUBLE AS x, (50 + 120 * (p % 6))::DOUBLE AS y,
    (p % 5 = 0)::INT AS b, (p % 7 = 3)::INT AS i, 'f' || p % 2 + 1 AS f,
    CASE p % 8 WHEN 0 THEN '제' || p // 8 + 1 || '장 ' || t WHEN 2 THEN p // 8 + 1 || '.' || p % 3 + 1 || ' ' || t WHEN 5 THEN 'Figure ' || p || '. ' || t WHEN 6 THEN '(' || p % 9 + 1 || ') ' || t ELSE t END AS text
  FROM (SELECT doc_id, k - 1 AS p, {clean("l[k]")} AS t FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS k FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))) WHERE t <> ''
)"""

#: Every other line as an entry: as it is, cut, continued or unknown; some pages are wrong, some have the line's number or a reason.
BOOK_TOC = """
book_toc AS (
  SELECT doc_id, line_index // 2 AS pos, line_index // 2 % 4 + 1 AS level, CASE line_index // 2 % 5 WHEN 1 THEN text[:length(text) // 2 + 1] WHEN 2 THEN text || ' and more' WHEN 3 THEN 'Unknown ' || line_index ELSE text END AS chapter,
    CASE WHEN line_index // 2 % 7 = 0 THEN page + 1 ELSE page END AS page, CASE WHEN line_index // 2 % 6 = 0 THEN source_order END AS source_order, CASE WHEN line_index // 2 % 3 = 0 THEN 'because ' || line_index END AS level_reason
  FROM book_lines WHERE line_index % 2 = 0
)"""

#: The same entries with the layout that some of them have already.
BOOK_STYLED = """
book_styled AS (
  SELECT doc_id, pos, level, chapter, page, level_reason, CASE WHEN pos % 3 <> 1 THEN (40 + pos % 5)::DOUBLE END AS x, CASE WHEN pos % 3 <> 1 THEN (50 + 60 * (pos % 13))::DOUBLE END AS y,
    CASE WHEN pos % 3 <> 1 THEN (10 + level)::DOUBLE END AS font_size, CASE WHEN pos % 3 <> 1 THEN (1 + level / 10)::DOUBLE END AS size_ratio, CASE WHEN pos % 3 = 0 THEN chapter WHEN pos % 3 = 2 THEN chapter || ' tail' END AS layout_text,
    CASE WHEN pos % 3 <> 1 THEN page END AS layout_page, CASE WHEN pos % 3 <> 1 THEN pos % 2 END AS bold, CASE WHEN pos % 3 <> 1 THEN 0 END AS italic, CASE WHEN pos % 9 = 0 THEN pos * 2 END AS source_order, CASE WHEN pos % 4 = 2 THEN pos END AS merge_order
  FROM book_toc
)"""


def title_score(t: str, w: str, text: str, font: str, ratio: str, y: str) -> str:
    """Score of a line (key w) for a title (key t), as functions.numbers.title_line_score has it; null if there is none."""
    cover = f"CASE WHEN {t} = {w} THEN 1.0::DOUBLE WHEN contains({t}, {w}) OR contains({w}, {t}) THEN least(length({t}), length({w})) / greatest(length({t}), length({w})) END"
    size, scale = f"coalesce({font}, 0.0)", f"coalesce(nullif({ratio}, 0.0), 1.0)"
    listing = f"({like(clean(text), '[·ㆍ.]{3,}\\s*\\d+\\s*$')} OR {like(clean(text), '\\S\\s+\\d{1,4}$')})"
    weak = f"(coalesce({font} <= 10.5, false) OR coalesce({ratio} <= 1.05, false))"
    parts = [
        f"CASE WHEN {t} = {w} THEN 300.0 ELSE 45.0 END", f"{size} * 3", f"{scale} * 20", f"({cover}) * 200", f"- CASE WHEN {listing} THEN 180.0 ELSE 0.0 END",
        f"- CASE WHEN coalesce({weak} AND ({y} <= 65 OR {y} >= 735), false) THEN 80.0 ELSE 0.0 END", f"- CASE WHEN {size} <= 10.5 AND {scale} <= 1.05 THEN 20.0 ELSE 0.0 END",
        f"- CASE WHEN {t} <> {w} AND ({cover}) < 0.5 THEN 100.0 ELSE 0.0 END", f"- CASE WHEN length({w}) < greatest(4, floor(length({t}) * 0.25)) THEN 25.0 ELSE 0.0 END",
    ]
    return f"CASE WHEN length({t}) > 0 AND length({w}) > 0 AND ({cover}) >= 0.25 THEN ({' + '.join(parts).replace('+ -', '-')})::DOUBLE END"


WRAPPERS = "｜|[](){}<>〈〉「」『』·•∙ㆍ-–— "
DOTS, ROMAN = r"[∙·•ㆍ\-–—]*", r"[ivxlcdm]{1,12}"
USEFUL = r"[^A-Za-z0-9\x{AC00}-\x{D7A3}\x{3130}-\x{318F}\x{1100}-\x{11FF}\x{4E00}-\x{9FFF}.,:;!?()\[\]{}+\-/%·ㆍ]"
QUESTIONS = ["설명하시오", "제시하시오", "기술하시오", "정의하시오", "제안하시오", "나열할수있다", "설명할수있다", "비교하시오", "요약하시오", "알아보자"]
KO = r"^제\s*(\d+)\s*(편|부|장|절)\s*(.*)$"
DECIMAL = r"^(\d+(?:\.\d+){1,5})\.?\s*(\S.*)$"
BRACKETS = {"arabic_dot": (r"^(\d{1,2})\.\s*(\S.*)$", "{n} || '.'"), "arabic_paren_wrap": (r"^\((\d{1,2})\)\s*(\S.*)$", "'(' || {n} || ')'"), "arabic_paren": (r"^(\d{1,2})\)\s*(\S.*)$", "{n} || ')'"), "bare_number": (r"^(\d{1,2})\s+(\S.*)$", "{n}::VARCHAR")}


def strings(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def page_marker(c: str) -> str:
    """Of cleaned text."""
    k = f"lower(replace({c}, ' ', ''))"
    return f"({k} NOT IN ('차례', '목차', 'contents', '찾아보기', '색인', 'index') AND ({like(k, f'^{DOTS}(?:{ROMAN}|[0-9]{{1,4}}){DOTS}$')} OR {like(k, f'^(?:{ROMAN})?{DOTS}(?:차례|목차|찾아보기|색인){DOTS}(?:{ROMAN})?$')}))"


def formula(c: str) -> str:
    t = f"replace({c}, ' ', '')"
    return f"({t} = '' OR {like(t, '[\\p{C}]')} OR {like(t, '[=＋+÷×∑√≤≥≠≒∞]')} OR (length({t}) >= 3 AND length({sub(t, USEFUL)}) / length({t}) < 0.35))"


def reference_heading(c: str) -> str:
    return f"(lower(replace(trim({c}, '{WRAPPERS}'), ' ', '')) IN ('참고문헌', 'references', 'reference', 'bibliography', 'literaturecited'))"


def reference_item(c: str) -> str:
    return f"({like(c, r'^\d+\.\s*[A-Z][A-Za-z0-9\-]{1,30}\.?$')} OR {like(c, r'(?i)^\d+\.\s*[A-Z][A-Za-z\-]{1,30}\s+et\s+al\.?,?$')})"


def numbered(source: str, name: str = "v") -> str:
    """CTEs ending in `name`: the rows of source with c (cleaned text), k (compact), nk (norm key), style, number_text, body and level of the number, and the vetoes."""
    style = f"CASE WHEN {like('c', KO)} THEN CASE regexp_extract(c, '{KO}', 2) WHEN '장' THEN 'ko_chapter' WHEN '절' THEN 'ko_section' ELSE 'ko_part' END WHEN {like('c', DECIMAL)} THEN 'arabic_decimal_' || dots"
    text = f"CASE WHEN {like('c', KO)} THEN '제' || regexp_extract(c, '{KO}', 1)::INT || regexp_extract(c, '{KO}', 2) WHEN {like('c', DECIMAL)} THEN regexp_extract(c, '{DECIMAL}', 1)"
    body = f"CASE WHEN {like('c', KO)} THEN regexp_extract(c, '{KO}', 3) WHEN {like('c', DECIMAL)} THEN regexp_extract(c, '{DECIMAL}', 2)"
    level = f"CASE WHEN {like('c', KO)} THEN CASE regexp_extract(c, '{KO}', 2) WHEN '장' THEN 2 WHEN '절' THEN 3 ELSE 1 END WHEN {like('c', DECIMAL)} THEN least(3 + dots, 6)"
    for s, (p, form) in BRACKETS.items():
        style += f" WHEN {like('c', p)} THEN '{s}'"
        text += f" WHEN {like('c', p)} THEN " + form.format(n=f"regexp_extract(c, '{p}', 1)::INT")
        body += f" WHEN {like('c', p)} THEN regexp_extract(c, '{p}', 2)"
        level += f" WHEN {like('c', p)} THEN " + ("3" if s == "arabic_dot" else "NULL")
    dots = f"length(regexp_extract(c, '{DECIMAL}', 1)) - length(replace(regexp_extract(c, '{DECIMAL}', 1), '.', ''))"
    question = " OR ".join(f"contains(nk, '{q}')" for q in QUESTIONS)
    on = "(?:과|와|및|의|에|로|으로)$"
    opens = lambda x: f"length({x}) - length(replace({x}, '(', '')) > length({x}) - length(replace({x}, ')', ''))"
    return f"""
{name}_0 AS (SELECT *, {clean('text')} AS c FROM {source}),
{name}_1 AS (SELECT *, replace(c, ' ', '') AS k, {sub('lower(c)', SEPARATORS)} AS nk, {dots} AS dots FROM {name}_0),
{name}_2 AS (SELECT *, {style} END AS style, {text} END AS number_text, trim({body} END) AS body, ({level} END)::INT AS num_level FROM {name}_1),
{name}_3 AS (SELECT *, {like('c', r'^(?:\d+(?:\.\d+){1,5}\.?|\d{1,2}\.|\(\d{1,2}\)|\d{1,2}\))$')} AS alone, {page_marker('c')} AS page_mark, {formula('c')} AS formula, {reference_heading('c')} AS ref_head, {reference_item('c')} AS ref_item,
  lower(k) IN ('차례', '목차', 'contents', '찾아보기', '색인', 'index') AS front_back,
  coalesce(style IS NOT NULL AND NOT (style LIKE 'ko%' AND replace(body, ' ', '') = '') AND (length(replace(body, ' ', '')) <= 1 OR {reference_heading('body')} OR {page_marker('body')} OR {formula('body')} OR (style <> 'arabic_paren' AND {like('body', r'^[\d.,:/()%\[\]{}+\-\s]+$')})), false) AS bad_fragment FROM {name}_2),
{name}_4 AS (SELECT *, length(k) <= 1 OR alone OR nk = 'preventivemedicineandpublichealth' OR {question} OR front_back OR page_mark OR ref_head OR ref_item OR bad_fragment OR formula
    OR (coalesce(style NOT IN ('arabic_paren', 'arabic_dot', 'bare_number'), true) AND {like('c', r'^[\d.,:/()%\[\]{}+\-\s]+$')}) OR {like('c', r'^\([A-Za-z\s\-]{1,60}\)$')} AS bad,
  c = '' OR (NOT alone AND (page_mark OR formula OR {like('c', r'^[\d\s\-–—_.·•∙ㆍ|/\\]+$')} OR {like('c', r'(?i)^https?://|^www\.|^[\w.\-]+@[\w.\-]+$')})) AS noise,
  coalesce(style <> 'bare_number', false) AND NOT (ref_head OR ref_item OR page_mark OR formula OR bad_fragment) AS is_numbered,
  coalesce(style = 'arabic_paren' AND (regexp_matches(replace(body, ' ', ''), '^[0-9]{{1,4}}$') OR replace(body, ' ', '') IN ('「', '」', '『', '』', '(', ')', '-', '–', '—')), false) AS lone,
  coalesce(style IN ('arabic_paren', 'arabic_dot', 'bare_number') AND replace(body, ' ', '') <> '' AND (length(replace(body, ' ', '')) <= 8 OR {like("replace(body, ' ', '')", on)} OR {opens("replace(body, ' ', '')")}), false) AS after_number,
  nullif(regexp_extract(k, '^제[0-9]+(편|부|장|절)$', 1), '') AS label FROM {name}_3),
{name} AS (SELECT *, style IS NULL AND NOT bad AND length(k) >= 4 AND ({like('k', on)} OR {opens('k')}) AS after_plain, CASE WHEN num_level IS NOT NULL AND style NOT IN ('bare_number', 'arabic_paren') THEN num_level END AS fixed FROM {name}_4)"""


#: Broken headings: numbers alone, labels, cut titles, captions and marks, four lines of each ten near one another.
_PIECES = ["p_name", "'1.' || (p_size % 9)", "'(' || (p_size % 20) || ')'", "(p_size % 9 + 1) || '.'", "'제' || p_size || '장'", "'제' || p_size || '편'", "p_name || ' 및'", "(p_size % 9) || ') 1960'", "(p_size % 9) || ') ' || p_name || ' (' || p_type", "'References'", "'1.2 ' || p_name || ' ' || p_type || ' ' || p_name || ' and ' || p_name || ' ' || p_type || ' once more for length'", "'Figure ' || p_size || '. ' || p_name", "p_size || '. ' || p_name", "'년대 ' || p_name", "'제' || p_size || '절 ' || p_name", "'3.' || p_size || '.2 ' || p_name", "'- ' || p_size || ' -'", "p_size || ' ' || p_name", "'(' || (p_size % 9 + 1) || ') ' || p_name"]
PIECES = f"""
pieces AS (
  SELECT p_partkey // 40 AS doc_id, p_partkey % 40 AS pos, p_partkey % 40 AS line_index, p_partkey % 40 // 10 + 1 AS page, (10 + p_size % 5)::DOUBLE AS s, p_size % 2 AS b, 0 AS i, (60 + p_size % 3 * 40)::DOUBLE AS x0, (40 + p_partkey % 10 * (20 + p_partkey % 40 // 10 * 30))::DOUBLE AS y0,
    (200 + p_size)::DOUBLE AS x1, (40 + p_partkey % 10 * (20 + p_partkey % 40 // 10 * 30) + 12)::DOUBLE AS y1, 595.0::DOUBLE AS page_width, (p_size % 11)::DOUBLE AS score, p_size % 6 + 1 AS level,
    CASE (p_partkey * 7 + p_size) % {len(_PIECES)} {" ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(_PIECES))} END AS text FROM part
)"""
