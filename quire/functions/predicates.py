"""Predicates on titles, lines and styles as Column expressions. Titles are cleaned first; null counts as ''."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SEPARATOR_CHARS, WRAPPERS, clean_text, compact_text, let, norm_key

#: Words and shapes of the documents that the predicates know.
FRONT_WORDS = ["차례", "목차", "contents"]
BACK_WORDS = ["찾아보기", "색인", "index"]
REFERENCE_WORDS = ["참고문헌", "references", "reference", "bibliography", "literaturecited"]
QUESTION_WORDS = ["설명하시오", "제시하시오", "기술하시오", "정의하시오", "제안하시오", "나열할수있다", "설명할수있다", "비교하시오", "요약하시오", "알아보자"]
PROGRAM_TITLES = ["untitled", "document", "microsoftword", "hwp", "hwpx"]
PARTICLES = ["과", "와", "및", "의", "에", "로", "으로"]
LONE_MARKS = ["「", "」", "『", "』", "(", ")", "-", "–", "—"]
COVER_NOISE = ["preventivemedicineandpublichealth"]
ROMAN = r"[ivxlcdm]{1,12}"
DOTS = r"[∙·•ㆍ\-–—]*"
MARKER_ONLY = r"(?i)^(?:(?:chapter|part|section|unit)\s*\d+[a-z]?|제\s*\d+\s*[장절편부]|\d+(?:\.\d+)*[.)]?)$"
MARKERS = [
    r"^(?:chapter|part|section|unit)\s*\d+[a-z]?\b", r"^제\s*\d+\s*[장절편부]\b", r"^\d+(?:\.\d+)+\b", r"^\d+\s*[.)]",
    r"^\([^)]+\)", r"^[a-z]\s*[.)]", r"^[가-힣]\s*[.)]",
]
CAPTION = r"(?i)^(?:그림|도표|표)\s*\d+[-.\s]|(?i)^(?:figure|fig\.?|table)\s*\d+[-.\s:]"
VISUAL = r"(?i)^(?:표|그림|figure|fig\.|table|box)\s*[\dIVXivx가-힣.:\-]"
ANCILLARY = [
    r"^\[?\s*(?:사례|예시|보기|case|example|box)\s*\d*", r"^(?:표|그림|figure|fig\.|table)\s*[\dIVXivx가-힣.:\-]",
    r"^(?:기본\s*문제|심화\s*문제|연습\s*문제|문제|참고문헌|references?)\b",
]
LISTING = r"[·ㆍ.]{3,}\s*\d+\s*$"


def is_marker_only(title: Column) -> Column:
    return clean_text(title).rlike(MARKER_ONLY)


def has_structural_marker(title: Column) -> Column:
    return clean_text(title).rlike("(?iU)" + "|".join(MARKERS))


def is_probable_non_heading(title: Column) -> Column:
    return let(clean_text(title), _probable_non_heading)


def _probable_non_heading(t: Column) -> Column:
    return (
        (t == "") | (F.char_length(t) > 180) | t.rlike(r"^[\d\s.,;:()\-_/]+$") | t.rlike(r"^[•●▪▫\-–—*]\s+")
        | t.rlike(r"(?i)^(?:table|figure|fig\.|box|표|그림)\s*[\dIVXivx가-힣.:\-]") | ((F.char_length(t) > 80) & t.rlike(r"(?:다|요|니다|였다|한다|있다|된다|\.|;|:)$"))
    )


def is_ancillary(title: Column) -> Column:
    return clean_text(title).rlike("(?iU)" + "|".join(ANCILLARY))


def is_visual_caption(title: Column) -> Column:
    return clean_text(title).rlike(VISUAL)


def is_caption(text: Column) -> Column:
    return clean_text(text).rlike(CAPTION)


def is_toc_listing(text: Column) -> Column:
    # Both shapes end in a digit, or in one before a last \x85, where Java's $ matches too: other texts aren't searched.
    return let(clean_text(text), lambda t: F.substring(t, -1, 1).isin(*"0123456789\x85") & (t.rlike(LISTING) | t.rlike(r"\S\s+\d{1,4}$")))


def is_existing_toc_line(title: Column, *, keep_listings: bool = True) -> Column:
    """Dot leaders and a page number; the present behaviour keeps such lines, so nothing is one."""
    return F.lit(False) if keep_listings else clean_text(title).rlike(LISTING)


def is_running_header_footer(y: Column, font: Column, ratio: Column) -> Column:
    weak = F.coalesce(font <= 10.5, F.lit(False)) | F.coalesce(ratio <= 1.05, F.lit(False))
    return F.coalesce(weak & ((y <= 65) | (y >= 735)), F.lit(False))


def is_repeated_running_title(title: Column, y: Column, font: Column, ratio: Column, bold: Column, italic: Column) -> Column:
    weak = F.coalesce(ratio <= 1.12, F.lit(False)) | F.coalesce(font <= 11, F.lit(False))
    plain = (F.coalesce(bold, F.lit(0)) == 0) & (F.coalesce(italic, F.lit(0)) == 0)
    return F.coalesce(((y <= 125) | (y >= 720)) & ((weak & plain) | is_marker_only(title)), F.lit(False))


# Predicates with an underscore are of cleaned text, or of its compact form k: what is cleaned isn't cleaned again.


def is_front_back_title(text: Column) -> Column:
    return _front_back(compact_text(text))


def _front_back(k: Column) -> Column:
    return F.lower(k).isin(FRONT_WORDS + BACK_WORDS)


def is_page_marker(text: Column) -> Column:
    return let(compact_text(text), _page_marker)


def _page_marker(k: Column) -> Column:
    t = F.lower(k)
    return (~t.isin(FRONT_WORDS + BACK_WORDS) & (t.rlike(f"^{DOTS}(?:{ROMAN}|\\d{{1,4}}){DOTS}$") | t.rlike(f"^(?:{ROMAN})?{DOTS}(?:차례|목차|찾아보기|색인){DOTS}(?:{ROMAN})?$")))


def is_page_number_line(text: Column) -> Column:
    return clean_text(text).rlike(r"(?i)^(?:page\s*)?\d+(?:\s*/\s*\d+)?$|^-\s*\d+\s*-$") | is_page_marker(text)


def is_reference_heading(text: Column) -> Column:
    return _reference_heading(clean_text(text))


def _reference_heading(t: Column) -> Column:
    return F.lower(F.replace(F.btrim(t, F.lit(WRAPPERS)), F.lit(" "), F.lit(""))).isin(REFERENCE_WORDS)


def is_reference_item(text: Column) -> Column:
    return let(clean_text(text), _reference_item)


def _reference_item(t: Column) -> Column:
    return t.rlike(r"^\d+\.\s*[A-Z][A-Za-z0-9\-]{1,30}\.?$") | t.rlike(r"(?i)^\d+\.\s*[A-Z][A-Za-z\-]{1,30}\s+et\s+al\.?,?$")


def is_formula_or_corrupt(text: Column) -> Column:
    return let(compact_text(text), _formula_or_corrupt)


def _formula_or_corrupt(k: Column) -> Column:
    from .numbers import useful_share

    return (k == "") | k.rlike(r"\p{C}") | (F.char_length(F.translate(k, "=＋+÷×∑√≤≥≠≒∞", "")) < F.char_length(k)) | ((F.char_length(k) >= 3) & (useful_share(k) < 0.35))


def is_hangul_or_han(ch: Column) -> Column:
    return ch.rlike(r"^[\x{AC00}-\x{D7A3}\x{3130}-\x{318F}\x{1100}-\x{11FF}\x{4E00}-\x{9FFF}]$")


def is_label_only(text: Column) -> Column:
    return compact_text(text).rlike(r"^제\d+(?:편|부|장|절)$")


def is_number_prefix_only(text: Column) -> Column:
    return _number_alone(clean_text(text))


def _number_alone(t: Column) -> Column:
    return t.rlike(r"^(?:\d+(?:\.\d+){1,5}\.?|\d{1,2}\.|\(\d{1,2}\)|\d{1,2}\))$")


def heading_facts(text: Column) -> Column:
    """What a line's text says about it as a heading, in one struct, each part computed once: the cleaned text, its number and the vetoes."""
    from .numbering import _fixed_level, _number_info

    def parts(t: Column) -> Column:
        k = F.replace(t, F.lit(" "), F.lit(""))
        return let(F.struct(t.alias("clean"), k.alias("compact"), _number_info(t).alias("number")), seen)

    def seen(v: Column) -> Column:
        t, k, n = v["clean"], v["compact"], v["number"]
        return let(F.struct(
            t.alias("clean"), k.alias("compact"), n.alias("number"), _front_back(k).alias("front_back"), _page_marker(k).alias("page_marker"), _reference_heading(t).alias("reference_heading"),
            _reference_item(t).alias("reference_item"), _bad_fragment(n).alias("bad_fragment"), _formula_or_corrupt(k).alias("formula"), _number_alone(t).alias("alone"), _lone_fragment(n).alias("lone"),
        ), judged)

    def judged(v: Column) -> Column:
        t, n = v["clean"], v["number"]
        names = ("clean", "compact", "number", "front_back", "page_marker", "reference_heading", "reference_item", "bad_fragment", "formula", "alone", "lone")
        listed = v["reference_heading"] | v["reference_item"] | v["page_marker"] | v["formula"] | v["bad_fragment"]
        dropped = v["page_marker"] | v["formula"] | t.rlike(r"^[\d\s\-–—_.·•∙ㆍ|/\\]+$") | t.rlike(r"(?i)^https?://|^www\.|^[\w.\-]+@[\w.\-]+$")
        plain = ~F.coalesce(n["style"].isin("arabic_paren", "arabic_dot", "bare_number"), F.lit(False))
        bad = (
            (F.char_length(v["compact"]) <= 1) | v["alone"] | let(F.translate(F.lower(t), SEPARATOR_CHARS, ""), _known_noise) | v["front_back"] | listed
            | (plain & t.rlike(r"^[\d.,:/()%\[\]{}+\-\s]+$")) | t.rlike(r"^\([A-Za-z\s\-]{1,60}\)$")
        )
        return let(bad, lambda b: F.struct(
            *[v[c].alias(c) for c in names], b.alias("bad"), ((t == "") | (~v["alone"] & dropped)).alias("noise"), t.rlike(CAPTION).alias("caption"),
            (F.coalesce(n["style"] != "bare_number", F.lit(False)) & ~listed).alias("numbered"), _fixed_level(n).alias("fixed_level"), F.when(~b, _fixed_level(n)).alias("numbered_level"),
        ))

    return let(clean_text(text), parts)


def is_noise(text: Column) -> Column:
    return let(heading_facts(text), lambda f: f["noise"])


def is_bad_heading(text: Column) -> Column:
    """Any of the vetoes on a heading's text."""
    return let(heading_facts(text), lambda f: f["bad"])


def _number_of(t: Column) -> Column:
    from .numbering import number_info

    return number_info(t)


def _known_noise(key: Column) -> Column:
    return key.isin(COVER_NOISE) | F.exists(F.array(*[F.lit(w) for w in QUESTION_WORDS]), lambda w: key.contains(w))


def is_bad_numbered_fragment(text: Column) -> Column:
    """Numbered, but with nothing after the number that could be a heading; a part, chapter or section label may stand alone."""
    return let(_number_of(text), _bad_fragment)


def _bad_fragment(n: Column) -> Column:
    style = F.coalesce(n["style"], F.lit(""))

    def bad(body: Column) -> Column:
        marks = (style != "arabic_paren") & body.rlike(r"^[\d.,:/()%\[\]{}+\-\s]+$")
        k = F.replace(body, F.lit(" "), F.lit(""))
        return ~(style.startswith("ko_") & (body == "")) & ((F.char_length(k) <= 1) | _reference_heading(body) | _page_marker(k) | _formula_or_corrupt(k) | marks)

    return (style != "") & let(F.coalesce(n["body"], F.lit("")), bad)


def is_lone_number_fragment(text: Column) -> Column:
    """What is left of a bracketed number that found no title: a year or a single mark."""
    return let(_number_of(text), _lone_fragment)


def _lone_fragment(n: Column) -> Column:
    lone = lambda body: body.rlike(r"^\d{1,4}$") | body.isin(LONE_MARKS)
    return F.coalesce(n["style"] == "arabic_paren", F.lit(False)) & let(compact_text(F.coalesce(n["body"], F.lit(""))), lone)


def _goes_on(text: Column) -> Column:
    """Whether a text ends as one that goes on: in a particle or an open bracket."""
    count = lambda ch: F.char_length(text) - F.char_length(F.replace(text, F.lit(ch), F.lit("")))
    return text.rlike(f"(?:{'|'.join(PARTICLES)})$") | (count("(") > count(")"))


def merges_after_number(text: Column) -> Column:
    """Whether a numbered line's title goes on in the next line."""
    return let(_number_of(text), _merges_after_number)


def _merges_after_number(n: Column) -> Column:
    goes = lambda body: (body != "") & ((F.char_length(body) <= 8) | _goes_on(body))
    return F.coalesce(n["style"].isin("arabic_paren", "arabic_dot", "bare_number"), F.lit(False)) & let(compact_text(F.coalesce(n["body"], F.lit(""))), goes)


def merges_after_plain(text: Column) -> Column:
    """Whether an unnumbered title goes on in the next line."""
    return let(heading_facts(text), _merges_after_plain)


def _merges_after_plain(f: Column) -> Column:
    return f["number"]["style"].isNull() & ~f["bad"] & (F.char_length(f["compact"]) >= 4) & _goes_on(f["compact"])


def is_bad_metadata_title(title: Column, stem: Column) -> Column:
    """No title, one of a program, a file's name or a hash."""
    t, key = clean_text(title), norm_key(title)
    return (
        (t == "") | (key == norm_key(stem)) | key.isin(PROGRAM_TITLES) | t.rlike(r"^<[A-Fa-f0-9]{10,}(?:\.[A-Za-z0-9]+)?>$") | t.rlike(r"^[A-Fa-f0-9]{12,}(?:\.[A-Za-z0-9]+)?$")
        | t.rlike(r"(?i)^[A-Za-z0-9_\-]{20,}\.(?:hwp|hwpx|doc|docx|pdf)$") | is_formula_or_corrupt(title)
    )


def is_complete_toc(path: Column) -> Column:
    return path.rlike(r"(?i)_toc\.json$") & ~path.rlike(r"(?i)_chunk\d+")


def span_is_bold(flags: Column, font: Column) -> Column:
    return (flags.bitwiseAND(F.lit(16)) != 0) | F.lower(font).rlike("bold|black|heavy|semibold|semi-bold|demibold|medium")


def span_is_italic(flags: Column, font: Column) -> Column:
    return (flags.bitwiseAND(F.lit(2)) != 0) | F.lower(font).rlike("italic|oblique")


def is_style_heading(title: Column, ratio: Column, bold: Column, italic: Column, known_style: Column) -> Column:
    """A line whose style makes it a heading; known_style: a heading of the table of contents has that style."""
    scale = F.coalesce(F.nullif(ratio, F.lit(0.0)), F.lit(1.0))
    b, i = bold > 0, italic > 0
    body = (scale <= 1.08) & ~b & ~i & ~has_structural_marker(title)
    return ~is_probable_non_heading(title) & ~body & (known_style | (scale >= 1.18) | (b & (scale >= 1.03)) | (i & (scale >= 1.08)))


def style_near(font: Column, ratio: Column, known_font: Column, known_ratio: Column) -> Column:
    """Whether a style is within 1.0 of a font size and 0.12 of a size ratio; what is null on the known side doesn't count."""
    f = F.coalesce(F.abs(font - known_font) <= 1.0, F.lit(False))
    r = F.coalesce(F.abs(ratio - known_ratio) <= 0.12, F.lit(False))
    return (f & (r | known_ratio.isNull())) | (r & (f | known_font.isNull()))


def is_merge_truncated(out_max: Column, out_count: Column, source_max: Column, source_count: Column, source_after: Column) -> Column:
    """Whether a merged table lost its tail: out_* are its last page and entries, source_* those of the partial tables,
    source_after the entries of theirs beyond out_max + 3."""
    some = (source_count > 0) & out_max.isNotNull() & source_max.isNotNull()
    tail = (source_max - out_max >= 10) & (source_after >= 3)
    few = (source_count >= 50) & (out_count < F.greatest(F.lit(10), F.floor(source_count / 5))) & (source_max - out_max >= 5)
    return F.coalesce(some & (tail | few), F.lit(False))


def has_heading_marker(title: Column) -> Column:
    """Whether a title begins with a chapter's mark or number."""
    return clean_text(title).rlike(r"(?iU)^(?:chapter|part|section|unit)\s*\d+[A-Za-z]?\b|^제\s*\d+\s*[장절편부]\b|^\d+(?:\.\d+)*\s*[.)]\s*|^\d+\s+제\s*장\b")


def is_generic_title(title: Column, fallback: Column) -> Column:
    """Empty, the file's own name, or a word for a table of contents."""
    key = F.lower(compact_text(title))
    return (key == "") | (key == F.lower(compact_text(fallback))) | key.isin("documenttitle", "tableofcontents", "toc", "contents", "목차", "차례")


def is_title_like(title: Column, font: Column, ratio: Column, bold: Column, italic: Column) -> Column:
    """Whether a line could be a title by its style or its mark, and is neither body text nor a caption nor long."""
    scale, size = F.coalesce(F.nullif(ratio, F.lit(0.0)), F.lit(1.0)), F.coalesce(font, F.lit(0.0))
    styled = (scale >= 1.12) | (size >= 14.0) | F.coalesce(bold != 0, F.lit(False)) | F.coalesce(italic != 0, F.lit(False)) | (has_structural_marker(title) & (scale >= 1.05))
    return ~is_probable_non_heading(title) & ~is_ancillary(title) & (F.char_length(clean_text(title)) <= 140) & styled
