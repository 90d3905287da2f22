"""Text functions as Column expressions: cleaning, comparison keys, rendering."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as Unicode's \s, which Java's plain \s isn't; control characters; separators of keys.
SPACE = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
CONTROL = r"[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}\x{200B}\x{FEFF}]"
SEPARATORS = r"[\s\x{00A0}\x{2000}-\x{200A}\x{3000}\-–—_:;,.·•∙ㆍ|/\\()\[\]{}]+"
#: The same sets as characters: one pass by table, where a pattern asks every range of every character.
SPACES = "\t\n\x0b\x0c\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
CONTROLS = "".join(map(chr, [*range(0x09), 0x0B, 0x0C, *range(0x0E, 0x20), 0x7F, 0x200B, 0xFEFF]))
SEPARATOR_CHARS = "\t\n\x0b\x0c\r \u00a0" + "".join(map(chr, range(0x2000, 0x200B))) + "\u3000-–—_:;,.·•∙ㆍ|/\\()[]{}"
WRAPPERS = "｜|[](){}<>〈〉「」『』·•∙ㆍ-–— "
RUNNING = r"[∙·ㆍ.\-–—|:]"


def let(value: Column, body) -> Column:
    """body(v) with v bound to value, which is computed once and stands once in the plan."""
    return F.element_at(F.transform(F.array(value), body), 1)


def settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns that are computed once, whatever is made of them: a generator's output, into which neither later columns nor filters are moved."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def _text(c: Column | str) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def clean_text(c: Column | str) -> Column:
    """Without control characters, white space runs as one space, trimmed; null is ''."""
    spaces = "".join(x for x in SPACES if x not in CONTROLS)
    return let(F.translate(_text(c), spaces + CONTROLS, " " * len(spaces)), lambda t: F.trim(F.when(t.contains("  "), F.regexp_replace(t, "  +", " ")).otherwise(t)))


def compact_text(c: Column | str) -> Column:
    return F.replace(clean_text(c), F.lit(" "), F.lit(""))


def match_key(c: Column | str) -> Column:
    """Key by which titles and lines are matched: cleaned, without white space, lower-case."""
    return F.lower(compact_text(c))


def norm(c: Column | str) -> Column:
    """Without white space, dashes as hyphens, case kept."""
    return F.translate(_text(c), "–—" + SPACES, "--")


def norm_key(c: Column | str) -> Column:
    return F.translate(F.lower(clean_text(c)), SEPARATOR_CHARS, "")


def header_footer_key(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(clean_text(c)), r"\p{Nd}+", ""), SEPARATORS, "")


def duplicate_title_key(c: Column | str) -> Column:
    """Key of a title whatever page number runs before or after it."""
    t = clean_text(c)
    t = F.regexp_replace(t, rf"^\s*\d{{2,}}\s*{RUNNING}\s*", "")
    t = F.regexp_replace(t, rf"\s*{RUNNING}\s*\d+\s*$", "")
    bare = F.regexp_replace(F.regexp_replace(t, r"^\s*\d{2,}\s+", ""), r"\s+\d+\s*$", "")
    many = F.size(F.split(F.trim(t), " +")) >= 3
    return F.lower(F.regexp_replace(F.when(many, bare).otherwise(t), SPACE + "+", ""))


def strip_wrappers(c: Column | str) -> Column:
    return F.btrim(clean_text(c), F.lit(WRAPPERS))


def clean_extracted(c: Column | str) -> Column:
    """Cleaned, with line breaks kept and at most two blank lines in a row."""
    t = F.regexp_replace(F.regexp_replace(_text(c), r"\r\n?", "\n"), CONTROL, "")
    t = F.regexp_replace(F.replace(t, F.lit(" "), F.lit(" ")), r"[ \t]+", " ")
    return F.btrim(F.regexp_replace(t, r"\n{4,}", "\n\n\n"), F.lit(" \t\n\r"))


def normalize_ocr(c: Column | str) -> Column:
    """No spaces between Hangul syllables, tidy spaces around punctuation."""
    t = F.regexp_replace(clean_text(c), r"(?<=[\x{AC00}-\x{D7A3}]) (?=[\x{AC00}-\x{D7A3}])", "")
    return F.regexp_replace(F.regexp_replace(t, r"\s+([,.;:!?)\]])", "$1"), r"([(\[])\s+", "$1")


def safe_name(c: Column | str, default: str = "model") -> Column:
    t = F.btrim(F.regexp_replace(_text(c), r"[^A-Za-z0-9_.\-]+", "_"), F.lit("._-"))
    return F.when(t == "", F.lit(default)).otherwise(t)


def safe_hangul_name(c: Column | str, default: str = "input") -> Column:
    t = F.btrim(F.regexp_replace(_text(c), r"[^A-Za-z0-9_.\-\x{AC00}-\x{D7A3}]+", "_"), F.lit("._-"))
    return F.when(t == "", F.lit(default)).otherwise(t)


def short_title(c: Column | str, most: int = 80) -> Column:
    t = clean_text(c)
    return F.when(F.char_length(t) <= most, t).otherwise(F.concat(F.rtrim(F.substring(t, 1, most - 1)), F.lit("...")))


def font_name(c: Column | str, most: int = 24) -> Column:
    """A font's name without its subset prefix."""
    return F.substring(F.regexp_replace(F.regexp_replace(_text(c), r"^[^+]*\+", ""), r"[^A-Za-z0-9_\-]", ""), 1, most)


def font_bold(c: Column | str) -> Column:
    return F.lower(_text(c)).rlike("bold|black|heavy|semibold|demi|medium").cast("int")


def font_italic(c: Column | str) -> Column:
    return F.lower(_text(c)).rlike("italic|oblique").cast("int")


def token_shape(c: Column | str) -> Column:
    """Numbers as #, letters as A, runs collapsed; other characters stand. For NFKC text (see nfkc)."""
    return F.regexp_replace(F.regexp_replace(_text(c), r"\p{L}+", "A"), r"\p{N}+", "#")


def tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(_text(c), F.lit(r"\S+"), F.lit(0))


def page_range(first: Column, last: Column) -> Column:
    return F.when(first == last, first.cast("string")).otherwise(F.concat_ws("-", first.cast("string"), last.cast("string")))


def number_path_text(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda x: x.cast("string")), ".")


def style_key_text(font: Column, ratio: Column) -> Column:
    t = F.concat_ws(", ", F.concat(F.lit("font_size="), font.cast("string")), F.concat(F.lit("size_ratio="), ratio.cast("string")))
    return F.when(t == "", F.lit("no layout style")).otherwise(t)


def layout_tag(s: Column, r: Column, x: Column, y: Column, b: Column, i: Column, f: Column, text: Column) -> Column:
    """A line in the lower-case layout grammar."""
    head = F.format_string("[L s=%.1f r=%.2f x=%.0f y=%.0f b=%d i=%d f=%s] ", F.bround(s.cast("double"), 1), F.bround(r.cast("double"), 2), F.bround(x.cast("double"), 0), F.bround(y.cast("double"), 0), b.cast("int"), i.cast("int"), f)
    return F.concat(head, text)


def elapsed_text(seconds: Column) -> Column:
    """1.5s, 2m 3.0s, 1h 2m 3.0s."""
    s = seconds.cast("double")
    m, h = F.floor(s / 60), F.floor(s / 3600)
    tenths = lambda c: F.format_string("%.1fs", F.bround(c, 1))  # noqa: E731  # ties go to the even digit
    rest = tenths(s - m * 60)
    return (
        F.when(s < 60, tenths(s))
        .when(s < 3600, F.concat(m.cast("string"), F.lit("m "), rest))
        .otherwise(F.concat(h.cast("string"), F.lit("h "), (m - h * 60).cast("string"), F.lit("m "), rest))
    )


def nfkc(c: Column | str) -> Column:
    """Unicode NFKC, which the JVM's functions lack: an Arrow UDF, for texts that aren't ASCII."""

    def normalize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:  # local, so that workers get it by value
        for s in batches:
            yield s.str.normalize("NFKC")

    t = _text(c)
    return F.when(F.octet_length(t) == F.char_length(t), t).otherwise(F.pandas_udf(normalize, "string")(t))


def document_key(c: Column | str) -> Column:
    """A document's name as a join key: NFKC, lower-case, only letters of its alphabets and digits."""
    return F.regexp_replace(F.lower(nfkc(c)), r"[^0-9a-z\x{AC00}-\x{D7A3}]", "")
