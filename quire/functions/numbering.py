"""Numbering in front of headings: style, number, body and level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text, compact_text, let

#: Shapes in order of precedence; groups are the number and the body.
KO = r"^제\s*(\d+)\s*(편|부|장|절)\s*(.*)$"
DECIMAL = r"^(\d+(?:\.\d+){1,5})\.?\s*(\S.*)$"
SHAPES = [("arabic_dot", r"^(\d{1,2})\.\s*(\S.*)$", "%s."), ("arabic_paren_wrap", r"^\((\d{1,2})\)\s*(\S.*)$", "(%s)"), ("arabic_paren", r"^(\d{1,2})\)\s*(\S.*)$", "%s)"), ("bare_number", r"^(\d{1,2})\s+(\S.*)$", "%s")]
#: Numbers alone on a line.
DECIMAL_ALONE = r"^(\d+(?:\.\d+){1,5})\.?$"
PREFIXES = [("arabic_paren", r"^(\d{1,2})\)$", "%s)", None), ("arabic_paren_wrap", r"^\((\d{1,2})\)$", "(%s)", None), ("arabic_dot", r"^(\d{1,2})\.$", "%s.", 3)]
KO_STYLE = {"편": ("ko_part", 1), "부": ("ko_part", 1), "장": ("ko_chapter", 2), "절": ("ko_section", 3)}


def _info(style: Column, number: Column, text: Column, body: Column, level: Column) -> Column:
    return F.struct(style.alias("style"), number.cast("int").alias("number"), text.alias("number_text"), F.trim(body).alias("body"), level.cast("int").alias("level"))


def number_info(text: Column) -> Column:
    """struct<style, number, number_text, body, level> of the first shape that fits, its fields null if none does."""
    return let(clean_text(text), _number_info)


#: How every shape begins.
NUMBERED = r"^[제(\d]"


def _number_info(t: Column) -> Column:
    """Of cleaned text. Most lines begin as no shape does: they are held against none."""
    none = F.lit(None)
    return F.when(t.rlike(NUMBERED), _shaped_info(t)).otherwise(_info(none.cast("string"), none, none.cast("string"), none.cast("string"), none))


def _shaped_info(t: Column) -> Column:
    g = lambda p, i: F.regexp_extract(t, p, i)
    none = F.lit(None)
    out = _info(none.cast("string"), none, none.cast("string"), none.cast("string"), none)
    for style, shape, form in reversed(SHAPES):
        digits = g(shape, 1).try_cast("int")
        out = F.when(t.rlike(shape), _info(F.lit(style), digits, F.format_string(form, digits.cast("string")), g(shape, 2), F.lit(3) if style == "arabic_dot" else none)).otherwise(out)
    dots = F.char_length(g(DECIMAL, 1)) - F.char_length(F.replace(g(DECIMAL, 1), F.lit("."), F.lit("")))
    last = F.element_at(F.split(g(DECIMAL, 1), r"\."), -1).try_cast("int")
    out = F.when(t.rlike(DECIMAL), _info(F.concat(F.lit("arabic_decimal_"), dots.cast("string")), last, g(DECIMAL, 1), g(DECIMAL, 2), F.least(3 + dots, F.lit(6)))).otherwise(out)
    kind = F.create_map(*[x for k, (s, n) in KO_STYLE.items() for x in (F.lit(k), F.struct(F.lit(s).alias("s"), F.lit(n).alias("n")))])
    found = F.try_element_at(kind, g(KO, 2))
    number = g(KO, 1).try_cast("int")
    return F.when(t.rlike(KO), _info(found["s"], number, F.concat(F.lit("제"), number.cast("string"), g(KO, 2)), g(KO, 3), found["n"])).otherwise(out)


def label_level(text: Column) -> Column:
    """Level of a part, chapter or section label."""
    return let(number_info(text), lambda n: F.when(n["style"].startswith("ko_"), n["level"]))


def label_kind(text: Column) -> Column:
    return F.nullif(F.regexp_extract(compact_text(text), r"^제\d+(편|부|장|절)$", 1), F.lit(""))


def prefix_info(text: Column) -> Column:
    """struct<style, number_text, level> of a line that is a number alone; its fields null if it isn't."""
    return let(clean_text(text), _prefix_info)


def _prefix_info(t: Column) -> Column:
    none = F.lit(None)
    g = lambda p: F.regexp_extract(t, p, 1)
    row = lambda style, number, level: F.struct(style.alias("style"), number.alias("number_text"), level.cast("int").alias("level"))
    out = row(none.cast("string"), none.cast("string"), none)
    for style, shape, form, level in PREFIXES:
        out = F.when(t.rlike(shape), row(F.lit(style), F.format_string(form, g(shape).try_cast("int").cast("string")), F.lit(level))).otherwise(out)
    dots = F.char_length(g(DECIMAL_ALONE)) - F.char_length(F.replace(g(DECIMAL_ALONE), F.lit("."), F.lit("")))
    return F.when(t.rlike(DECIMAL_ALONE), row(F.concat(F.lit("arabic_decimal_"), dots.cast("string")), g(DECIMAL_ALONE), F.least(3 + dots, F.lit(6)))).otherwise(out)


def fixed_level(text: Column, max_depth: int = 6) -> Column:
    """The level that the shape of the number decides, clamped; null for bare numbers and those with a bracket."""
    return let(number_info(text), lambda n: _fixed_level(n, max_depth))


def _fixed_level(n: Column, max_depth: int = 6) -> Column:
    level = F.greatest(F.lit(1), F.least(n["level"], F.lit(max_depth)))
    return F.when(n["level"].isNotNull() & ~n["style"].isin("bare_number", "arabic_paren"), level)


def numbered_level(text: Column) -> Column:
    """fixed_level of what isn't vetoed as a heading."""
    from .predicates import heading_facts

    return let(heading_facts(text), lambda f: f["numbered_level"])


def is_numbered(text: Column) -> Column:
    """Whether a heading's number is one: not bare, and neither a reference, a page mark, a formula nor a bad fragment."""
    from .predicates import heading_facts

    return let(heading_facts(text), lambda f: f["numbered"])


def decimal_path(title: Column) -> Column:
    """1.2.3 at the start as [1, 2, 3]; null without a dot."""
    m = F.regexp_extract(clean_text(title), r"^\s*(\d+(?:\.\d+)+)\.?", 1)
    return F.when(m != "", F.transform(F.split(m, r"\."), lambda x: x.try_cast("int")))
