"""Null-safe casts, distances and scores as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .predicates import is_running_header_footer, is_toc_listing
from .text import clean_text, let, match_key


def float_or_null(c: Column) -> Column:
    return F.bround(c.try_cast("double"), 2)


def int_or_null(c: Column) -> Column:
    """Whole numbers only: '12.7' is null, a number 12.7 is 12."""
    return c.try_cast("int")


def int_or(c: Column, default: int | None) -> Column:
    return F.coalesce(int_or_null(c), F.lit(default))


def first_present(*c: Column) -> Column:
    return F.coalesce(*c)


def clamp(c: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(c, F.lit(high)))


def style_distance(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Weighted difference of font_size, size_ratio, left_indent, bold, italic and font_id; null parts don't count; none comparable: 9999."""
    total, compared = F.lit(0.0), F.lit(False)
    for k, w in (("font_size", 1.0), ("size_ratio", 8.0), ("left_indent", 0.08)):
        gap = F.abs(a[k].cast("double") - b[k].cast("double")) * w
        total, compared = total + F.coalesce(gap, F.lit(0.0)), compared | gap.isNotNull()
    for k, w in (("bold", 2.0), ("italic", 1.0), ("font_id", 1.0)):
        differs = a[k].cast("string") != b[k].cast("string")
        total, compared = total + F.when(differs, F.lit(w)).otherwise(0.0), compared | differs.isNotNull()
    return F.when(compared, total).otherwise(F.lit(9999.0))


def rule_distance(s: Column, r: Column, x: Column, rule_s: Column, rule_r: Column, x_min: Column, x_max: Column) -> Column:
    """Distance of a line's style from a learned rule's, for equal bold, italic and font; null beyond the rule's reach."""
    near = (F.abs(s - rule_s) <= 0.02) & (F.abs(r - rule_r) <= 0.02)
    return F.when(near, F.abs(s - rule_s) + 0.2 * F.abs(r - rule_r) + 0.002 * F.abs(x - (x_min + x_max) / 2))


def title_line_score(title: Column, line: Column, font: Column, ratio: Column, y: Column) -> Column:
    """How well a layout line stands for a title: text agreement, then style; null if it doesn't."""
    keys = F.struct(match_key(title).alias("t"), match_key(line).alias("w"), is_toc_listing(line).alias("listing"))
    return let(keys, lambda v: title_key_score(v["t"], v["w"], v["listing"], font, ratio, y))


def title_key_score(t: Column, w: Column, listing: Column, font: Column, ratio: Column, y: Column) -> Column:
    """title_line_score of the match keys of a title and a line; listing: whether the line is one of a table of contents."""
    lt, lw = F.char_length(t), F.char_length(w)
    inside = t.contains(w) | w.contains(t)
    size, scale = F.coalesce(font, F.lit(0.0)), F.coalesce(F.nullif(ratio, F.lit(0.0)), F.lit(1.0))

    def score(cover: Column) -> Column:
        total = (
            F.when(t == w, 300.0).otherwise(45.0) + size * 3 + scale * 20 + cover * 200
            - F.when(listing, 180.0).otherwise(0.0)
            - F.when(is_running_header_footer(y, font, ratio), 80.0).otherwise(0.0)
            - F.when((size <= 10.5) & (scale <= 1.05), 20.0).otherwise(0.0)
            - F.when((t != w) & (cover < 0.5), 100.0).otherwise(0.0)
            - F.when(lw < F.greatest(F.lit(4), F.floor(lt * 0.25)), 25.0).otherwise(0.0)
        )
        return F.when((lt > 0) & (lw > 0) & (cover >= 0.25), total)

    return let(F.when(t == w, 1.0).when(inside, F.least(lt, lw) / F.greatest(lt, lw)), score)


def heading_style_score(font: Column, ratio: Column, bold: Column, italic: Column, known_style: Column) -> Column:
    scale = F.coalesce(F.nullif(ratio, F.lit(0.0)), F.lit(1.0))
    add = lambda c, v: F.when(c, v).otherwise(0.0)
    return F.greatest(F.lit(0.0), scale - 1) * 5 + add(bold > 0, 1.4) + add(italic > 0, 0.5) + add(known_style, 2.0) + add(F.coalesce(font, F.lit(0.0)) >= 14, 0.5)


def reference_match_score(wanted: Column, actual: Column) -> Column:
    """4 equal, 3 contained, 2 or 1 for suffixes, else 0; both by norm."""
    return (
        F.when(wanted == actual, 4).when(actual.contains(wanted), 3)
        .when(wanted.endswith(actual) & (F.char_length(actual) >= 4), 2)
        .when(actual.endswith(wanted) & (F.char_length(wanted) >= 4), 1).otherwise(0)
    )


def estimated_tokens(text: Column) -> Column:
    n = F.char_length(F.coalesce(text, F.lit("")))
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(n / 2.2).cast("int")))


def useful_char_ratio(c: Column) -> Column:
    """Share of letters, digits, Hangul, Han and plain punctuation among the characters that aren't white space."""
    return let(F.replace(clean_text(c), F.lit(" "), F.lit("")), useful_share)


#: What is useful, as characters and as ranges.
USEFUL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.,:;!?()[]{}+-/%·ㆍ"
USELESS = r"[^\x{AC00}-\x{D7A3}\x{4E00}-\x{9FFF}\x{3130}-\x{318F}\x{1100}-\x{11FF}]+"


def useful_share(t: Column) -> Column:
    """useful_char_ratio of compact text: ranges are asked for what the table of characters leaves."""
    n = F.char_length(t)
    useful = let(F.translate(t, USEFUL, ""), lambda rest: n - F.char_length(rest) + F.char_length(F.regexp_replace(rest, USELESS, "")))
    return F.when(n > 0, useful / n).otherwise(0.0)


def usage_total(total: Column) -> Column:
    return F.coalesce(total.try_cast("long"), F.lit(0).cast("long"))
