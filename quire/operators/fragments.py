"""Headings that the page breaks apart, put together again; and the levels that numbers and neighbours give them.

Lines are rows (doc_id, page, line_index, text, s, b, i, x0, y0, x1, y1, page_width); chapters rows (doc_id, pos, level, chapter).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbering import label_kind, number_info, prefix_info
from ..functions.predicates import (
    PARTICLES, heading_facts, is_bad_heading, is_bad_metadata_title, is_caption, is_formula_or_corrupt, is_front_back_title, is_label_only, is_page_marker,
    is_reference_heading, merges_after_number, merges_after_plain,
)
from ..functions.text import clean_text, compact_text, norm_key, settled
from .folds import appended

PAGE = ["doc_id", "page"]
ORDER = ["y0", "x0", "line_index"]


def _with_names(lines: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """lines with columns that are computed once, whatever is made of them."""
    return settled(lines, columns)


def merge_number_lines(lines: DataFrame) -> DataFrame:
    """A line that is a number alone joins the next line of its page, if that is near and no number itself; other such lines go.

    Of three numbers in a row that could each join the next, the first joins the second: places in a run of such
    lines tell which, so windows do.
    """
    by = Window.partitionBy(*PAGE).orderBy(*ORDER)
    own = _with_names(lines, {
        "_number": prefix_info(F.col("text"))["number_text"],
        "_open": number_info(F.col("text"))["style"].isNull() & ~is_front_back_title(F.col("text")) & ~is_page_marker(F.col("text")) & ~is_reference_heading(F.col("text")) & ~is_formula_or_corrupt(F.col("text")),
    })
    near = F.greatest(F.lit(0.0), F.lead("y0").over(by) - F.col("y1")) <= F.greatest(F.col("s") * 3, F.lit(60.0))
    own = own.withColumns({"_place": F.row_number().over(by), "_joins": F.coalesce(F.col("_number").isNotNull() & F.lead("_open").over(by) & near, F.lit(False))})
    run = Window.partitionBy(*PAGE, "_run", "_joins").orderBy("_place")
    own = own.withColumn("_run", F.col("_place") - F.sum(F.col("_joins").cast("int")).over(by))
    own = own.withColumn("_first", F.col("_joins") & (F.row_number().over(run) % 2 == 1))
    own = own.withColumn("_taken", F.coalesce(F.lag("_first").over(by), F.lit(False)))
    nxt = lambda c: F.lead(c).over(by)
    merged = {
        "line_index": nxt("line_index"), "text": F.concat("_number", F.lit(" "), clean_text(nxt("text"))), "s": F.greatest("s", nxt("s")), "b": F.greatest("b", nxt("b")), "i": F.greatest("i", nxt("i")),
        "x0": F.least("x0", nxt("x0")), "y0": F.least("y0", nxt("y0")), "x1": F.greatest("x1", nxt("x1")), "y1": F.greatest("y1", nxt("y1")),
    }
    out = own.select(*[F.when(F.col("_first"), merged[c]).otherwise(F.col(c)).alias(c) if c in merged else F.col(c) for c in lines.columns], "_first", "_taken", F.col("_number").isNull().alias("_plain"))
    return out.where("_first or (_plain and not _taken)").drop("_first", "_taken", "_plain")


def merge_decimal_lines(lines: DataFrame) -> DataFrame:
    """A long line with a decimal number takes the short title just before it as its text; that line goes."""
    by = Window.partitionBy(*PAGE).orderBy(*ORDER)
    n = number_info(F.col("text"))
    own = _with_names(lines, {"_style": F.coalesce(n["style"], F.lit("")), "_number": n["number_text"], "_size": F.char_length(compact_text("text")), "_bad": is_bad_heading(F.col("text"))})
    was = lambda c: F.lag(c).over(by)
    title = (was("_style") == "") & ~was("_bad") & (was("_size") <= 20) & (clean_text(was("text")) != "")
    near = (F.greatest(F.lit(0.0), F.col("y0") - was("y1")) <= F.greatest(F.col("s") * 2, F.lit(40.0))) & (F.abs(F.col("x0") - was("x0")) <= F.col("page_width") * 0.2)
    own = own.withColumn("_takes", F.coalesce(F.col("_style").startswith("arabic_decimal_") & (F.col("_size") > 40) & title & near, F.lit(False)))
    own = own.withColumn("_goes", F.coalesce(F.lead("_takes").over(by), F.lit(False)))
    merged = {
        "text": F.concat("_number", F.lit(" "), clean_text(was("text"))), "s": F.greatest("s", was("s")), "b": F.greatest("b", was("b")), "x0": F.least("x0", was("x0")), "y0": F.least("y0", was("y0")),
        "x1": F.greatest("x1", was("x1")), "y1": F.greatest("y1", was("y1")),
    }
    out = own.select(*[F.when(F.col("_takes"), merged[c]).otherwise(F.col(c)).alias(c) if c in merged else F.col(c) for c in lines.columns], "_goes")
    return out.where("not _goes").drop("_goes")


def join_parts(parts: Column) -> Column:
    """Parts of a heading as one text: no space between a digit and Hangul or Han, nor after a particle."""

    def add(out: Column, part: Column) -> Column:
        glued = compact_text(out).rlike(r"\p{Nd}$") & compact_text(part).rlike(r"^[\x{AC00}-\x{D7A3}\x{3130}-\x{318F}\x{1100}-\x{11FF}\x{4E00}-\x{9FFF}]")
        ends = out.rlike(f"(?:{'|'.join(PARTICLES)})$")
        return F.when(part == "", out).when(glued, F.concat(out, compact_text(part))).when(ends, F.concat(out, part)).otherwise(F.concat(out, F.lit(" "), part))

    cleaned = F.transform(parts, clean_text)
    return clean_text(F.aggregate(F.slice(cleaned, F.lit(2), F.greatest(F.size(cleaned) - 1, F.lit(0))), F.coalesce(F.try_element_at(cleaned, F.lit(1)), F.lit("")), add))


def merge_labels(candidates: DataFrame) -> DataFrame:
    """Labels, numbers and cut titles (doc_id, page, pos, text, s, score, y0, y1) with the one line, or two after a part's label, that go on with them.

    How many lines each would take is a matter of windows; that a line is taken once is a fold over these counts.
    """
    by = Window.partitionBy("doc_id").orderBy("pos")
    own = _with_names(candidates, {"_f": heading_facts(F.col("text")), "_kind": label_kind(F.col("text"))})
    kind, goes_on = F.col("_kind"), merges_after_number(F.col("text")) | merges_after_plain(F.col("text"))
    own = _with_names(own, {
        "_most": F.when(kind.isin("편", "부"), 2).when(kind.isNotNull() | goes_on, 1).otherwise(0),
        "_follows": ~F.col("_f.bad") & ~is_label_only(F.col("text")) & F.col("_f.number.style").isNull(),
    }).drop("_f", "_kind")
    limit = F.greatest(F.col("s") * 3, F.lit(60.0))

    def fits(k: int) -> Column:
        at = lambda c: F.lead(c, k).over(by)
        before = F.col("y1") if k == 1 else F.lead("y1", k - 1).over(by)
        return F.coalesce((at("page") == F.col("page")) & (at("y0") >= F.col("y0")) & at("_follows") & (at("y0") - before <= limit), F.lit(False))

    own = own.withColumns({"_one": (F.col("_most") >= 1) & fits(1), "_two": (F.col("_most") >= 2) & fits(1) & fits(2)})
    own = own.withColumn("_takes", F.when(F.col("_two"), 2).when(F.col("_one"), 1).otherwise(0))
    part = lambda c: F.array(F.col(c), F.lead(c, 1).over(by), F.lead(c, 2).over(by))
    most = lambda c: F.when(F.col("_takes") == 2, F.greatest(c, F.lead(c, 1).over(by), F.lead(c, 2).over(by))).when(F.col("_takes") == 1, F.greatest(c, F.lead(c, 1).over(by))).otherwise(F.col(c))
    own = own.withColumns({"_text": F.when(F.col("_takes") > 0, join_parts(F.slice(part("text"), F.lit(1), F.col("_takes") + 1))).otherwise(F.col("text")), "_s": most("s"), "_score": most("score")})

    def start():
        skip = 0

        def step(takes):  # whether no row before takes this one
            nonlocal skip
            keep = skip == 0
            skip = takes if keep else skip - 1
            return (keep,)

        return step

    taken = appended(own, ["doc_id"], ["pos"], ["_takes"], start, "_keep boolean").where("_keep")
    new = {"text": F.col("_text"), "s": F.col("_s"), "score": F.col("_score")}
    return taken.select(*[new.get(c, F.col(c)).alias(c) for c in candidates.columns])


# --- levels -------------------------------------------------------------------------------------


def _facts(chapters: DataFrame) -> DataFrame:
    """chapters with what their numbers say, once for all steps: style and level of the number, and whether it is vetoed."""
    own = settled(chapters, {"_f": heading_facts(F.col("chapter"))})
    own = own.select(*[F.col("_f.clean").alias(c) if c == "chapter" else F.col(c) for c in chapters.columns], F.coalesce("_f.number.style", F.lit("")).alias("_style"), F.col("_f.number.level").alias("_number_level"), (F.col("_f.bad") | F.col("_f.lone")).alias("_veto"))
    return own


def _fixed(max_depth: int) -> Column:
    return F.when(F.col("_number_level").isNotNull() & ~F.col("_style").isin("bare_number", "arabic_paren"), F.greatest(F.lit(1), F.least("_number_level", F.lit(max_depth))))


def _clamped(max_depth: int) -> Column:
    return F.greatest(F.lit(1), F.least("level", F.lit(max_depth)))


def _enforce(own: DataFrame, max_depth: int) -> DataFrame:
    return own.withColumn("level", F.coalesce(_fixed(max_depth), _clamped(max_depth)).cast("int"))


def _limit(own: DataFrame, max_depth: int) -> DataFrame:
    bracket = F.col("_style").isin("arabic_paren", "arabic_paren_wrap")
    names = own.columns
    own = _with_names(own, {"_given": F.when(bracket, _clamped(max_depth)).otherwise(_fixed(max_depth)), "_level": _clamped(max_depth)})
    by = Window.partitionBy("doc_id").orderBy("pos")
    own = own.withColumns({"_stretch": F.sum(F.col("_given").isNotNull().cast("int")).over(by), "_at": F.row_number().over(by)})
    within = Window.partitionBy("doc_id", "_stretch").orderBy("_at")
    least = F.min(F.coalesce("_given", "_level") - F.col("_at")).over(within) + F.col("_at")
    return own.withColumn("level", F.coalesce("_given", least).cast("int")).select(*names)


def enforce_number_levels(chapters: DataFrame, max_depth: int = 6) -> DataFrame:
    """Levels that the number's shape decides; others within depth."""
    return _enforce(_facts(chapters), max_depth).select(*chapters.columns)


def limit_jumps(chapters: DataFrame, max_depth: int = 6) -> DataFrame:
    """Levels at most one deeper than the row before, but for those that a number decides or that have a bracket.

    The recurrence has a closed form: within a stretch of free rows after a row with a given level, a level is
    the least of (own level - place) and the start's over the stretch, plus the place.
    """
    return _limit(_facts(chapters), max_depth).select(*chapters.columns)


def contextual_levels(chapters: DataFrame, max_depth: int = 6) -> DataFrame:
    """Levels from the numbers' shapes and from what came before: brackets below decimals, plain titles below numbered ones. A fold per document."""
    return _contextual(_facts(chapters), max_depth).select(*chapters.columns)


def _contextual(own: DataFrame, max_depth: int) -> DataFrame:
    deep = lambda k: min(int(k), max_depth)

    def start():
        below, before, last = False, "", 0

        def step(style, fixed, level):
            nonlocal below, before, last
            level = max(1, deep(level))
            if style in ("ko_part", "ko_chapter", "ko_section", "arabic_dot"):
                level, below = {"ko_part": 1, "ko_chapter": 2}.get(style, 3), False
            elif style.startswith("arabic_decimal_"):
                level, below = max(4, deep(fixed)), True
            elif style == "arabic_paren_wrap":
                level = 6 if max_depth >= 6 and (below or before == "arabic_paren" and last == 5) else deep(5)
            elif style == "arabic_paren":
                level = 5 if below and max_depth >= 5 else deep(4)
            elif last in (3, 4) and level <= last:
                level, below = 4, True
            else:
                below = level >= 4
            before, last = style, max(1, deep(level))
            return (last,)

        return step

    found = appended(own, ["doc_id"], ["pos"], ["_style", "_number_level", "level"], start, "_new int")
    return found.select(*[F.col("_new").alias(c) if c == "level" else F.col(c) for c in own.columns])


def finish(chapters: DataFrame, max_depth: int = 6) -> DataFrame:
    """Chapters as they are put out: without vetoed ones, levels by number, then limited, by context, and limited again."""
    own = _limit(_enforce(_facts(chapters).where("not _veto"), max_depth), max_depth)
    return _limit(_contextual(own, max_depth), max_depth).select(*chapters.columns)


def validate_strict(toc: DataFrame) -> DataFrame:
    """Entries (level and page as text) without vetoed ones and those without whole numbers, finished at depth 6."""
    t = toc.withColumns({"chapter": clean_text("chapter"), "level": F.coalesce("level", F.lit("1")).try_cast("int"), "page": F.coalesce("page", F.lit("1")).try_cast("int")})
    t = t.where("chapter <> '' and level is not null and page is not null")
    return finish(t.withColumns({"level": F.greatest("level", F.lit(1)), "page": F.greatest("page", F.lit(1))}), 6)


def size_clusters(candidates: DataFrame, tolerance: float = 0.6, most: int = 5) -> DataFrame:
    """(doc_id, clusters): centres of the distinct sizes s, from the largest down; a size joins the last cluster if it is within tolerance of its mean."""
    sizes = F.sort_array(F.collect_set(F.bround(F.when(F.col("s") > 0, F.col("s")), 1)), asc=False)

    def add(out: Column, size: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        mean = F.aggregate(last, F.lit(0.0), lambda a, x: a + x) / F.size(last)
        joined = F.concat(F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.concat(last, F.array(size))))
        return F.when((F.size(out) > 0) & (F.abs(size - mean) <= tolerance), joined).otherwise(F.concat(out, F.array(F.array(size))))

    clusters = F.aggregate("sizes", F.array().cast("array<array<double>>"), add)
    mean = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x) / F.size(c), 1)
    return candidates.groupBy("doc_id").agg(sizes.alias("sizes")).select("doc_id", F.transform(F.slice(clusters, 1, most), mean).alias("clusters"))


def font_level(size: Column, clusters: Column, max_depth: int) -> Column:
    """Place of the nearest of the clusters' centres, the first of equal ones, within depth; 1 without any."""
    near = F.array_min(F.transform(clusters, lambda c, i: F.struct(F.abs(size - c).alias("d"), (i + 1).alias("n"))))["n"]
    return F.least(F.coalesce(near, F.lit(1)), F.lit(max_depth))


def build_chapters(candidates: DataFrame, titles: DataFrame, body: DataFrame, max_depth: int = 4) -> DataFrame:
    """Chapters of candidates (of merge_labels): titles (doc_id, title), body (doc_id, body_size). Levels by number, else by type size."""
    merged = merge_labels(candidates).join(body, "doc_id").join(titles, "doc_id", "left")
    clusters = size_clusters(merged.where("s >= body_size + 0.8"), most=max_depth)
    own = _with_names(_with_names(merged.withColumnRenamed("text", "_was"), {"text": clean_text("_was")}), {"_key": norm_key("text"), "_f": heading_facts(F.col("text"))})
    own = own.withColumns({"_bad": F.col("_f.bad") | F.col("_f.lone"), "_numbered": F.col("_f.numbered"), "_by_number": F.col("_f.numbered_level")}).drop("_f")
    own = own.where("not _bad").where(~((F.col("page") == 1) & (F.col("_key") == norm_key("title")) & ~F.col("_numbered")))
    first = Window.partitionBy("doc_id", "_key", "page").orderBy("pos")
    own = own.withColumn("_n", F.row_number().over(first)).where("_n = 1").join(clusters, "doc_id", "left")
    level = F.coalesce("_by_number", font_level(F.col("s"), F.coalesce("clusters", F.array().cast("array<double>")), max_depth))
    chapters = own.select("doc_id", "pos", F.greatest(F.lit(1), F.least(level, F.lit(max_depth))).cast("int").alias("level"), F.col("text").alias("chapter"), "page")
    return finish(chapters, max_depth)


def infer_titles(documents: DataFrame, candidates: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, title) of documents (doc_id, metadata_title, stem, body_size): the metadata's if it is good, else the first page's
    best candidate, else its best line, if they stand out, else the stem. candidates have score; both have s, b, y0, rel_y0."""
    first = lines.groupBy("doc_id").agg(F.min("page").alias("page"))

    def best(rows: DataFrame, least: int, *by: Column) -> DataFrame:
        n = F.char_length("text")
        fine = (F.col("rel_y0") < 0.7) & n.between(least, 120) & ~is_bad_heading(F.col("text"))
        pick = F.max_by(F.struct("text", "s", "b"), F.struct(*by, -F.col("y0"), -F.col("line_index")))
        return rows.join(first, PAGE, "left_semi").where(fine).groupBy("doc_id").agg(pick.alias("m"))

    c = best(candidates.where(~is_caption(F.col("text"))), 0, F.col("s"), F.col("score")).select("doc_id", F.col("m").alias("c"))
    ln = best(lines, 3, F.col("s"), F.col("b")).select("doc_id", F.col("m").alias("l"))
    j = documents.join(c, "doc_id", "left").join(ln, "doc_id", "left")
    stands = lambda m: F.when((F.col(f"{m}.s") >= F.col("body_size") + 1.2) | (F.col(f"{m}.b") > 0), F.col(f"{m}.text"))
    own = F.when((clean_text("metadata_title") != "") & ~is_bad_metadata_title(F.col("metadata_title"), F.col("stem")), F.col("metadata_title"))
    return j.select("doc_id", F.coalesce(own, stands("c"), stands("l"), "stem").alias("title"))
