"""Tables of contents as rows: doc_id, pos, level, chapter, page and layout columns. Validation, merges, diffs, corrections, hierarchy."""

from __future__ import annotations

from statistics import median

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbering import decimal_path
from ..functions.numbers import clamp, int_or, title_line_score
from ..functions.predicates import has_heading_marker, has_structural_marker, is_generic_title, is_marker_only, is_repeated_running_title, is_running_header_footer, is_toc_listing
from ..functions.text import clean_text, duplicate_title_key, match_key, norm, settled, short_title
from .folds import appended, folded


def validate(toc: DataFrame, max_depth: int = 6) -> DataFrame:
    """Clean titles (empty ones go), levels within depth, pages from 1, bad values 1; the first of each (title key, page) stays."""
    names = toc.columns
    t = settled(toc.withColumnRenamed("chapter", "_was"), {"chapter": clean_text("_was")}).select(*names).withColumns({
        "level": clamp(int_or(F.col("level"), 1), 1, max_depth), "page": F.greatest(F.lit(1), int_or(F.col("page"), 1)),
    }).where("chapter <> ''")
    w = Window.partitionBy("doc_id", F.lower(F.replace("chapter", F.lit(" "), F.lit(""))), "page").orderBy("pos")
    return t.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merge_partials(partials: DataFrame) -> DataFrame:
    """Union of partial tables (column chunk): the first of each page and title, renumbered in order of page, chunk and pos."""
    w = Window.partitionBy("doc_id", "page", norm("chapter")).orderBy("chunk", "pos")
    kept = partials.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return kept.withColumn("merged_pos", F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "chunk", "pos")) - 1)


def diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Full outer join on (doc_id, title key, page), last duplicate winning: status added, removed, level_changed or same."""

    def last(t: DataFrame, name: str) -> DataFrame:
        return t.groupBy("doc_id", match_key("chapter").alias("title_key"), "page").agg(F.max_by("level", "pos").alias(name))

    j = last(before, "level_before").join(last(after, "level_after"), ["doc_id", "title_key", "page"], "full")
    status = F.when(F.col("level_before").isNull(), "added").when(F.col("level_after").isNull(), "removed").when(F.col("level_before") != F.col("level_after"), "level_changed").otherwise("same")
    return j.withColumn("status", status)


def _styled(toc: DataFrame) -> DataFrame:
    """toc with its style key and whether a row tells of its style's level: an unmarked title that occurs once, whose line stands for it and is neither a listing nor a running head."""
    layout = title_line_score(F.col("chapter"), F.col("layout_text"), F.col("font_size"), F.col("size_ratio"), F.col("y")).isNotNull()
    fine = layout & ~is_toc_listing(F.col("layout_text")) & ~is_running_header_footer(F.col("y"), F.col("font_size"), F.col("size_ratio"))
    t = settled(toc, {"_chapter": match_key("chapter"), "_fine": fine, "_marked": has_structural_marker(F.col("chapter")) | (clean_text("chapter") == "")})
    t = t.withColumns({"_font": F.bround("font_size", 1), "_ratio": F.bround("size_ratio", 2), "_once": F.count("*").over(Window.partitionBy("doc_id", "_chapter")) == 1}).drop("_chapter")
    return t.withColumn("_tells", F.col("_once") & ~F.col("_marked") & F.col("_fine") & (F.col("_font").isNotNull() | F.col("_ratio").isNotNull()))


def _dominant(styled: DataFrame, least: int, share: float) -> DataFrame:
    n = styled.groupBy("doc_id", "_font", "_ratio", "level").agg(F.count("*").alias("n"))
    best = n.groupBy("doc_id", "_font", "_ratio").agg(F.sum("n").alias("total"), F.max_by(F.struct("level", "n"), F.struct("n", -F.col("level"))).alias("best"))
    return best.where((F.col("total") >= least) & (F.col("best.n") >= share * F.col("total"))).select("doc_id", "_font", "_ratio", F.col("best.level").alias("dominant_level"), "total")


def dominant_levels(toc: DataFrame, least: int = 4, share: float = 0.7) -> DataFrame:
    """(doc_id, font_size, size_ratio, dominant_level, total): the level that a style mostly has; ties go to the lower level."""
    return _dominant(_styled(toc).where("_tells"), least, share).withColumnsRenamed({"_font": "font_size", "_ratio": "size_ratio"})


def correct_levels(toc: DataFrame, least: int = 4, share: float = 0.7, *, document_wide: bool = False) -> DataFrame:
    """Unmarked titles that occur once take the dominant level of their style; corrected tells which changed.

    document_wide: all rows with a sound layout tell of their style's level, marked and repeated ones too, and only such rows change.
    """
    t = _styled(toc)
    tells = F.col("_fine") & (F.col("_font").isNotNull() | F.col("_ratio").isNotNull()) if document_wide else F.col("_tells")
    d = _dominant(t.where(tells), least, share).select(*[F.col(c).alias(f"d{c}") for c in ("doc_id", "_font", "_ratio")], "dominant_level")
    j = t.join(d, (F.col("doc_id") == F.col("ddoc_id")) & F.col("_font").eqNullSafe(F.col("d_font")) & F.col("_ratio").eqNullSafe(F.col("d_ratio")), "left")
    use = F.col("dominant_level").isNotNull() & ~F.col("_marked") & F.col("_once") & (F.col("_fine") if document_wide else F.lit(True))
    new = F.when(use, F.col("dominant_level")).otherwise(F.col("level"))
    return j.select(*[new.alias("level") if c == "level" else F.col(c) for c in toc.columns], (new != F.col("level")).alias("corrected"))


def style_outliers(toc: DataFrame) -> DataFrame:
    """toc with the medians of its level's styles and whether a row is off them: much smaller, body text among titles, or as large as a cover's."""
    w = Window.partitionBy("doc_id", "level")
    both = F.col("font_size").isNotNull() & F.col("size_ratio").isNotNull()
    median = lambda c: F.percentile(F.when(both, F.col(c)), 0.5).over(w)
    t = toc.withColumns({"median_font": median("font_size"), "median_ratio": median("size_ratio"), "styled": F.count(F.when(both, 1)).over(w)})
    font, ratio, mf, mr = (F.col(c) for c in ("font_size", "size_ratio", "median_font", "median_ratio"))
    smaller = (mf >= 12.0) & (font < mf * 0.7) & (mr >= 1.25) & (ratio < mr * 0.75)
    body = (mr >= 1.5) & (ratio <= 1.12) & (font < mf * 0.9)
    cover = (mf >= 8.0) & (mr >= 0.8) & (font > mf * 1.8) & (ratio > mr * 1.8)
    return t.withColumn("outlier", F.coalesce(both & (smaller | body | cover), F.lit(False)))


def reference_examples(toc: DataFrame, most: int = 5) -> DataFrame:
    """Up to `most` rows of each level without style outliers (where at least 3 have a style and not all are outliers), in order; rank is their place."""
    t = style_outliers(toc)
    w = Window.partitionBy("doc_id", "level")
    drops = (F.col("styled") >= 3) & ~F.col("_all")
    t = t.withColumn("_all", F.bool_and("outlier").over(w)).where(~(drops & F.col("outlier")))
    return t.withColumn("rank", F.row_number().over(w.orderBy("pos"))).where(F.col("rank") <= most).select(*toc.columns, "rank")


def level_references(toc: DataFrame, max_depth: int = 6, most: int = 5) -> DataFrame:
    """The running examples of each level (doc_id, level, rank, title, font_size, size_ratio, x, bold, italic) after all rows of toc (in order of pos, chunk after chunk).

    A row adds its style unless its title is there already; then outliers go and the first `most` stay, as after each row: a fold per level,
    which holds one row more than stay.
    """
    style = ["font_size", "size_ratio", "x", "bold", "italic"]
    t = toc.where(F.col("level").between(1, max_depth)).select("doc_id", "level", "pos", short_title("chapter").alias("title"), *style).where("title <> ''")
    t = t.select("doc_id", "level", "pos", "title", match_key("title").alias("_key"), *style)

    def outlier(f: float | None, r: float | None, mf: float, mr: float) -> bool:
        if f is None or r is None:
            return False
        return mf >= 12 and f < mf * 0.7 and mr >= 1.25 and r < mr * 0.75 or mr >= 1.5 and r <= 1.12 and f < mf * 0.9 or mf >= 8 and mr >= 0.8 and f > mf * 1.8 and r > mr * 1.8

    def fold(rows):
        held: list[tuple] = []
        for e in rows:
            if any(h[4] == e[4] for h in held):
                continue
            held.append(e)
            styled = [h for h in held if h[5] is not None and h[6] is not None]
            if len(styled) >= 3:
                mf, mr = (median(h[c] for h in styled) for c in (5, 6))
                held = [h for h in held if not outlier(h[5], h[6], mf, mr)] or held
            held = held[:most]
        return [(h[0], h[1], k, h[3], *h[5:]) for k, h in enumerate(held, 1)]

    return folded(t, ["doc_id", "level"], ["pos"], fold, "doc_id long, level int, rank int, title string, font_size double, size_ratio double, x double, bold int, italic int")


def numbering_gaps(toc: DataFrame) -> DataFrame:
    """Gaps between consecutive siblings as ranges: doc_id, prefix, first and last missing number, before and after; the last of equal numbers counts."""
    path = decimal_path(F.col("chapter"))
    t = toc.select("doc_id", "pos", short_title("chapter", 70).alias("title"), path.alias("path")).where("path is not null and size(path) >= 2")
    t = t.select("doc_id", "pos", "title", F.slice("path", 1, F.size("path") - 1).alias("prefix"), F.element_at("path", -1).alias("n"))
    t = t.groupBy("doc_id", "prefix", "n").agg(F.max_by("title", "pos").alias("title"))
    w = Window.partitionBy("doc_id", "prefix").orderBy("n")
    t = t.withColumns({"next": F.lead("n").over(w), "after": F.lead("title").over(w)}).where("next > n + 1")
    text = F.array_join(F.transform("prefix", lambda x: x.cast("string")), ".").alias("prefix")
    return t.select("doc_id", text, (F.col("n") + 1).alias("first"), (F.col("next") - 1).alias("last"), F.col("title").alias("before"), "after")


def missing_numbers(gaps: DataFrame, most: int = 20) -> DataFrame:
    """The first `most` missing numbers of each document, in order of prefix and number: doc_id, number, before, after."""
    path = F.transform(F.split("prefix", r"\."), lambda x: x.cast("int"))
    w = Window.partitionBy("doc_id").orderBy("_path", "first")
    size = F.col("last") - F.col("first") + 1
    g = gaps.withColumn("_path", path).withColumn("_before", F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where(F.col("_before") < most)
    n = F.explode(F.sequence(F.col("first").cast("long"), F.least(F.col("last").cast("long"), F.col("first") + most - F.col("_before") - 1)))
    return g.select("doc_id", "prefix", n.alias("n"), "before", "after").select("doc_id", F.concat_ws(".", "prefix", F.col("n").cast("string")).alias("number"), "before", "after")


def _keep_key(toc: DataFrame) -> DataFrame:
    """toc with _key (the duplicate title), _run (whether it looks like a running head) and _keep: of equal titles the least is kept.

    A page or place of 0 counts as missing.
    """
    none0 = lambda *c: F.coalesce(*[F.nullif(F.col(x), F.lit(0)) for x in c], F.lit(999_999))
    t = settled(toc, {"_key": duplicate_title_key("chapter"), "_run": is_repeated_running_title(F.col("chapter"), F.col("y"), F.col("font_size"), F.col("size_ratio"), F.col("bold"), F.col("italic")), "_page": none0("page")})
    keep = F.struct("_run", -F.coalesce("font_size", F.lit(0.0)), -F.coalesce("size_ratio", F.lit(0.0)), "_page", none0("source_order", "merge_order"), "pos")
    return t.withColumns({"_keep": keep, "_at": F.struct("_page", F.coalesce(F.nullif("source_order", F.lit(0)), "pos"), "pos")})


def duplicates(toc: DataFrame) -> DataFrame:
    """toc without repeated running heads (two or more of a title) and, of titles that are marks alone, all but the best one."""
    t = _keep_key(toc)
    w = Window.partitionBy("doc_id", "_key")
    t = t.withColumns({"_rows": F.count("*").over(w), "_runs": F.sum(F.col("_run").cast("int")).over(w), "_mark": F.bool_or(is_marker_only(F.col("chapter"))).over(w), "_n": F.row_number().over(w.orderBy("_keep"))})
    many = (F.col("_rows") >= 2) & (F.col("_key") != "")
    gone = many & ((F.col("_run") & (F.col("_runs") >= 2)) | (F.col("_mark") & (F.col("_n") > 1)))
    return t.where(~gone).select(*toc.columns)


def near_page_duplicates(toc: DataFrame) -> DataFrame:
    """Greedy, in order of page: of rows with one title and level on pages at most 1 apart the better one stays. A fold per document and title."""
    t = _keep_key(toc).select("doc_id", "pos", "level", "page", "_key", F.struct("_keep", "_at").alias("_k"))
    by = Window.partitionBy("doc_id", "_key")
    t = t.withColumns({"_rank": F.row_number().over(by.orderBy("_k._keep")), "_order": F.row_number().over(by.orderBy("_k._at")), "_rows": F.count("*").over(by)})
    once = t.where("_rows = 1 or _key = ''").select("doc_id", "pos")

    def fold(rows):
        kept: dict[tuple, list] = {}  # by level and page, with the place among the kept
        out: dict[int, tuple] = {}
        for n, (doc, _, pos, level, page, rank, _) in enumerate(rows):
            if level is None or page is None:
                out[n] = doc, pos
                continue
            twin = min((k for p in (page - 1, page, page + 1) for k in kept.get((level, p), [])), default=None)
            if twin is not None:
                if rank >= twin[1]:
                    continue
                kept[level, twin[2]].remove(twin)
                del out[twin[0]]
            kept.setdefault((level, page), []).append((n, rank, page))
            out[n] = doc, pos
        return out.values()

    several = t.where("_rows > 1 and _key <> ''").select("doc_id", "_key", "pos", "level", "page", "_rank", "_order")
    stays = folded(several, ["doc_id", "_key"], ["_order"], fold, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in once.schema))
    return toc.join(once.unionByName(stays), ["doc_id", "pos"], "left_semi")


# --- titles and lines ---------------------------------------------------------------------------


def match_lines(titles: DataFrame, lines: DataFrame) -> DataFrame:
    """Titles (doc_id, pos, chapter, page) with the line of their page that stands for them best: tier, then least difference of length, then order."""
    t = settled(titles.select("doc_id", "pos", "chapter", "page"), {"a": norm("chapter")}).where("a <> ''")
    ln = settled(lines.select("doc_id", "page", "source_order", "text"), {"w": norm("text")}).where("w <> ''")
    tier = F.when(F.col("a") == F.col("w"), 5).when(F.col("w").startswith(F.col("a")), 4).when(F.col("w").contains(F.col("a")), 3).when((F.char_length("w") >= 4) & F.col("a").contains(F.col("w")), 2)
    j = t.join(ln, ["doc_id", "page"]).withColumn("tier", tier).where("tier is not null")
    best = F.min_by(F.struct("tier", "source_order", "text"), F.struct(-F.col("tier"), F.abs(F.char_length("a") - F.char_length("w")), "source_order"))
    return j.groupBy("doc_id", "pos", "chapter", "page").agg(best.alias("m")).select("doc_id", "pos", "chapter", "page", F.col("m.tier").alias("tier"), F.col("m.source_order").alias("source_order"), F.col("m.text").alias("line_text"))


# --- hierarchy ---------------------------------------------------------------------------------


def dense_levels(toc: DataFrame) -> DataFrame:
    """dense_level: the rank of a level among those its document uses."""
    return toc.withColumn("dense_level", F.dense_rank().over(Window.partitionBy("doc_id").orderBy("level")))


def level_examples(toc: DataFrame) -> DataFrame:
    """The first heading of each level."""
    w = Window.partitionBy("doc_id", "level").orderBy("page", "pos")
    return toc.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def outline(toc: DataFrame, last_page: Column) -> DataFrame:
    """toc with end_page (the page of the next heading of no deeper level, else last_page), parent_pos (the nearest heading before of a
    smaller level) and path (the open headings' pos, outermost first)."""
    return ancestors(section_ends(toc, last_page))


def ancestors(toc: DataFrame) -> DataFrame:
    """toc with parent_pos and path, as outline has them. One pass with a stack of the open headings."""

    def start():
        stack: list[tuple[int, int]] = []  # level, pos

        def step(doc, level, pos):
            if doc is None or level is None:
                return None, []
            while stack and stack[-1][0] >= level:
                stack.pop()
            path = [p for _, p in stack]
            stack.append((level, pos))
            return path[-1] if path else None, path

        return step

    return appended(toc, ["doc_id"], ["pos"], ["doc_id", "level", "pos"], start, "parent_pos bigint, path array<bigint>")


def section_ends(toc: DataFrame, last_page: Column) -> DataFrame:
    """toc with end_page, as outline has it. One pass from the end, with the next headings of each level that no later one hides."""

    def start():
        stack: list[tuple[int, int]] = []  # level, page

        def step(doc, level, page, last):
            if doc is None or level is None:
                return (last,)
            while stack and stack[-1][0] > level:
                stack.pop()
            end = stack[-1][1] if stack else last
            if stack and stack[-1][0] == level:
                stack.pop()
            stack.append((level, page))
            return (end,)

        return step

    t = toc.withColumn("_last", last_page.cast("long"))
    return appended(t, ["doc_id"], [F.desc("pos")], ["doc_id", "level", "page", "_last"], start, "end_page bigint").drop("_last")


def level_groups(max_level: int, size: int = 3) -> list[tuple[int, int]]:
    """Overlapping ranges of levels: 1 to size, size to 2 size - 1, and so on."""
    out, low = [], 1
    while True:
        out.append((low, min(low + size - 1, max_level)))
        if out[-1][1] >= max_level:
            return out
        low = out[-1][1]


def validate_headings(headings: DataFrame, page_count: Column, max_depth: int = 6) -> DataFrame:
    """Headings (doc_id, text, level, page, order, reason; numbers as text) within depth and pages, each of a page, order and text once, in order,
    their levels dense; pos is the place. Numbers that can't be read drop a row."""
    t = headings.select(
        "doc_id", clean_text("text").alias("text"), clamp(F.coalesce("level", F.lit("1")).try_cast("int"), 1, max_depth).alias("level"),
        F.greatest(F.lit(1), F.least(F.coalesce("page", F.lit("1")).try_cast("int"), page_count)).alias("page"), F.greatest(F.lit(1), F.coalesce("order", F.lit("1")).try_cast("int")).alias("order"),
        clean_text("reason").alias("reason"), *[F.coalesce(c, F.lit("1")).try_cast("int").isNotNull().alias(f"_{c}") for c in ("level", "page", "order")], F.col("pos").alias("_pos"),
    ).where("text <> '' and _level and _page and _order")
    first = Window.partitionBy("doc_id", "page", "order", F.lower("text")).orderBy("_pos")
    t = t.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    by = Window.partitionBy("doc_id")
    t = t.withColumns({"level": F.dense_rank().over(by.orderBy("level")), "pos": F.row_number().over(by.orderBy("page", "order", "_pos"))})
    return t.select("doc_id", "pos", "level", "text", "page", "order", "reason")


def deepest_path(headings: DataFrame) -> DataFrame:
    """Of each document the first heading of the deepest level and the headings above it: doc_id, pos, level, page."""
    deepest = headings.groupBy("doc_id").agg(F.max("level").alias("_deep"))
    target = headings.join(deepest, "doc_id").where("level = _deep").groupBy("doc_id").agg(F.min("pos").alias("_target"))
    before = headings.join(target, "doc_id").where("pos <= _target")
    # An ancestor has a smaller level than all that follow it up to the target.
    after = Window.partitionBy("doc_id").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    return before.withColumn("_least", F.min("level").over(after)).where("_least is null or level < _least").select("doc_id", "pos", "level", "page")


def group_ranges(headings: DataFrame, page_count: Column, size: int = 3) -> DataFrame:
    """Page ranges of a document's groups of levels (level_groups): doc_id, start_level, end_level, start_page, end_page, end_pos.

    A group ends at the first heading of its last level (for later groups, at the one on the deepest path), the last one at the end
    of that path's section; it begins at the heading of its first level that holds its end.
    """
    size = max(2, size)
    path = deepest_path(headings)
    deep = path.groupBy("doc_id").agg(F.max("level").alias("deep"), F.max_by("pos", "pos").alias("target"), F.max_by("page", "pos").alias("target_page"), F.sort_array(F.collect_list(F.struct("pos", "level", "page"))).alias("path"))
    starts = F.when(F.col("deep") == 1, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), F.col("deep") - 1, F.lit(size - 1)))
    groups = deep.select("*", F.explode(starts).alias("start_level")).withColumn("end_level", F.least(F.col("start_level") + size - 1, F.col("deep")))
    first = headings.groupBy("doc_id", F.col("level").alias("end_level")).agg(F.min_by(F.struct("pos", "level", "page"), "pos").alias("first"))
    on_path = F.coalesce(F.try_element_at(F.filter("path", lambda h: h["level"] <= F.col("end_level")), F.lit(-1)), F.element_at("path", 1))
    g = groups.join(first, ["doc_id", "end_level"], "left").withColumn("end", F.when(F.col("start_level") == 1, F.coalesce("first", on_path)).otherwise(on_path))
    h = headings.select("doc_id", F.col("pos").alias("_p"), F.col("level").alias("_l"), F.col("page").alias("_g"))
    j = g.select("doc_id", "start_level", "end_level", "deep", "target", "target_page", F.col("end.pos").alias("end_pos"), F.col("end.page").alias("end_heading_page")).join(h, "doc_id")
    upto = F.col("_p") <= F.col("end_pos")
    same, above = upto & (F.col("_l") == F.col("start_level")), upto & (F.col("_l") <= F.col("start_level"))
    later = (F.col("_p") > F.col("target")) & (F.col("_l") < F.col("deep"))
    keys = ["doc_id", "start_level", "end_level", "deep", "target_page", "end_pos", "end_heading_page"]
    a = j.groupBy(*keys).agg(
        F.max_by(F.when(same, F.col("_g")), F.when(same, F.col("_p"))).alias("s1"), F.max_by(F.when(above, F.col("_g")), F.when(above, F.col("_p"))).alias("s2"), F.min_by("_g", "_p").alias("s3"),
        F.min_by(F.when(later, F.col("_g")), F.when(later, F.col("_p"))).alias("next"),
    )
    start = F.greatest(F.lit(1), F.least(F.coalesce("s1", "s2", "s3"), page_count))
    end = F.when(F.col("end_level") >= F.col("deep"), F.greatest(F.col("target_page"), F.coalesce("next", page_count))).otherwise(F.greatest(F.lit(1), F.least("end_heading_page", page_count)))
    return a.select("doc_id", "start_level", "end_level", start.alias("start_page"), F.greatest(start, F.least(end, page_count)).alias("end_page"), "end_pos")


# --- answers ------------------------------------------------------------------------------------


def promote(answers: DataFrame) -> DataFrame:
    """answers (doc_id, title, fallback, chapters array<map<string, string>>) with the model's title as a first chapter of level 1 where it looks like a heading
    that the chapters lack: with a chapter's mark, or before deeper first chapters; not a generic or very long one."""
    title = clean_text("title")
    fallback = F.coalesce(F.nullif(clean_text("fallback"), F.lit("")), title)
    key = lambda c: F.lower(F.regexp_replace(clean_text(c), r"\s+", ""))
    has = F.exists("chapters", lambda c: key(F.try_element_at(c, F.lit("chapter"))) == key(title))
    first = F.try_element_at(F.filter("chapters", lambda c: clean_text(F.try_element_at(c, F.lit("chapter"))) != ""), F.lit(1))
    level = F.try_element_at(first, F.lit("level")).try_cast("int")
    page = F.greatest(F.lit(1), F.coalesce(F.nullif(F.try_element_at(first, F.lit("page")).try_cast("int"), F.lit(0)), F.lit(1)))
    take = ~is_generic_title(title, fallback) & (F.char_length(title) <= 140) & ~has & (has_heading_marker(title) | F.coalesce(level > 1, F.lit(False)))
    new = F.create_map(F.lit("level"), F.lit("1"), F.lit("chapter"), title, F.lit("page"), page.cast("string"), F.lit("level_reason"), F.lit(PROMOTED))
    return answers.withColumn("chapters", F.when(take, F.concat(F.array(new), F.col("chapters"))).otherwise(F.col("chapters")))


#: The reason of a chapter that was a title.
PROMOTED = "Promoted from model title because output title is forced to the PDF file name."


def answer_rows(answers: DataFrame, max_depth: int = 6) -> DataFrame:
    """The chapters of answers as rows: doc_id, pos, level within depth, chapter, page from 1, level_reason and typed layout columns; what
    can't be read is 1; empty titles go, the first of equal titles on a page stays."""
    from .attach import typed_layout

    t = answers.select("doc_id", F.posexplode("chapters").alias("pos", "raw"))
    get = lambda k: F.try_element_at("raw", F.lit(k))
    t = t.select("doc_id", "pos", get("level").alias("level"), get("chapter").alias("chapter"), get("page").alias("page"), F.nullif(clean_text(get("level_reason")), F.lit("")).alias("level_reason"), *[c.alias(k) for k, c in typed_layout(F.col("raw")).items()])
    return validate(t, max_depth)


def validate_answers(answers: DataFrame, max_depth: int = 6) -> DataFrame:
    """What a model answered, as a table of contents: titles promoted, rows typed, duplicates gone, levels by style. The document's title is its file's."""
    t = answer_rows(promote(answers), max_depth).withColumn("merge_order", F.lit(None).cast("int"))
    return correct_levels(near_page_duplicates(duplicates(t))).drop("corrected", "merge_order")


def validate_simple(answers: DataFrame, max_depth: int = 6) -> DataFrame:
    """The plainer reading: the model's title wins, source_order counts only if positive, and nothing else is changed: doc_id, title, pos, level, chapter, page, source_order, level_reason."""
    title = F.coalesce(F.nullif(clean_text("title"), F.lit("")), F.nullif(clean_text("fallback"), F.lit("")), F.lit("Document title"))
    t = answer_rows(answers, max_depth).withColumn("source_order", F.when(F.col("source_order") > 0, F.col("source_order")))
    return t.join(answers.select("doc_id", title.alias("title")), "doc_id").select("doc_id", "title", "pos", "level", "chapter", "page", "source_order", "level_reason")
