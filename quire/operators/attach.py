"""Layout of table-of-contents entries: found in the source's lines, kept across merges and reviews, and told in words.

Entries are rows (doc_id, pos, level, chapter, page, level_reason) with the LAYOUT columns; lines are rows (doc_id,
page, line_index, source_order, s, r, x, y, b, i, f, text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import style_distance, title_key_score, title_line_score
from ..functions.predicates import has_structural_marker, is_toc_listing, is_visual_caption
from ..functions.text import clean_text, match_key, norm, settled, short_title

#: An entry's layout columns, and the names under which answers and older files have them, the first present one counting.
ALIASES = {
    "x": ("_layout_x", "layout_x", "x", "left_indent"), "y": ("_layout_y", "layout_y", "y", "vertical_position"),
    "font_size": ("_layout_font_size", "layout_font_size", "font_size", "s"), "size_ratio": ("_layout_size_ratio", "layout_size_ratio", "size_ratio", "r"),
    "layout_text": ("_layout_text", "layout_text", "source_text"), "layout_page": ("_layout_page", "layout_page"),
    "bold": ("_layout_bold", "layout_bold", "bold", "b"), "italic": ("_layout_italic", "layout_italic", "italic", "i"), "source_order": ("_source_order", "source_order"),
}
LAYOUT = list(ALIASES)
FLOATS = ("x", "y", "font_size", "size_ratio")
#: The layout column of an entry that a line's column gives.
OF_LINE = {"x": "x", "y": "y", "font_size": "s", "size_ratio": "r", "layout_text": "text", "layout_page": "page", "bold": "b", "italic": "i", "source_order": "line_index"}
#: A layout replaces another one if it stands for the title better by so much.
BETTER = 5.0
#: How levels are called.
ROLES = {1: "상위 장/대단원", 2: "중간 절/하위 단원", 3: "소절"}
OTHER_ROLE = "세부 항목"


def typed_layout(raw: Column) -> dict[str, Column]:
    """The LAYOUT columns of an entry's raw map<string, string>: what can't be read is null."""
    out = {}
    for name, aliases in ALIASES.items():
        value = F.coalesce(*[F.try_element_at(raw, F.lit(a)) for a in aliases])
        if name in FLOATS:
            out[name] = F.bround(value.try_cast("double"), 2)
        else:
            out[name] = F.nullif(clean_text(value), F.lit("")) if name == "layout_text" else value.try_cast("int")
    return out


def layout_score(title: Column, prefix: str = "") -> Column:
    """How well an entry's layout columns stand for a title; null where they don't."""
    return title_line_score(title, F.col(f"{prefix}layout_text"), F.col(f"{prefix}font_size"), F.col(f"{prefix}size_ratio"), F.col(f"{prefix}y"))


def is_better(current: Column, candidate: Column, by: float = BETTER) -> Column:
    """Whether a candidate's score is enough over the current one's."""
    return F.coalesce(candidate.isNotNull() & (current.isNull() | (candidate > current + by)), F.lit(False))


def fill(names: list[str], overwrite: Column, prefix: str = "_") -> dict[str, Column]:
    """Columns that take the prefixed ones' values: where they have none, or everywhere there is one if overwrite."""
    return {c: F.when(overwrite, F.coalesce(f"{prefix}{c}", c)).otherwise(F.coalesce(c, f"{prefix}{c}")) for c in names}


# --- entries and lines --------------------------------------------------------------------------


def on_page(titles: DataFrame, lines: DataFrame) -> DataFrame:
    """titles with the lines of their page; those without a page with all lines of the document."""
    t = titles.withColumn("_any", F.col("page").isNull())
    own = lines.withColumnRenamed("page", "line_page")
    paged = t.where("not _any").join(own.withColumn("page", F.col("line_page")), ["doc_id", "page"])
    free = t.where("_any").join(own, "doc_id")
    return paged.unionByName(free).drop("_any")


def best_layout(titles: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, pos, chapter, page) with the best scored line of the page, the first of equal ones: match_score and LAYOUT columns."""
    t = settled(titles.select("doc_id", "pos", "chapter", "page"), {"_t": match_key("chapter")}).where("_t <> ''")
    of = settled(lines.select("doc_id", "page", *[F.col(c).alias(f"_{n}") for n, c in OF_LINE.items()]), {"_w": match_key("_layout_text"), "_listing": is_toc_listing(F.col("_layout_text"))}).where("_w <> ''")
    # Most pairs share no text: they go before anything is scored.
    j = on_page(t, of).where(F.col("_t").contains(F.col("_w")) | F.col("_w").contains(F.col("_t")))
    j = settled(j, {"match_score": F.bround(title_key_score(F.col("_t"), F.col("_w"), F.col("_listing"), F.col("_font_size"), F.col("_size_ratio"), F.col("_y")), 4)})
    best = F.max_by(F.struct("match_score", *[F.col(f"_{n}").alias(n) for n in LAYOUT]), F.struct("match_score", -F.col("_source_order")))
    return j.where("match_score is not null").groupBy("doc_id", "pos", "chapter", "page").agg(best.alias("m")).select("doc_id", "pos", "chapter", "page", "m.*")


def with_source_layout(toc: DataFrame, lines: DataFrame) -> DataFrame:
    """Entries whose layout columns come from the best line of their page: where they have none, or all if that line is better."""
    best = best_layout(toc, lines).select("doc_id", "pos", *[F.col(c).alias(f"_{c}") for c in LAYOUT])
    j = toc.join(best, ["doc_id", "pos"], "left")
    j = settled(j, {"_better": is_better(layout_score(F.col("chapter")), layout_score(F.col("chapter"), "_"))})
    j = j.withColumn("_source_order", F.coalesce("_source_order", F.col("pos").cast("int")))  # without a line, the entry's own place
    return j.withColumns(fill(LAYOUT, F.col("_better"))).select(*toc.columns)


def unique_anywhere(titles: DataFrame, lines: DataFrame) -> DataFrame:
    """titles (doc_id, pos, chapter) with the only line of the document that is the title, else the only one that starts with it, else has it."""
    t = settled(titles.select("doc_id", "pos", "chapter"), {"_a": norm("chapter")}).drop("chapter").where("_a <> ''")
    j = t.join(settled(lines, {"_w": norm("text")}), "doc_id").where(F.col("_w").contains(F.col("_a")))
    tier = F.when(F.col("_w") == F.col("_a"), 1).when(F.col("_w").startswith(F.col("_a")), 2).otherwise(3)
    w = Window.partitionBy("doc_id", "pos")
    # A line of one tier is also of the next: the tiers' counts add up.
    upto = lambda k: F.count(F.when(F.col("_tier") <= k, 1)).over(w)
    j = j.withColumn("_tier", tier).select("*", *[upto(k).alias(f"_n{k}") for k in (1, 2, 3)])
    gate = F.when(F.col("_n1") == 1, 1).when(F.col("_n2") == 1, 2).when(F.col("_n3") == 1, 3)
    return j.where(F.col("_tier") <= gate).drop("_a", "_w", "_tier", "_n1", "_n2", "_n3")


def attach_lines(toc: DataFrame, lines: DataFrame, *, any_page: bool = True, keep_unmatched: bool = False) -> DataFrame:
    """Entries with the line they stand for, in the order of the lines: matched, line_order, s, r, x, y, b, i, f, source_text, page_corrected, sorted_pos.

    By (page, source_order), else by the title on the page, else, with any_page, by a title that the document has
    once, which corrects the page. Without keep_unmatched, the first of equal titles on a page stays and what no line
    stands for goes; with it all stay, and what no line stands for comes last on its page.
    """
    from .toc import match_lines

    style = ["s", "r", "x", "y", "b", "i", "f"]
    line = F.struct("page", "source_order", *style, "text")
    entries = toc.select("doc_id", "pos", "chapter", "page", "source_order")
    by_id = entries.join(lines.select("doc_id", "page", "source_order", line.alias("l1")), ["doc_id", "page", "source_order"]).select("doc_id", "pos", "l1")
    rest = entries.join(by_id, ["doc_id", "pos"], "left_anti")
    by_title = match_lines(rest, lines).select("doc_id", "pos", "page", "source_order").join(lines.select("doc_id", "page", "source_order", line.alias("l2")), ["doc_id", "page", "source_order"]).select("doc_id", "pos", "l2")
    found = entries.select("doc_id", "pos").join(by_id, ["doc_id", "pos"], "left").join(by_title, ["doc_id", "pos"], "left").withColumn("line", F.coalesce("l1", "l2"))
    if any_page:
        rest = rest.join(by_title, ["doc_id", "pos"], "left_anti")
        anywhere = unique_anywhere(rest, lines).select("doc_id", "pos", line.alias("l3"))
        found = found.join(anywhere, ["doc_id", "pos"], "left").withColumn("line", F.coalesce("line", "l3"))
    j = toc.join(found.select("doc_id", "pos", "line"), ["doc_id", "pos"], "left")
    moved = F.coalesce(F.col("line.page") != F.col("page"), F.lit(False))
    note = F.concat(F.lit("Page corrected from "), F.col("page").cast("string"), F.lit(" to "), F.col("line.page").cast("string"), F.lit(" by parsed layout match."))
    reason = F.when(moved, F.trim(F.concat(clean_text("level_reason"), F.lit(" "), note))).otherwise(F.col("level_reason"))
    j = j.select(
        "doc_id", "pos", "level", "chapter", F.coalesce("line.page", "page").alias("page"), reason.alias("level_reason"), F.col("line").isNotNull().alias("matched"),
        F.col("line.source_order").alias("line_order"), *[F.col(f"line.{c}").alias(c) for c in style], F.col("line.text").alias("source_text"), moved.alias("page_corrected"),
    )
    if not keep_unmatched:
        first = Window.partitionBy("doc_id", norm("chapter"), "page").orderBy("pos")
        j = j.withColumn("_n", F.row_number().over(first)).where("_n = 1 and matched").drop("_n")
    order = Window.partitionBy("doc_id").orderBy("page", F.asc_nulls_last("line_order"), F.asc_nulls_last("y"), "pos")
    return j.withColumn("sorted_pos", F.row_number().over(order))


def location_text(**parts: Column) -> Column:
    """page=, line=, s=, r=, x= and y= of what is present (a page of 0 isn't)."""
    shown = [("page", F.nullif(parts["page"], F.lit(0))), ("line", parts["line_index"]), ("s", parts["s"]), ("r", parts["r"]), ("x", parts["x"]), ("y", parts["y"])]
    return F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in shown])


def _examples(when: Column, most: int) -> Column:
    """The first `most` example texts of the rows for which `when` holds, in order of lines."""
    shown = F.struct("line_index", F.concat(location_text(page=F.col("line_page"), line_index=F.col("line_index"), s=F.col("s"), r=F.col("r"), x=F.col("x"), y=F.col("y")), F.lit(': "'), short_title("text", 90), F.lit('"')).alias("t"))
    return F.transform(F.slice(F.array_sort(F.collect_list(F.when(when, shown))), 1, most), lambda v: v["t"])


def _page_keys(toc: DataFrame) -> DataFrame:
    return settled(toc.select("doc_id", "pos", "page", "chapter"), {"_t": match_key("chapter")}).drop("chapter").where("_t <> ''")


def title_evidence(toc: DataFrame, lines: DataFrame, most: int = 3) -> DataFrame:
    """(doc_id, pos): on how many lines of its page a title stands alone (exact_count) or within a longer text (embedded_count), with examples."""
    j = on_page(_page_keys(toc), settled(lines, {"_w": match_key("text")}).where("_w <> ''"))
    exact = F.col("_w") == F.col("_t")
    inside = ~exact & F.col("_w").contains(F.col("_t"))
    j = j.where(exact | inside)
    return j.groupBy("doc_id", "pos").agg(F.count(F.when(exact, 1)).alias("exact_count"), F.count(F.when(inside, 1)).alias("embedded_count"), _examples(exact, most).alias("exact_examples"), _examples(inside, most).alias("embedded_examples"))


#: Shapes of examples that tell of cases, figures, problems and references.
ANCILLARY_CONTEXT = (
    r"(?i)(?:^|[\s\"':])(?:사례|예시|보기|case|example|box)\s*\d+|(?:^|[\s\"':])(?:표|그림|figure|fig\.|table)\s*(?:<|\d|[IVXivx]+)[\dIVXivx.:\-]*"
    r"|(?:기본\s*문제|심화\s*문제|연습\s*문제|참고문헌|references?)"
)


def has_ancillary_context(*examples: Column) -> Column:
    """Whether any of the example texts tells of a case, figure, problem or reference."""
    return F.exists(F.flatten(F.array(*[F.coalesce(e, F.array().cast("array<string>")) for e in examples])), lambda t: clean_text(t).rlike(ANCILLARY_CONTEXT))


def neighbours(marked: DataFrame, lines: DataFrame, *, window: float = 80.0, places: int = 8) -> DataFrame:
    """marked lines (key columns k, doc_id, page, line_index, y) beside the lines of their page at most `window` away in height or `places` in order.

    A band join as two equi-joins: rows meet by page and the band of their height, or of their place, and its neighbours.
    """
    near = F.abs(F.col("y") - F.col("m_y")) <= window
    close = F.abs(F.col("line_index") - F.col("m_line_index")) <= places
    m = marked.select("k", "doc_id", "page", F.col("line_index").alias("m_line_index"), F.col("y").alias("m_y"))
    bands = lambda c, width: F.explode(F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: F.floor(F.col(c) / width) + d))
    by_height = m.where("m_y is not null").withColumn("_b", bands("m_y", window)).join(lines.withColumn("_b", F.floor(F.col("y") / window)), ["doc_id", "page", "_b"]).where(near)
    by_place = m.withColumn("_b", bands("m_line_index", places)).join(lines.withColumn("_b", F.floor(F.col("line_index") / places)), ["doc_id", "page", "_b"]).where(close & ~F.coalesce(near, F.lit(False)))
    return by_height.unionByName(by_place).drop("_b").where("line_index <> m_line_index")


def visual_context(toc: DataFrame, lines: DataFrame, *, window: float = 80.0, most: int = 4) -> DataFrame:
    """(doc_id, pos): captions (visual_caption_count) and small labels (small_label_count), at most 4 each, near the first 3 lines that have a title."""
    lines = settled(lines, {"_c": clean_text("text")})
    j = on_page(_page_keys(toc), settled(lines.select("doc_id", "page", "line_index", "y", "_c"), {"_w": match_key("_c")}))
    first = Window.partitionBy("doc_id", "pos").orderBy("line_index")
    match = j.where(F.col("_w").contains(F.col("_t"))).withColumn("_n", F.row_number().over(first)).where("_n <= 3")
    match = match.select(F.struct("pos", "_n").alias("k"), "doc_id", F.col("line_page").alias("page"), "line_index", "y")
    # What a line is like is told once, before the lines meet.
    caption = is_visual_caption(F.col("_c"))
    small = ~caption & F.coalesce((F.bround("r", 2) <= 0.9) & (F.bround("s", 2) <= 9.0), F.lit(False)) & ~has_structural_marker(F.col("_c"))
    near = neighbours(match, settled(lines.where("_c <> ''"), {"_caption": caption, "_small": small}).select("doc_id", "page", "line_index", "y", "_caption", "_small"), window=window)
    caption, small = F.col("_caption"), F.col("_small")
    counts = near.groupBy("doc_id", F.col("k.pos").alias("pos")).agg(F.least(F.count(F.when(caption, 1)), F.lit(most)).alias("visual_caption_count"), F.least(F.count(F.when(small, 1)), F.lit(most)).alias("small_label_count"))
    titles = match.select("doc_id", F.col("k.pos").alias("pos")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return titles.join(counts, ["doc_id", "pos"], "left").select("doc_id", "pos", zero("visual_caption_count"), zero("small_label_count"))


def near_captions(lines: DataFrame, *, window: float = 80.0) -> DataFrame:
    """(doc_id, page, line_index) of the lines with a caption near them: a left-semi band join."""
    captions = settled(lines, {"_caption": is_visual_caption(F.col("text"))}).where("_caption").select(F.col("line_index").alias("k"), "doc_id", "page", "line_index", "y")
    return neighbours(captions, lines.select("doc_id", "page", "line_index", "y"), window=window).select("doc_id", "page", "line_index").distinct()


# --- reasons ------------------------------------------------------------------------------------


def role_text(level: Column) -> Column:
    out = F.lit(OTHER_ROLE)
    for k, v in ROLES.items():
        out = F.when(level == k, v).otherwise(out)
    return out


def style_text(**style: Column) -> Column:
    """s=, r=, x=, y=, b=, i=, f= of what is present."""
    keys = {"font_size": "s", "size_ratio": "r", "x": "x", "y": "y", "bold": "b", "italic": "i", "font_id": "f"}
    return F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.nullif(clean_text(style[n]), F.lit(""))) for n, k in keys.items() if n in style])


def closest_reference(entries: DataFrame, references: DataFrame) -> DataFrame:
    """entries (doc_id, pos, style columns) with the level and title of the reference (doc_id, level, rank, title, style columns) of least distance; the first of equal ones."""
    style = ["font_size", "size_ratio", "x", "bold", "italic"]
    names = {"font_size": "font_size", "size_ratio": "size_ratio", "left_indent": "x", "bold": "bold", "italic": "italic"}
    none = F.lit(None).cast("string")
    r = references.select("doc_id", F.col("level").alias("closest_level"), "rank", F.col("title").alias("closest_title"), *[F.col(c).alias(f"_{c}") for c in style])
    j = entries.select("doc_id", "pos", *style).join(r, "doc_id")
    distance = style_distance({k: F.col(c) for k, c in names.items()} | {"font_id": none}, {k: F.col(f"_{c}") for k, c in names.items()} | {"font_id": none})
    j = j.withColumn("distance", F.round(distance, 6)).where("distance < 9999")
    best = F.min_by(F.struct("closest_level", "closest_title", "distance"), F.struct("distance", "closest_level", "rank"))
    return j.groupBy("doc_id", "pos").agg(best.alias("m")).select("doc_id", "pos", "m.*")


def level_reason(level: Column, style: Column, closest_level: Column, closest_title: Column) -> Column:
    """Why an entry has its level, in words: its role, its line's style and the closest reference."""
    n = level.cast("string")
    here = F.when(style != "", F.concat(F.lit("현재 줄 layout("), style, F.lit(")"))).otherwise(F.lit("현재 chunk에서 대응 layout tag를 찾지 못해 제목 계층과 주변 문맥 기준"))
    title = F.when(clean_text(closest_title) != "", F.concat(F.lit(' "'), clean_text(closest_title), F.lit('"'))).otherwise("")
    before = (
        F.when(closest_level == level, F.concat(F.lit("이전 level "), n, F.lit(" 예시"), title, F.lit("와 가장 가까운 style 패턴")))
        .when(closest_level.isNotNull(), F.concat(F.lit("이전 style 기준으로는 level "), closest_level.cast("string"), F.lit("와 가장 가까우나, 현재 문서의 제목 계층/문맥상 level "), n, F.lit("로 유지")))
        .otherwise(F.lit("이전 level style 기준 없음"))
    )
    return F.concat(F.concat_ws("; ", F.concat(F.lit("level "), n, F.lit(": "), role_text(level), F.lit(" 계층으로 분류됨")), here, before), F.lit("."))


def add_reasons(toc: DataFrame, lines: DataFrame, references: DataFrame, *, overwrite: bool = False) -> DataFrame:
    """Entries with source layout and, where they have none (or all, with overwrite), a level_reason."""
    t = with_source_layout(toc, lines)
    near = closest_reference(t, references).select("doc_id", "pos", "closest_level", "closest_title")
    t = t.join(near, ["doc_id", "pos"], "left")
    new = level_reason(F.col("level"), style_text(**{c: F.col(c) for c in ("font_size", "size_ratio", "x", "y", "bold", "italic")}), F.col("closest_level"), F.col("closest_title"))
    keep = (clean_text("level_reason") != "") & F.lit(not overwrite)
    return t.withColumn("level_reason", F.when(keep, F.col("level_reason")).otherwise(new)).select(*toc.columns)


# --- what partial and earlier tables know ---------------------------------------------------------

CARRIED = ["y", "x", "font_size", "size_ratio", "layout_text", "layout_page", "source_order", "merge_order"]


def _keyed(toc: DataFrame) -> DataFrame:
    return settled(toc, {"_key": match_key("chapter")}).withColumn("_page", F.coalesce(F.col("page").try_cast("int"), F.lit(1)))


def first_reasons(partials: DataFrame) -> DataFrame:
    """(doc_id, key, page): the first reason that partial tables (column chunk) have for a title and page, and its level."""
    p = _keyed(partials).where((clean_text("level_reason") != "") & (F.col("_key") != ""))
    first = F.min_by(F.struct(clean_text("level_reason").alias("reason"), F.col("level").alias("reason_level")), F.struct("chunk", "pos"))
    return p.groupBy("doc_id", "_key", "_page").agg(first.alias("m")).select("doc_id", F.col("_key").alias("key"), F.col("_page").alias("page"), "m.*")


def first_layouts(partials: DataFrame) -> DataFrame:
    """(doc_id, key, page): the first layout that partial tables have for a title and page."""
    p = _keyed(partials).where((F.col("_key") != "") & F.coalesce(*[F.col(c).cast("string") for c in CARRIED]).isNotNull())
    first = F.min_by(F.struct(*CARRIED), F.struct("chunk", "pos"))
    return p.groupBy("doc_id", "_key", "_page").agg(first.alias("m")).select("doc_id", F.col("_key").alias("key"), F.col("_page").alias("page"), "m.*")


def restore_reasons(toc: DataFrame, partials: DataFrame) -> DataFrame:
    """Entries without a reason take the partial tables' first one for their title and page, if the levels agree."""
    known = first_reasons(partials).select("doc_id", F.col("key").alias("_key"), F.col("page").alias("_page"), "reason", "reason_level")
    j = _keyed(toc).join(known, ["doc_id", "_key", "_page"], "left")
    use = (clean_text("level_reason") == "") & (F.col("reason_level") == F.col("level"))
    return j.withColumn("level_reason", F.when(F.coalesce(use, F.lit(False)), F.col("reason")).otherwise(F.col("level_reason"))).select(*toc.columns)


def restore_layouts(toc: DataFrame, partials: DataFrame) -> DataFrame:
    """Entries take the partial tables' first layout for their title and page: what they lack, or all if it stands for the title better."""
    known = first_layouts(partials).select("doc_id", F.col("key").alias("_key"), F.col("page").alias("_page"), *[F.col(c).alias(f"_{c}") for c in CARRIED])
    j = _keyed(toc).join(known, ["doc_id", "_key", "_page"], "left")
    j = settled(j, {"_better": is_better(layout_score(F.col("chapter")), layout_score(F.col("chapter"), "_"))})
    j = j.withColumns(fill(CARRIED, F.col("_better")))
    return j.withColumn("merge_order", F.coalesce("merge_order", F.col("pos").cast("int"))).select(*toc.columns)


def restore_from_source(toc: DataFrame, source: DataFrame) -> DataFrame:
    """Entries take from the table before a review (the last of equal titles and pages) the layout they lack, or all if it is better, and the reason if levels agree."""
    last = F.max_by(F.struct(*CARRIED, "level", "level_reason"), "pos")
    known = _keyed(source).where("_key <> ''").groupBy("doc_id", "_key", "_page").agg(last.alias("m")).select("doc_id", "_key", "_page", *[F.col(f"m.{c}").alias(f"_{c}") for c in (*CARRIED, "level", "level_reason")])
    j = _keyed(toc).join(known, ["doc_id", "_key", "_page"], "left")
    j = settled(j, {"_better": is_better(layout_score(F.col("chapter")), layout_score(F.col("chapter"), "_"))})
    reason = F.when(F.col("level_reason").isNull() & (F.col("_level") == F.col("level")), F.col("_level_reason")).otherwise(F.col("level_reason"))
    return j.withColumns({**fill(CARRIED, F.col("_better")), "level_reason": reason}).select(*toc.columns)


def merge_order_key() -> list[Column]:
    """Order of merged entries: page, then by source_order, else merge_order, else height, else none; then height, indent and level."""
    y, x = F.col("y").cast("double"), F.col("x").cast("double")
    far = F.lit(999_999.0)
    source, merge = F.col("source_order").cast("double"), F.col("merge_order").cast("double")
    tier = F.when(source.isNotNull(), 0).when(merge.isNotNull(), 1).when(y.isNotNull(), 2).otherwise(3)
    second = F.coalesce(source, merge, y, far)
    third = F.when(F.coalesce(source, merge).isNotNull(), F.coalesce(y, far)).otherwise(F.coalesce(x, far))
    fourth = F.when(F.coalesce(source, merge).isNotNull(), F.coalesce(x, far)).otherwise(far)
    return [F.coalesce(F.col("page").try_cast("int"), F.lit(1)), tier, second, third, fourth, F.coalesce(F.col("level").try_cast("int"), F.lit(1))]


def merge_locally(partials: DataFrame, max_depth: int = 6) -> DataFrame:
    """Partial tables (column chunk) as one, in the order of merge_order_key, validated; pos is the place there."""
    from .toc import validate

    by_doc = Window.partitionBy("doc_id")
    p = partials.withColumn("merge_order", F.coalesce("merge_order", (F.row_number().over(by_doc.orderBy("chunk", "pos")) - 1).cast("int")))
    p = p.withColumn("pos", F.row_number().over(by_doc.orderBy(*merge_order_key(), "chunk", "pos")) - 1)
    return validate(p, max_depth)


def sort_restored(toc: DataFrame, partials: DataFrame, max_depth: int = 6) -> DataFrame:
    """toc with the partial tables' layouts, in the order of merge_order_key, validated."""
    from .toc import validate

    t = restore_layouts(toc, partials).withColumn("merge_order", F.coalesce("merge_order", F.col("pos").cast("int")))
    return validate(t.withColumn("pos", F.row_number().over(Window.partitionBy("doc_id").orderBy(*merge_order_key(), "pos")) - 1), max_depth)
