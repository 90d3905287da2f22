"""Review of tables of contents: what changed, what is missing, what may be wrong, how styles and levels agree.

Entries are rows (doc_id, pos, level, chapter, page, level_reason) with layout columns (operators.attach), lines rows of styled text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbering import decimal_path
from ..functions.numbers import heading_style_score
from ..functions.predicates import has_structural_marker, is_ancillary, is_running_header_footer, is_style_heading, is_toc_listing
from ..functions.text import clean_text, match_key, number_path_text, settled, short_title, style_key_text
from .attach import best_layout, has_ancillary_context, layout_score, title_evidence, visual_context

SNAPSHOT = ["level", "chapter", "page", "level_reason", "layout_page", "x", "y", "font_size", "size_ratio", "layout_text", "source_order", "merge_order"]


def snapshot(row: str | None = None) -> Column:
    """The fields of an entry that aren't blank, as a map of texts."""
    at = (lambda c: F.col(f"{row}.{c}")) if row else F.col
    pair = lambda c: F.struct(F.lit(c).alias("k"), F.nullif(clean_text(at(c)), F.lit("")).alias("v"))
    return F.map_from_entries(F.filter(F.array(*[pair(c) for c in SNAPSHOT]), lambda e: e["v"].isNotNull()))


def compact(toc: DataFrame, *, metadata: bool = False) -> DataFrame:
    """(doc_id, pos, entry): entries with a title as JSON of level, chapter and page, with metadata of all that a review looks at."""
    t = toc.withColumn("chapter", clean_text("chapter")).where("chapter <> ''")
    texts = ("level_reason", "layout_text")
    rest = [F.nullif(clean_text(c), F.lit("")).alias(c) if c in texts else F.col(c) for c in SNAPSHOT[3:]] if metadata else []
    return t.select("doc_id", "pos", F.to_json(F.struct("level", "chapter", "page", *rest)).alias("entry"))


def _by_key(toc: DataFrame) -> DataFrame:
    """The last entry of each title and page: doc_id, key, key_page, e."""
    t = toc.withColumn("key", match_key("chapter")).where("key <> ''").withColumn("key_page", F.coalesce(F.col("page").try_cast("int"), F.lit(1)))
    return t.groupBy("doc_id", "key", "key_page").agg(F.max_by(F.struct(*SNAPSHOT), "pos").alias("e"))


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What a review did: doc_id, kind (level_changed, added, removed), place in its kind, before_level, after_level, chapter, page and both snapshots.

    A full outer join by title and page. Order: page, source_order (else merge_order), height, title; what is 0 counts as missing.
    """
    b, a = _by_key(before).withColumnRenamed("e", "b"), _by_key(after).withColumnRenamed("e", "a")
    j = b.join(a, ["doc_id", "key", "key_page"], "full")
    kind = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").when(F.col("b.level") != F.col("a.level"), "level_changed")
    j = j.withColumn("kind", kind).where("kind is not null").withColumn("e", F.coalesce("a", "b"))
    none0 = lambda *c: F.coalesce(*[F.nullif(F.col(x), F.lit(0)) for x in c], F.lit(0))
    order = [none0("e.page"), none0("e.source_order", "e.merge_order"), F.coalesce("e.y", F.lit(0.0)), clean_text("e.chapter"), "key", "key_page"]
    place = F.row_number().over(Window.partitionBy("doc_id", "kind").orderBy(*order))
    return j.select("doc_id", "kind", place.alias("place"), F.col("b.level").alias("before_level"), F.col("a.level").alias("after_level"), clean_text("e.chapter").alias("chapter"), F.col("e.page").alias("page"), F.when(F.col("b").isNotNull(), snapshot("b")).alias("before"), F.when(F.col("a").isNotNull(), snapshot("a")).alias("after"))


def change_counts(changed: DataFrame) -> DataFrame:
    """(doc_id, level_change_count, added_count, removed_count) of the documents that changed."""
    n = lambda k: F.count(F.when(F.col("kind") == k, 1))
    return changed.groupBy("doc_id").agg(n("level_changed").alias("level_change_count"), n("added").alias("added_count"), n("removed").alias("removed_count"))


# --- missing entries ----------------------------------------------------------------------------


def missing_numbered(toc: DataFrame, lines: DataFrame, partials: DataFrame, most: int = 30) -> DataFrame:
    """The first `most` numbered titles of lines and partial tables (column chunk) whose number and title the table lacks, in order of
    number: doc_id, rank, source, number, title, page, chunk, line_index, and the style. A line's title counts before those
    of partial tables; of lines the first, of partial tables the last."""
    path = lambda c: decimal_path(F.col(c))
    style = ["font_size", "size_ratio", "x", "y"]
    has = settled(toc.select("doc_id", "chapter"), {"path": path("chapter")}).drop("chapter").where("path is not null").distinct()
    titles = settled(toc.select("doc_id", "chapter"), {"key": match_key("chapter")}).drop("chapter").where("key <> ''").distinct()
    none = lambda kind: F.lit(None).cast(kind)
    own = lines.select("doc_id", F.lit("source_text").alias("source"), clean_text("text").alias("title"), "page", none("int").alias("chunk"), "line_index", *[F.col(c).alias(n) for c, n in zip(("s", "r", "x", "y"), style, strict=True)], F.col("line_index").alias("at"))
    other = partials.select("doc_id", F.lit("partial_toc").alias("source"), clean_text("chapter").alias("title"), "page", "chunk", F.col("source_order").alias("line_index"), *style, (-F.row_number().over(Window.partitionBy("doc_id").orderBy("chunk", "pos"))).alias("at"))
    both = settled(settled(own.unionByName(other), {"path": path("title")}).where("path is not null"), {"key": match_key("title")})
    both = both.join(has, ["doc_id", "path"], "left_anti").join(titles, ["doc_id", "key"], "left_anti")
    first = F.min_by(F.struct("source", "title", "page", "chunk", "line_index", *style), F.struct(F.col("source") != "source_text", "at")).alias("m")
    found = both.groupBy("doc_id", "path").agg(first)
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("path"))
    return found.withColumn("rank", rank).where(F.col("rank") <= most).select("doc_id", "rank", number_path_text(F.col("path")).alias("number"), "m.*")


def style_profiles(toc: DataFrame) -> DataFrame:
    """(doc_id, level, font_size, size_ratio, left_indent, title) of the entries that have a style."""
    t = toc.where("font_size is not null or size_ratio is not null")
    return t.select("doc_id", F.coalesce(F.col("level").try_cast("int"), F.lit(1)).alias("level"), "font_size", "size_ratio", F.col("x").alias("left_indent"), clean_text("chapter").alias("title"))


def known_styles(lines: DataFrame, profiles: DataFrame) -> DataFrame:
    """lines with known_style: whether an entry of the document has a type within 1.0 of the size and 0.12 of the ratio (what the entry lacks doesn't count).

    Distinct styles meet, not lines and entries: a band join by bins of the size, or of the ratio where an entry has no size.
    """
    from ..functions.predicates import style_near

    p = profiles.select("doc_id", F.col("font_size").alias("pf"), F.col("size_ratio").alias("pr")).distinct()
    own = lines.select("doc_id", F.bround("s", 2).alias("s"), F.bround("r", 2).alias("r")).distinct()
    bins = lambda c, w: F.explode(F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: F.floor(F.col(c) / w) + d))
    near = style_near(F.col("s"), F.col("r"), F.col("pf"), F.col("pr"))
    by_size = p.where("pf is not null").withColumn("_b", bins("pf", 1.0)).join(own.withColumn("_b", F.floor(F.col("s") / 1.0)), ["doc_id", "_b"]).where(near)
    by_ratio = p.where("pf is null").withColumn("_b", bins("pr", 0.12)).join(own.withColumn("_b", F.floor(F.col("r") / 0.12)), ["doc_id", "_b"]).where(near)
    found = by_size.select("doc_id", "s", "r").union(by_ratio.select("doc_id", "s", "r")).distinct().withColumn("known_style", F.lit(True))
    j = lines.withColumns({"_s": F.bround("s", 2), "_r": F.bround("r", 2)}).join(found.withColumnsRenamed({"s": "_s", "r": "_r"}), ["doc_id", "_s", "_r"], "left")
    return j.withColumn("known_style", F.coalesce("known_style", F.lit(False))).drop("_s", "_r")


def missing_styled(toc: DataFrame, lines: DataFrame, most: int = 40) -> DataFrame:
    """The `most` best scored lines that look like headings and whose titles the table lacks, the first of equal titles, in order of lines: doc_id, page, line_index, title, score."""
    titles = settled(toc.select("doc_id", "chapter"), {"key": match_key("chapter")}).drop("chapter").where("key <> ''").distinct()
    t = F.col("text")
    # A line's heading by style is told for both answers to whether its style is known, before the lines meet anything.
    heads = {f"_head{k}": is_style_heading(t, F.bround("r", 2), F.col("b"), F.col("i"), F.lit(bool(k))) for k in (0, 1)}
    lines = settled(lines, {"key": match_key("text"), **heads}).where("key <> '' and (_head0 or _head1)")
    own = known_styles(lines, style_profiles(toc)).join(titles, ["doc_id", "key"], "left_anti")
    own = own.where("case when known_style then _head1 else _head0 end")
    first = Window.partitionBy("doc_id", "key").orderBy("line_index")
    own = own.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    own = own.withColumn("score", F.round(heading_style_score(F.bround("s", 2), F.bround("r", 2), F.col("b"), F.col("i"), F.col("known_style")), 6))
    best = Window.partitionBy("doc_id").orderBy(F.desc("score"), F.coalesce("page", F.lit(0)), "line_index")
    return own.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= most).select("doc_id", "page", "line_index", clean_text("text").alias("title"), "score")


# --- entries that may be wrong -------------------------------------------------------------------

#: Why an entry may be no heading.
REASONS = {
    "label": "the title looks like a case, example, figure, table, problem or reference", "context": "its lines look like cases, figures, problems or references", "visual": "figures or tables stand near it",
    "embedded": "it is part of longer lines", "weak_deep": "body type without a mark at a deep level", "weak_restored": "restored by an audit in body type", "very_weak": "body type without a mark at level 5",
}


def invalid_headings(toc: DataFrame, lines: DataFrame, most: int = 40) -> DataFrame:
    """Up to `most` entries of each document with reasons (keys of REASONS) to look at again, in order of page, height and level: doc_id, rank, pos, level, page, chapter, reasons, and what their lines tell."""
    keys = ["doc_id", "pos"]
    layout = ["y", "font_size", "size_ratio", "bold", "italic"]
    known = F.coalesce(*[F.col(c).cast("string") for c in (*layout, "x", "layout_text", "layout_page", "source_order")]).isNotNull()
    found = best_layout(toc, lines).select(*keys, *[F.col(c).alias(f"_{c}") for c in layout])
    mark = has_structural_marker(F.col("chapter"))
    t = settled(toc, {"_c": clean_text("chapter"), "_mark": mark, "_label": is_ancillary(F.col("chapter"))}).where("_c <> ''").withColumn("_known", known).join(found, keys, "left")
    t = t.withColumns({c: F.when(F.col("_known"), F.col(c)).otherwise(F.col(f"_{c}")) for c in layout})
    t = t.join(title_evidence(toc, lines), keys, "left").join(visual_context(toc, lines), keys, "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    plain = (zero("bold") == 0) & (zero("italic") == 0)
    weak, very = F.coalesce(F.col("size_ratio") <= 1.08, F.lit(False)) & plain, F.coalesce(F.col("size_ratio") <= 1.05, F.lit(False)) & plain
    t = t.withColumns({"_weak": weak, "_very": very})
    near = (zero("visual_caption_count") > 0) | (zero("small_label_count") >= 2)
    rules = {
        "label": F.col("_label"), "context": has_ancillary_context(F.col("exact_examples"), F.col("embedded_examples")), "visual": near & ~F.col("_mark"),
        "embedded": (zero("embedded_count") > 0) & (zero("exact_count") == 0) & F.col("_weak"), "weak_deep": F.col("_weak") & ~F.col("_mark") & (F.col("level") >= 4),
        "weak_restored": F.lower(clean_text("level_reason")).contains("completeness audit") & F.col("_weak") & ~F.col("_mark"), "very_weak": F.col("_very") & ~F.col("_mark") & (F.col("level") >= 5),
    }
    t = settled(t, {"reasons": F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))}).where(F.size("reasons") > 0)
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(zero("page"), F.coalesce("y", F.lit(0.0)), "level", "pos"))
    t = t.withColumn("rank", rank).where(F.col("rank") <= most)
    return t.select("doc_id", "rank", "pos", "level", "page", clean_text("chapter").alias("chapter"), "reasons", zero("exact_count").alias("exact_count"), zero("embedded_count").alias("embedded_count"), zero("visual_caption_count").alias("visual_caption_count"), zero("small_label_count").alias("small_label_count"))


def told(invalid: DataFrame) -> DataFrame:
    """(doc_id, text): invalid_headings in words, an entry a line."""
    words = F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv])
    why = F.array_join(F.transform("reasons", lambda r: words[r]), "; ")
    line = F.concat(F.lit("- level="), F.col("level").cast("string"), F.lit(", page="), F.col("page").cast("string"), F.lit(': "'), short_title("chapter", 100), F.lit('": '), why)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("t")))), lambda v: v["t"]), "\n")
    return invalid.groupBy("doc_id").agg(text.alias("text"))


# --- styles and levels ---------------------------------------------------------------------------


def styled_entries(toc: DataFrame) -> DataFrame:
    """Entries whose layout stands for their title and is neither a listing nor a running head, with style_font and style_ratio."""
    t = toc.withColumns({"style_font": F.bround("font_size", 1), "style_ratio": F.bround("size_ratio", 2)}).where(clean_text("chapter") != "")
    fine = layout_score(F.col("chapter")).isNotNull() & ~is_toc_listing(F.col("layout_text")) & ~is_running_header_footer(F.col("y"), F.col("font_size"), F.col("size_ratio"))
    return settled(t, {"_fine": fine}).where(F.col("_fine") & (F.col("style_font").isNotNull() | F.col("style_ratio").isNotNull())).drop("_fine")


def level_styles(toc: DataFrame, most: int = 5) -> DataFrame:
    """The `most` commonest styles of each level: doc_id, level, rank, style, count, x_min, x_max and up to 3 titles."""
    t = styled_entries(toc)
    titles = F.transform(F.slice(F.array_sort(F.collect_list(F.struct("pos", short_title("chapter", 60).alias("t")))), 1, 3), lambda v: v["t"])
    g = t.groupBy("doc_id", "level", "style_font", "style_ratio").agg(F.count("*").alias("count"), F.min("x").alias("x_min"), F.max("x").alias("x_max"), titles.alias("examples"))
    g = g.withColumn("style", style_key_text(F.col("style_font"), F.col("style_ratio")))
    rank = F.row_number().over(Window.partitionBy("doc_id", "level").orderBy(F.desc("count"), "style"))
    return g.withColumn("rank", rank).where(F.col("rank") <= most).select("doc_id", "level", "rank", "style", "count", "x_min", "x_max", "examples")


def style_conflicts(toc: DataFrame, most: int = 20) -> DataFrame:
    """Up to `most` entries of each document whose style tells of another level: doc_id, rank, pos, kind, level, better_level.

    First entries of level 1 in much smaller type than its largest (kind smaller), then those whose style has mostly another level, or isn't
    the commonest of its own (kind other).
    """
    t = styled_entries(toc)
    style = ["style_font", "style_ratio"]
    n = t.groupBy("doc_id", "level", *style).agg(F.count("*").alias("n"))
    per_style = Window.partitionBy("doc_id", *style)
    n = n.withColumns({"best": F.max(F.struct("n", (-F.col("level")).alias("l"))).over(per_style), "top": F.max("n").over(Window.partitionBy("doc_id", "level"))})
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    ones = n.where("level = 1")
    lead = ones.groupBy("doc_id").agg(F.count("*").alias("styles"), F.max(F.struct(zero("style_font").alias("f"), zero("style_ratio").alias("r"), "n")).alias("m")).where("styles >= 2").select("doc_id", F.col("m.f").alias("lf"), F.col("m.r").alias("lr"))
    own = n.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "level", *style)], "n", "best", "top")
    same = (F.col("doc_id") == F.col("_doc_id")) & (F.col("level") == F.col("_level")) & F.col("style_font").eqNullSafe(F.col("_style_font")) & F.col("style_ratio").eqNullSafe(F.col("_style_ratio"))
    j = t.join(own, same).select("doc_id", "pos", "level", *style, "n", "best", "top").join(lead, "doc_id", "left")
    part = lambda own, most_: F.when(most_ > 0, own / most_).otherwise(1.0)
    is_lead = (zero("style_font") == F.col("lf")) & (zero("style_ratio") == F.col("lr"))
    small = (F.col("level") == 1) & F.col("lf").isNotNull() & ~is_lead & ~((part(zero("style_font"), F.col("lf")) > 0.82) & (part(zero("style_ratio"), F.col("lr")) > 0.82))
    best = -F.col("best.l")
    other = ~((best == F.col("level")) & (F.col("n") >= F.col("top"))) & ~((best != F.col("level")) & (F.col("best.n") < F.greatest(F.lit(2), F.col("n") + 1)))
    rows = j.where(small).select("doc_id", "pos", F.lit("smaller").alias("kind"), "level", F.lit(None).cast("int").alias("better_level")).unionByName(j.where(other).select("doc_id", "pos", F.lit("other").alias("kind"), "level", best.cast("int").alias("better_level")))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("kind"), "pos"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= most).select("doc_id", "rank", "pos", "kind", "level", "better_level")


def partial_bounds(partials: DataFrame) -> DataFrame:
    """(doc_id, start_page, end_page, entries, max_page) of partial tables (chunk, start_page, end_page, page): the pages of their entries, else their chunks'."""
    page = F.when(F.col("page").try_cast("int") > 0, F.col("page").try_cast("int"))
    g = partials.groupBy("doc_id").agg(F.min(page).alias("a"), F.max(page).alias("b"), F.min("start_page").alias("c"), F.max("end_page").alias("d"), F.count("page").alias("entries"))
    return g.select("doc_id", F.coalesce("a", "c").alias("start_page"), F.coalesce("b", "d").alias("end_page"), "entries", F.coalesce("b", F.lit(0)).alias("max_page"))


def truncated(toc: DataFrame, partials: DataFrame) -> DataFrame:
    """(doc_id, truncated): whether a merged table lost the tail of its partial tables."""
    from ..functions.predicates import is_merge_truncated

    out = toc.groupBy("doc_id").agg(F.max(F.when(F.col("page") > 0, F.col("page"))).alias("out_max"), F.count("*").alias("out_count"))
    j = partials.join(out.select("doc_id", "out_max"), "doc_id", "left")
    src = j.groupBy("doc_id").agg(F.max("page").alias("source_max"), F.count("*").alias("source_count"), F.count(F.when(F.col("page") > F.col("out_max") + 3, 1)).alias("source_after"))
    j = src.join(out, "doc_id", "left")
    return j.select("doc_id", is_merge_truncated(F.col("out_max"), F.coalesce("out_count", F.lit(0)), F.col("source_max"), F.col("source_count"), F.col("source_after")).alias("truncated"))


def prompt(base: DataFrame, **evidence: DataFrame) -> DataFrame:
    """(doc_id, prompt): base (doc_id, text) and the evidence (doc_id, text) under headings of their names, what is empty left out."""
    out = base.select("doc_id", F.col("text").alias("_base"))
    for name, df in evidence.items():
        out = out.join(df.select("doc_id", F.nullif(F.trim("text"), F.lit("")).alias(f"_{name}")), "doc_id", "left")
    parts = [F.concat(F.lit(f"[{name.replace('_', ' ')}]\n"), F.col(f"_{name}")) for name in evidence]
    return out.select("doc_id", F.concat_ws("\n\n", "_base", *parts).alias("prompt"))
