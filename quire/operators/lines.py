"""Line operators: gaps, repeated headers and footers, front and back matter, body size, style clusters, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbering import label_level
from ..functions.predicates import BACK_WORDS, FRONT_WORDS, QUESTION_WORDS, heading_facts, is_page_number_line, is_probable_non_heading, is_title_like
from ..functions.text import clean_text, compact_text, header_footer_key, let, match_key, norm_key, page_range, settled, short_title


def gaps(lines: DataFrame) -> DataFrame:
    """prev_gap and next_gap (never negative) of lines with y0, y1, x0 and page_height, in each page's order."""
    w = Window.partitionBy("doc_id", "page").orderBy("y0", "x0")
    before = F.col("y0") - F.lag("y1", 1, 0.0).over(w)
    after = F.coalesce(F.lead("y0").over(w), F.col("page_height")) - F.col("y1")
    return lines.withColumns({"prev_gap": F.greatest(F.lit(0.0), before), "next_gap": F.greatest(F.lit(0.0), after)})


def at_edge(top: Column, bottom: Column) -> Column:
    return (top <= 0.10) | (bottom >= 0.90)


def edge_lines(lines: DataFrame) -> DataFrame:
    """The lines at page edges, with the key by which repeats are told."""
    return lines.where(at_edge(F.col("rel_y0"), F.col("rel_y1"))).withColumn("_key", header_footer_key("text"))


def repeated_edge_keys(lines: DataFrame, pages: int = 3) -> DataFrame:
    """(doc_id, key, pages): what stands at the top or bottom of so many pages of a document."""
    keys = edge_lines(lines).where(F.char_length("_key") >= 3)
    return keys.groupBy("doc_id", F.col("_key").alias("key")).agg(F.countDistinct("page").alias("pages")).where(F.col("pages") >= pages)


def remove_headers_footers(lines: DataFrame, pages: int = 3) -> DataFrame:
    """lines without what repeats at page edges, and without page numbers there. Lines inside a page are never moved nor looked at."""
    inner = lines.where(~at_edge(F.col("rel_y0"), F.col("rel_y1")))
    edges = edge_lines(lines).where(~is_page_number_line(F.col("text")))
    again = repeated_edge_keys(lines, pages).select("doc_id", F.col("key").alias("_key"))
    return inner.unionByName(edges.join(again, ["doc_id", "_key"], "left_anti").select(*lines.columns))


def content_bounds(lines: DataFrame) -> DataFrame:
    """(doc_id, content_start, back_start): the first page with a part or chapter label and no contents word; the first index page from there on."""
    own = settled(lines.select("doc_id", "page", "text"), {"_k": F.lower(compact_text("text")), "_label": F.coalesce(label_level(F.col("text")) <= 2, F.lit(False))})
    text = F.col("_k")
    front = F.lit(False)
    for w in FRONT_WORDS:
        front = front | text.contains(w)
    pages = own.groupBy("doc_id", "page").agg(F.bool_or(front).alias("front"), F.bool_or("_label").alias("label"), F.bool_or(text.isin(BACK_WORDS)).alias("back"))
    start = pages.groupBy("doc_id").agg(F.min(F.when(~F.col("front") & F.col("label"), F.col("page"))).alias("content_start"))
    back = pages.join(start, "doc_id").where("back and (content_start is null or page >= content_start)").groupBy("doc_id").agg(F.min("page").alias("back_start"))
    return start.join(back, "doc_id", "left")


def trim_front_back(lines: DataFrame) -> DataFrame:
    bounds = content_bounds(lines)
    inside = "(content_start is null or page >= content_start) and (back_start is null or page < back_start)"
    return lines.join(bounds, "doc_id").where(inside).drop("content_start", "back_start")


def body_size(lines: DataFrame, size: str = "s") -> DataFrame:
    """(doc_id, body_size): the size of most text (lines of 8 characters or more, each counting 120 at most); ties go to the smaller size."""
    n = F.char_length("text")
    plain = (n >= 8) & let(heading_facts(F.col("text")), lambda f: ~f["caption"] & ~f["bad"])
    sizes = lines.select("doc_id", F.bround(F.col(size), 1).alias("size"), F.when(plain, F.least(n, F.lit(120))).otherwise(0).alias("w"))
    sums = sizes.groupBy("doc_id", "size").agg(F.sum("w").alias("w"), F.count("*").alias("n"))
    best = sums.groupBy("doc_id").agg(F.max_by("size", F.struct("w", F.when(F.col("w") > 0, 0).otherwise(F.col("n")), -F.col("size"))).alias("body_size"))
    return best


STYLE = ["font_size", "size_ratio", "bold", "italic", "font_id", "left_band"]


def cluster_key(lines: DataFrame) -> DataFrame:
    """Grouping columns of a style: size to .1, ratio to .01 (1 if there is none), bold, italic, font, the indent to 10."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    ratio = F.coalesce(F.nullif(F.col("r"), F.lit(0.0)), F.lit(1.0))
    return lines.withColumns({
        "font_size": F.bround(zero("s").cast("double"), 1), "size_ratio": F.bround(ratio, 2), "bold": (zero("b") != 0).cast("int"), "italic": (zero("i") != 0).cast("int"),
        "font_id": F.coalesce(F.nullif(clean_text("f"), F.lit("")), F.lit("f?")), "left_band": (F.bround(zero("x") / 10) * 10).cast("int"),
    })


def style_clusters(lines: DataFrame) -> DataFrame:
    """A document's lines by style: lines, pages, median x and y, the range of pages, the first line, and up to 3 distinct sample titles
    of its first 8 lines that could be headings."""
    c = cluster_key(lines.where(clean_text("text") != ""))
    sample = F.when(~is_probable_non_heading(F.col("text")), F.struct("line_index", short_title("text", 80).alias("t"), match_key(short_title("text", 80)).alias("k")))
    c = c.withColumn("_sample", sample).groupBy("doc_id", *STYLE).agg(
        F.count("*").alias("line_count"), F.countDistinct("page").alias("page_count"), F.round(F.median("x"), 1).alias("median_x"), F.round(F.median("y"), 1).alias("median_y"),
        page_range(F.min("page"), F.max("page")).alias("page_range"), F.min("line_index").alias("first_line"), F.slice(F.array_sort(F.collect_list("_sample")), 1, 8).alias("_samples"),
    )
    # The first of equal titles: those without an equal one before them.
    distinct = F.filter("_samples", lambda v, n: ~F.exists(F.slice(F.col("_samples"), F.lit(1), n), lambda w: w["k"] == v["k"]))
    return c.withColumn("samples", F.slice(F.transform(distinct, lambda v: v["t"]), 1, 3)).drop("_samples")


def body_styles(clusters: DataFrame, top: int = 5) -> DataFrame:
    """The `top` commonest plain styles of each document: doc_id, rank and the clusters' columns."""
    plain = clusters.where((F.col("size_ratio") <= 1.12) & (F.col("bold") == 0) & (F.col("italic") == 0))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("line_count"), "first_line", *STYLE))
    return plain.withColumn("rank", rank).where(F.col("rank") <= top)


def strong_styles(clusters: DataFrame, top: int = 30) -> DataFrame:
    """The `top` styles of each document that stand out most, those of several lines or pages first: by ratio, size, then lines."""
    strong = clusters.where((F.col("size_ratio") > 1.08) | (F.col("bold") > 0) | (F.col("italic") > 0))
    once = (F.col("line_count") < 2) & (F.col("page_count") < 2)
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(once, F.desc("size_ratio"), F.desc("font_size"), F.desc("line_count"), "first_line", *STYLE))
    return strong.withColumn("rank", rank).where(F.col("rank") <= top)


def title_examples(lines: DataFrame, top: int = 80) -> DataFrame:
    """The first `top` lines of each document that could be titles and have no caption near them."""
    from .attach import near_captions

    like = settled(lines, {"_like": is_title_like(F.col("text"), F.col("s"), F.col("r"), F.col("b"), F.col("i"))}).where("_like").drop("_like")
    like = like.join(near_captions(lines).select("doc_id", "line_index"), ["doc_id", "line_index"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "line_index"))
    return like.withColumn("rank", rank).where(F.col("rank") <= top)


def score(lines: DataFrame, max_chars: int = 120, captions: bool = False) -> DataFrame:
    """score and reasons of lines with text, s, b, body_size, prev_gap, next_gap, rel_y0, x0, x1 and page_width as headings."""
    t, n, s = F.col("text"), F.char_length("text"), F.col("s")
    # What is used more than once is computed once, in columns of its own.
    names = lines.columns
    style = F.coalesce("_facts.number.style", F.lit(""))
    lines = settled(lines, {"_facts": heading_facts(t)}).select(*names, *[F.col(f"_facts.{c}").alias(f"_{c}") for c in ("bad", "noise", "caption", "numbered")], (style.startswith("ko_") & F.col("_facts.number.level").isNotNull()).alias("_label"), style.alias("_style"))
    diff, bold = s - F.col("body_size"), F.col("b") > 0
    style, numbered = F.col("_style"), F.col("_numbered")
    room = F.col("prev_gap") >= F.greatest(s * 0.65, F.lit(6.0))
    decimal, paren = style.startswith("arabic_decimal_"), style == "arabic_paren"
    centred = F.abs((F.col("x0") + F.col("x1")) / 2 - F.col("page_width") / 2) <= F.col("page_width") * 0.12
    question = F.lit(False)
    for w in QUESTION_WORDS:
        question = question | t.contains(w)
    sentence = (t.rlike(r"(?:\.|다|요\.|니다\.)$") | question) & (n > 40)
    step = F.when(diff >= 6, 0).when(diff >= 3, 1).when(diff >= 1.2, 2).when((diff >= -0.2) & bold & numbered, 3).when(diff < -0.8, 4)
    rules: list[tuple[str, Column, float]] = [
        ("short", n <= max_chars, 1), ("too_long", n > max_chars, -3), ("too_short", n <= 2, -4),
        ("much_larger", step == 0, 5), ("larger", step == 1, 4), ("slightly_larger", step == 2, 2.5), ("body_size_bold_numbered", step == 3, 1), ("smaller_than_body", step == 4, -2),
        ("bold", bold, 2), ("numbered", numbered, 3), ("arabic_dot_style", style == "arabic_dot", 1), ("arabic_paren_style", paren, 2),
        ("paren_body_like", paren & ~(bold | (diff >= 0.8) | room), -0.8), ("decimal_numbered", decimal, 1),
        ("decimal_no_space_before", decimal & (F.col("prev_gap") < F.greatest(s * 0.25, F.lit(4.0))) & (F.col("rel_y0") > 0.15), -1.5),
        ("long_decimal_nonbold", decimal & (n >= 40) & ~bold, -1), ("major_label", F.col("_label"), 3),
        ("upper_large", (F.col("rel_y0") < 0.35) & (diff >= 1.2), 1), ("space_before", room, 1), ("space_after", F.col("next_gap") >= F.greatest(s * 0.45, F.lit(4.0)), 0.5),
        ("centered", centred & (diff >= 2) & (n <= 80), 0.8), ("sentence_like", sentence, -3), ("bullet_like", t.rlike(r"^[•\-–—*]\s+"), -1.5),
    ]
    total = sum((F.when(F.coalesce(c, F.lit(False)), F.lit(float(v))).otherwise(0.0) for _, c, v in rules), F.lit(0.0))
    why = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c, _ in rules]))
    veto = F.when(F.col("_bad"), "bad_heading_text").when(F.col("_noise"), "noise")
    if not captions:
        veto = F.coalesce(veto, F.when(F.col("_caption"), "caption"))
    lines = settled(lines, {"_veto": veto, "_why": why, "_total": F.bround(total, 2)})
    scored = F.when(F.col("_veto") == "caption", -20.0).when(F.col("_veto").isNotNull(), -99.0).otherwise(F.col("_total"))
    return lines.select(*names, scored.alias("score"), F.when(F.col("_veto").isNotNull(), F.array("_veto")).otherwise(F.col("_why")).alias("reasons"))


def candidates(scored: DataFrame, least: float = 7.5) -> DataFrame:
    """The best line of each page and title key with at least that score: by score, size, then height."""
    w = Window.partitionBy("doc_id", "page", "_key").orderBy(F.desc("score"), F.desc("s"), "y0", "line_index")
    best = scored.where(F.col("score") >= least).withColumn("_key", norm_key("text")).withColumn("_n", F.row_number().over(w))
    return best.where("_n = 1").drop("_n", "_key")
