import pytest
from pyspark.sql import functions as F

from quire.functions import jsonx
from quire.functions import numbers as N
from quire.functions import predicates as P
from quire.functions import text as T
from quire.functions.numbering import decimal_path, number_info


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(("f", "value", "want"), [
    (T.clean_text, None, ""), (T.clean_text, " a ​ b\x07\n c ", "a b c"), (T.norm, "A – b — c", "A-b-c"), (T.norm_key, "1. Ab-C (d)", "1abcd"),
    (T.header_footer_key, "Page 12 - Intro", "pageintro"), (T.duplicate_title_key, "12 | Some long title 34", "somelongtitle"), (T.token_shape, "제12장.b", "A#A.A"),
    (T.font_bold, "ABC+Times-Bold", 1), (T.font_italic, "Oblique", 1), (T.safe_name, "..a b/c", "a_b_c"), (T.safe_name, "??", "model"), (T.nfkc, "ﬁ①", "fi1"), (T.document_key, "Ａb-1 제.pdf", "ab1제pdf"),
    (P.is_marker_only, "Chapter 3a", True), (P.is_marker_only, "Chapter three", False), (P.has_structural_marker, "1.2 Scope", True), (P.has_structural_marker, "Scope 1.2", False),
    (P.is_toc_listing, "Intro ..... 7", True), (P.is_toc_listing, "7", False), (P.is_visual_caption, "Figure 3. x", True), (P.is_page_marker, "- 12 -", True), (P.is_page_marker, "index", False),
    (P.is_reference_heading, "[References]", True), (P.is_reference_item, "1. Kasl", True), (P.is_formula_or_corrupt, "a = b", True), (P.is_noise, "www.x.y", True), (P.is_noise, "1.", False),
    (P.is_bad_heading, "1) 1960", True), (P.is_bad_heading, "Methods and results", False), (P.is_number_prefix_only, "(1)", True),
])
def test_text_and_predicates(spark, f, value, want):
    assert one(spark, value, f) == want


@pytest.mark.parametrize(("t", "want"), [
    ("제3장 개요", ("ko_chapter", 3, "제3장", "개요", 2)), ("1.2.3 Scope", ("arabic_decimal_2", 3, "1.2.3", "Scope", 5)), ("7. Scope", ("arabic_dot", 7, "7.", "Scope", 3)),
    ("(2) a", ("arabic_paren_wrap", 2, "(2)", "a", None)), ("2) a", ("arabic_paren", 2, "2)", "a", None)), ("12 a", ("bare_number", 12, "12", "a", None)), ("Scope", (None,) * 5), ("", (None,) * 5),
])
def test_number_info(spark, t, want):
    assert tuple(one(spark, t, number_info)) == want


def test_paths_and_distances(spark):
    assert one(spark, "1.2.10. x", decimal_path) == [1, 2, 10] and one(spark, "1 x", decimal_path) is None
    row = {"font_size": F.lit(12.0), "size_ratio": F.lit(1.2), "left_indent": F.lit(None), "bold": F.lit(1), "italic": F.lit(0), "font_id": F.lit("f1")}
    other = row | {"font_size": F.lit(10.0), "bold": F.lit(0)}
    assert one(spark, "", lambda _: N.style_distance(row, other)) == 4.0
    assert one(spark, "", lambda _: N.style_distance({k: F.lit(None) for k in row}, other)) == 9999.0
    same = one(spark, "", lambda _: N.title_line_score(F.lit("Intro"), F.lit("intro"), F.lit(20.0), F.lit(2.0), F.lit(300.0)))
    assert same == 300 + 60 + 40 + 200
    assert one(spark, "", lambda _: N.title_line_score(F.lit("Intro"), F.lit("zzz"), F.lit(20.0), F.lit(2.0), F.lit(300.0))) is None


@pytest.mark.parametrize("t", [
    'x ```json\n{"a": 1, "b": ["c"]}\n``` y', '{a: 1, b: ["c"]}', '{"a": 1 "b": ["c"]}', '{"a": 1, "b": ["c",],}', '{"a": 1, "b": ["c"', 'So: {"a": 1, "b": ["c"]} ok',
])
def test_json_ladder(t):
    assert jsonx.parsed(t) == {"a": 1, "b": ["c"]}


def test_json_quotes_and_loose():
    assert jsonx.parsed('{"chapter": "the "big" one"}') == {"chapter": 'the "big" one'}
    assert jsonx.parsed("nothing") is None and jsonx.parsed(None) is None
    assert jsonx.loose_entries('[{"level": 1, "chapter": "a", x}') == {"chapters": [{"level": 1, "chapter": "a"}]}
