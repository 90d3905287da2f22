"""Steps whose work must grow no faster than their input: told by plans and by counts, not by clocks."""

from pyspark.sql import functions as F

from quire.functions.predicates import is_bad_heading, is_noise
from quire.functions.text import clean_text
from quire.operators import attach, chunks, jobs, review, toc


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_outlines_are_one_pass(spark):
    d = spark.createDataFrame([(1, 1, 1, 10), (1, 2, 2, 20), (1, 3, 2, 30), (1, 4, 1, 40), (2, 1, 3, 5), (None, 1, 1, 7)], "doc_id long, pos int, level int, page int")
    o = toc.outline(d, F.lit(99))
    assert "FlatMapGroupsInPandas" not in plan(o) and " Join " not in plan(o)
    got = {(r.doc_id, r.pos): (r.end_page, r.parent_pos, r.path) for r in o.collect()}
    assert got == {(1, 1): (40, None, []), (1, 2): (30, 1, [1]), (1, 3): (40, 1, [1]), (1, 4): (99, None, []), (2, 1): (99, None, []), (None, 1): (99, None, [])}


def joined(df):
    """The most rows that a join of df makes when it is run, and df's rows."""
    rows = df.collect()
    found = [0]

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if "Join" in name and node.metrics().contains("numOutputRows"):
            found.append(node.metrics().apply("numOutputRows").value())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return max(found), rows


def test_files_of_one_name_meet_once(spark):
    docs = spark.range(300).select(F.lit("Big book").alias("stem"), F.concat(F.lit("/in/"), F.lpad("id", 4, "0")).alias("path"))
    sources = spark.range(300).select(F.concat(F.lit("/out/"), F.col("id")).alias("path"), F.array(F.lit("big_book_toc.json")).alias("names"))
    most, rows = joined(jobs.match_documents(sources, docs))
    assert len(rows) == 300 and {r.doc_path for r in rows} == {"/in/0299"}
    assert most <= 600


def test_runs_of_many_chunks_meet_once(spark):
    text = lambda *c: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in c])
    n, none = F.col("id"), F.lit(None).cast("string")
    refs = spark.range(200).select(text("/r/", n).alias("path"), none.alias("source_input"), F.lit("book").alias("title"), F.when(n % 2 == 0, "run1").alias("run"))
    chunks = spark.range(200).select(text("/c/", n).alias("path"), F.lpad("id", 4, "0").alias("name"), F.lit(1).alias("modified"), F.lit("run1").alias("run"), F.lit("/in/book.pdf").alias("source_pdf"))
    parsed = spark.range(200).select(text("/p/", n).alias("path"), text("book", F.lpad("id", 4, "0"), "_parsed.txt").alias("name"), F.lit(1).alias("modified"), none.alias("run"))
    most, rows = joined(jobs.resolve(refs, chunks, parsed))
    assert len(rows) == 200 and {(r.chunk, r.parsed) for r in rows} == {("/c/199", "/p/199")}
    assert most <= 400


def test_long_pages_stay_whole(spark):
    page = "word " * 20_000
    d = spark.createDataFrame([(1, 1, "a"), (1, 2, page), (1, 3, "b")], "doc_id long, page int, text string")
    whole = sorted(chunks.char_chunks(d, 64_000, least=1, whole=True).collect(), key=lambda r: r.chunk)
    assert [(r.start_page, r.end_page, r.text) for r in whole] == [(1, 1, "[PAGE 1]\na"), (2, 2, "[PAGE 2]\n" + page), (3, 3, "[PAGE 3]\nb")]
    assert all(len(r.text) <= 64_000 for r in chunks.char_chunks(d, 64_000, least=1).collect())
    text = spark.createDataFrame([(1, 7, 1, 9, "\n\n".join(r.text for r in whole))], "doc_id long, chunk int, start_page int, end_page int, text string")
    assert [r.text for r in chunks.resplit(text, 64_000, least=1, whole=True).collect()] == [r.text.strip() for r in whole]


def patterns(df):
    """How often the plan of df replaces by a pattern or a table of characters."""
    text = plan(df)
    return text.count("regexp_replace(") + text.count("translate(")


def test_a_line_is_cleaned_once(spark):
    d = spark.createDataFrame([(1, "1. 서론"), (2, "1) 1960"), (3, "a  b c\x00")], "doc_id long, text string")
    t = F.col("text")
    assert patterns(d.select(is_bad_heading(t).alias("x"))) <= 15
    assert patterns(d.select(is_noise(t).alias("x"))) <= 15
    assert [r.x for r in d.select(clean_text("text").alias("x")).collect()] == ["1. 서론", "1) 1960", "a b c"]


def test_filters_do_not_copy_keys(spark):
    d = spark.createDataFrame([(1, 1, 1, "A title", 1, "A title", 5.0, 300.0, 14.0, 1.4)], "doc_id long, pos int, level int, chapter string, page int, layout_text string, x double, y double, font_size double, size_ratio double")
    long = F.when(F.col("pos") % 2 == 0, F.concat("chapter", F.lit("!"))).when(F.col("pos") % 3 == 0, F.upper(clean_text("chapter"))).otherwise(clean_text("chapter"))
    assert patterns(review.styled_entries(d.withColumn("chapter", long))) <= 40
    lines = d.select("doc_id", "page", F.lit(0).alias("line_index"), F.lit(1).alias("source_order"), F.col("font_size").alias("s"), F.col("size_ratio").alias("r"), "x", "y", F.lit(0).alias("b"), F.lit(0).alias("i"), F.lit("f1").alias("f"), F.col("chapter").alias("text"))
    best = attach.best_layout(d, lines)
    assert patterns(best) <= 12
    assert [(r.match_score, r.layout_text) for r in best.collect()] == [(570.0, "A title")]
