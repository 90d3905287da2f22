import http.server
import json
import logging
import threading

import pytest
from pyspark.sql import functions as F

from quire import sinks
from quire.operators import attach, chunks, fragments, lines, models, toc
from quire.session import ship
from quire.sources import layout
from quire.streaming import ingest


def test_layout_grammars(spark):
    text = "ignored\n[L s=9 r=1] before\n[PAGE 2]\n[L s=12.0 r=1.20 x=72 y=60 b=1 i=0 f=f1 c=L] Title\n[L s=x] \n[L s=9.0 r=0.90 x=72 y=80 b=0 i=0 f=f2] body\n[PAGE P=3 W=1 H=1 BODY=9]\n[L P=3 O=7 S=10 R=1 X=1 Y=2 B=0 I=1 F=f3] Up"
    got = layout.parse_layout(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("line_index").collect()
    assert [(r.page, r.source_order, r.s, r.b, r.f, r.column, r.text) for r in got] == [(2, 1, 12.0, 1, "f1", "L", "Title"), (2, 3, 9.0, 0, "f2", None, "body"), (3, 7, 10.0, 0, "f3", None, "Up")]


def test_layout_files(spark, tmp_path):
    from quire.plans import pipelines

    (tmp_path / "a.txt").write_text("[PAGE 1]\n[L s=12.0 r=1.20 x=72 y=60 b=1 i=0 f=f1] Title", encoding="utf-8")
    assert [(r.doc_id, r.page, r.text) for r in pipelines.layout_lines_of(spark, str(tmp_path)).collect()] == [("a.txt", 1, "Title")]


def test_headers_and_bounds(spark):
    rows = [(1, p * 10 + k, p, k, k / 10, (k + 1) / 10, "Head line" if k == 0 else f"- {p} -" if k == 9 else f"text {chr(97 + p)}{chr(97 + k)}") for p in (1, 2, 3) for k in range(10)]
    d = spark.createDataFrame(rows, "doc_id long, line_index int, page int, source_order int, rel_y0 double, rel_y1 double, text string")
    kept = lines.remove_headers_footers(d)
    assert kept.count() == 24 and kept.where("text like 'Head%' or text like '-%'").count() == 0
    extra = spark.createDataFrame([(2, 1, 1, 1, 0.5, 0.6, "목차"), (2, 2, 2, 1, 0.5, 0.6, "제1장 시작"), (2, 3, 3, 1, 0.5, 0.6, "찾아보기")], d.schema)
    assert [r.line_index for r in lines.trim_front_back(extra).collect()] == [2]


def test_chunk_folds():
    pages = [(p, "x" * 6000) for p in range(1, 5)]
    assert [(a, b) for a, b, _ in chunks.pack_pages(pages, 10_000)] == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert [(a, b) for a, b, _ in chunks.pack_pages([(p, "y" * 3000) for p in range(1, 5)], 10_000)] == [(1, 3), (4, 4)]
    parts = chunks.split_page(1, "\n".join("z" * 99 for _ in range(300)), 10_000)
    assert all(len(x) <= 10_000 and x.startswith("[PAGE 1]\n") for x in parts) and sum(x.count("z") for x in parts) == 29_700
    assert [x[:2] for x in chunks.pack_tokens([(p, "w" * 220) for p in range(1, 6)], 210)] == [(1, 2), (3, 4), (5, 5)]
    assert [x[:4] for x in chunks.pack_tokens([(p, "w" * 220) for p in range(1, 6)], 400, 1)] == [(1, 3, 1, 4), (4, 5, 3, 5)]
    assert chunks.pack_pages([], 1) == [] and chunks.pack_pages([(1, "  \n ")], 1) == []
    over = chunks.pack_pages([(p, "y" * 3000) for p in range(1, 6)], 10_000, 3500)
    assert over[0][:2] == (1, 3) and over[1][0] == 3
    again = chunks.split_again("\n\n".join(f"[PAGE {p}]\n" + "v" * 2000 for p in range(3, 8)), 4_100, 1, 9, 1)
    assert [(a, b) for a, b, _ in again] == [(3, 4), (5, 6), (7, 7)] and chunks.split_again("no page", 10, 1, 9, 1) == [(1, 9, "no page")]
    assert chunks.token_limit(0, 8000, 2000, 500, 300) == 5200 and chunks.token_limit(700, 1, 1, 1, 1) == 700 and chunks.token_limit(0, 10, 10, 10, 10) == 1000


def test_toc_levels(spark):
    rows = [(1, 0, 1, "a", 1), (1, 1, 4, "b", 1), (1, 2, 4, "c", 2), (1, 3, 9, "d", 3), (1, 4, 2, "e", 3)]
    t = spark.createDataFrame(rows, "doc_id long, pos long, level int, chapter string, page int")
    ship(spark)
    assert [r.level for r in fragments.limit_jumps(t, 9).orderBy("pos").collect()] == [1, 2, 3, 4, 2]
    assert [(r.parent_pos, r.path) for r in toc.ancestors(t).orderBy("pos").collect()] == [(None, []), (0, [0]), (0, [0]), (2, [0, 2]), (0, [0])]
    assert [r.end_page for r in toc.section_ends(t, F.lit(9)).orderBy("pos").collect()] == [9, 2, 3, 3, 9]
    assert toc.level_groups(5, 3) == [(1, 3), (3, 5)] and toc.level_groups(2) == [(1, 2)]
    raw = spark.createDataFrame([(1, 0, "x", " ", "1"), (1, 1, "9", "B", "z"), (1, 2, "2", "b ", "1")], "doc_id long, pos long, level string, chapter string, page string")
    assert toc.validate(raw, 6).collect()[0].asDict() == {"doc_id": 1, "pos": 1, "level": 6, "chapter": "B", "page": 1}
    wide = toc.numbering_gaps(spark.createDataFrame([(1, 0, "1.1 a"), (1, 1, "1.2000000000 b")], "doc_id long, pos long, chapter string"))
    assert [(r.first, r.last) for r in wide.collect()] == [(2, 1_999_999_999)] and toc.missing_numbers(wide).count() == 20


def test_many_headings_are_linear(spark):
    t = spark.range(30_000).select(F.lit(1).cast("long").alias("doc_id"), F.col("id").alias("pos"), (F.col("id") % 7 + 1).cast("int").alias("level"), F.col("id").alias("page"))
    ends = toc.section_ends(t, F.lit(40_000))
    assert ends.where("end_page < 40000").count() + ends.where("end_page = 40000").count() == 30_000 and ends.where("level = 1 and end_page < 40000").count() == 4_285


def test_joined_parts(spark):
    d = spark.createDataFrame([(["1) 1960", "년대 의료"],), (["보건과", "의료"],), (["a ", "", "b"],), ([],)], "p array<string>")
    assert [r.x for r in d.select(fragments.join_parts(F.col("p")).alias("x")).collect()] == ["1) 1960년대의료", "보건과의료", "a b", ""]


def test_better_layouts(spark):
    s = spark.createDataFrame([(10.0, 16.0), (10.0, 15.0), (None, 1.0), (10.0, None), (None, None)], "a double, b double")
    assert [r.x for r in s.select(attach.is_better(F.col("a"), F.col("b")).alias("x")).collect()] == [True, False, True, False, False]


def test_models(spark):
    class Flaky:
        def complete(self, prompt):
            if len(prompt) > 4000:
                raise RuntimeError("503 unavailable")
            return '{"n": 1}'

    ship(spark)
    d = spark.createDataFrame([(1, "1", "line\n" * 1500), (2, "1", "short")], "doc_id long, chunk string, text string")
    got = {(r.doc_id, r.chunk): r.error for r in models.ask(d, Flaky, tries=1).collect()}
    assert set(got.values()) == {None} and len(got) > 2
    calls = []
    with pytest.raises(RuntimeError):
        models.with_retry(lambda: calls.append(1) or (_ for _ in ()).throw(RuntimeError("429")), 3, 0, lambda s: None)
    assert len(calls) == 3 and models.provider_name(" Open-AI ") == "openai" and models.providers("all") == list(models.PROVIDERS)
    with pytest.raises(ValueError):
        models.provider_name("other")


class Server(http.server.BaseHTTPRequestHandler):
    """A chat server for tests: bad JSON first, an error for one model, a cut answer for another."""

    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Server.seen.append(body)
        if body["model"] == "down":
            self.send_response(503)
            self.end_headers()
            return
        text = body["messages"][1]["content"]
        content = "no object" if "again" not in text and "no valid JSON" not in text else [{"text": '{"chapters": [{"level": 1, "chapter": "A", "page": 1}]}'}]
        reply = {"choices": [{"message": {"content": content}, "finish_reason": "length" if body["model"] == "cut" else "stop"}], "usage": {"prompt_tokens": 3, "completion_tokens": 4, "total_tokens": 7}}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(reply).encode())

    def log_message(self, *a):
        pass


def test_chat_client_over_http():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        client = lambda m: models.ChatClient(f"http://127.0.0.1:{server.server_port}/v1", m, "key")
        good = client("good")
        found, _ = models.ask_json(good, "what")
        assert found["chapters"][0]["chapter"] == "A" and good.usage == {"prompt_tokens": 6, "completion_tokens": 8, "total_tokens": 14}
        assert models.ask_any([client("down"), client("good")], "again", 1)[2] == 1
        with pytest.raises(models.Truncated):
            models.ask_any([client("cut"), client("good")], "again")
        with pytest.raises(RuntimeError, match="HTTP 503"):
            client("down").complete("x")
    finally:
        server.shutdown()


def test_merges_and_reviews_by_model(spark):
    class Merger:
        def complete(self, prompt):
            if "lost" in prompt:
                return "nothing"
            return '{"title": "T", "chapters": [{"level": 1, "chapter": "One", "page": 1}, {"level": 2, "chapter": "Two", "page": "2"}]}'

    ship(spark)
    none = [f"cast(null as {k}) as {c}" for c, k in {"x": "double", "y": "double", "font_size": "double", "size_ratio": "double", "layout_text": "string", "layout_page": "int", "bold": "int", "italic": "int", "source_order": "int", "merge_order": "int", "level_reason": "string"}.items()]
    p = spark.createDataFrame([(d, c, k, 1, f"part {c} {k}", c) for d in (1, 2) for c in (1, 2) for k in (0, 1)], "doc_id long, chunk int, pos int, level int, chapter string, page int").selectExpr("*", *none)
    b = spark.createDataFrame([(1, 1, "[fine]"), (2, 1, "[lost]")], "doc_id long, batch int, json string")
    got = models.merged_or_local(models.merge_by_model(b, lambda: [Merger()], tries=1), p)
    assert sorted((r.doc_id, r.how, r.chapter) for r in got.collect()) == [(1, "model", "One"), (1, "model", "Two"), *[(2, "local", f"part {c} {k}") for c in (1, 2) for k in (0, 1)]]
    t = p.where("chunk = 1").drop("chunk")
    asked = spark.createDataFrame([(1, "1", 1, 1, "fine"), (2, "1", 1, 1, "lost")], "doc_id long, chunk string, start_page int, end_page int, text string")
    after = models.reviewed(t, models.ask_chunks(asked, lambda: [Merger()], tries=1))
    assert sorted((r.doc_id, r.chapter, r.level) for r in after.collect()) == [(1, "One", 1), (1, "Two", 2), (2, "part 1 0", 1), (2, "part 1 1", 1)]


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": 2}')], "doc_id long, json string")
    sinks.save(d, str(tmp_path / "out"), by="doc_id")
    assert sorted((r.doc_id, r.value) for r in spark.read.text(str(tmp_path / "out")).collect()) == [(1, '{"a": 1}'), (2, '{"a": 2}')]
    with pytest.raises(Exception, match="already exists"):
        sinks.save(d, str(tmp_path / "out"))
    log = sinks.RunLog(str(tmp_path / "logs" / "run.log"))
    sinks.LOG.addHandler(log)
    sinks.LOG.warning("one line")
    sinks.LOG.removeHandler(log)
    assert "WARNING one line" in (tmp_path / "logs" / "run.log").read_text() and logging.getLogger("quire") is sinks.LOG


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(1, "u", "<h1>A</h1><p>b")], "page_id long, url string, html string").write.parquet(str(src))
    q = ingest.start(ingest.style_counts(ingest.page_stream(spark, str(src))), "styles", str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert sorted(r["count"] for r in spark.table("styles").collect()) == [1, 1]


def test_catalogue(spark, tmp_path):
    (tmp_path / "A.PDF").write_bytes(b"x")
    (tmp_path / "b.txt").write_text("y")
    assert [r.stem for r in layout.catalogue(spark, str(tmp_path)).collect()] == ["A"]
