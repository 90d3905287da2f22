import json

import pytest
from pyspark.sql import functions as F

from quire.sources import results


def test_run_records(spark, tmp_path):
    def put(name, o):
        (tmp_path / name).write_text(o if isinstance(o, str) else json.dumps(o), encoding="utf-8")

    put("a_toc.json", {"title": "A", "chapters": [], "_meta": {"source_pdf": "/in/A.pdf", "provider": "gemma", "model": "m", "elapsed_seconds": 1.5}})
    put("b_toc.json", {"title": "B", "_meta": {"source_file": "C:\\x\\B.PDF", "provider": " claude ", "model": "n", "elapsed_seconds": "2"}})
    put("c_toc.json", {"title": "C"})
    put("d_toc.json", {"_meta": {"provider": "p", "elapsed_seconds": 1}})
    put("e_toc.json", {"_meta": {"source_pdf": "e", "elapsed_seconds": 1}})
    put("f_toc.json", {"_meta": {"source_pdf": "f", "provider": "p", "elapsed_seconds": "soon"}})
    put("g_toc.json", "no json")
    put("other.json", {"_meta": {"source_pdf": "x", "provider": "p", "elapsed_seconds": 1}})
    good, bad = results.run_records(spark, str(tmp_path))
    assert sorted((r.source, r.provider, r.elapsed_seconds) for r in good.collect()) == [("A.pdf", "gemma", 1.5), ("B.PDF", "claude", 2.0)]
    assert sorted((r.path[-10:], r.reason) for r in bad.collect()) == [("c_toc.json", "no _meta"), ("d_toc.json", "no source"), ("e_toc.json", "no provider"), ("f_toc.json", "no seconds"), ("g_toc.json", "no _meta")]
    (tmp_path / "in").mkdir()
    none = spark.createDataFrame([], "name string")
    assert results.of_inputs(good, none).count() == 2
    (tmp_path / "in" / "b.PDF").write_bytes(b"x")
    names = results.input_names(spark, str(tmp_path / "in"))
    assert [r.source for r in results.of_inputs(good, names).collect()] == ["B.PDF"] and results.of_inputs(good, names, everything=True).count() == 2


def test_strict_objects_and_pairs(spark, tmp_path):
    (tmp_path / "ok.json").write_text('{"source_pdf": "s", "chunk": "1",\n "start_page": 1, "end_page": 2, "text": "t"}')
    (tmp_path / "p.txt").write_text("[PAGE 1]\nx")
    r = results.pair(spark, str(tmp_path / "ok.json"), str(tmp_path / "p.txt")).first()
    assert (r.source_pdf, r.chunk_text, r.parsed_text) == ("s", "t", "[PAGE 1]\nx")
    (tmp_path / "bad.json").write_text('{"start_page": "one"')
    with pytest.raises(Exception, match="(?i)malformed|failfast|parse"):
        results.read_objects(spark, str(tmp_path / "bad.json"), "start_page int").collect()


def test_made_once(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(len(made)).select(F.col("id").alias("x"))

    path = str(tmp_path / "t")
    assert [results.made_once(spark, path, make).count(), results.made_once(spark, path, make).count(), results.made_once(spark, path, make, again=True).count()] == [1, 1, 2]
