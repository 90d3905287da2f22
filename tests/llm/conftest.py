import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    return SF


#: Nulls, empty and blank texts, a repeated row, ties, a long text, an id that is null, columns whose names clash.
EDGE = [
    (5, "the same line here\nother words stand there", "en", "s"), (1, "the same line here\nunlike", "en", "s"), (1, "the same line here\nunlike", "en", "s"), (2, None, None, None), (3, "", "en", "s"),
    (4, " \t\n ", "en", "s"), (6, "THE SAME LINE HERE  \nshort\nshort", "de", "s"), (None, "the same line here", "en", "s"), (7, "word " * 30_000, "en", "t"), (8, "ünïcödé — ☃ 𝄞 text of some words more", "fr", "s"),
    (9, " ".join(f"w{i}" for i in range(400)), "en", "s"), (10, " ".join(f"w{i}" for i in range(396)) + " a b c d", "en", "s"),
]


@pytest.fixture(scope="session")
def edge(spark):
    from pyspark.sql import functions as F

    d = spark.createDataFrame(EDGE, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.char_length("text").cast("long"))
    return d.withColumns({c: F.lit("clash") for c in ("id", "row", "lines", "kept", "n_words", "topic", "data", "h1")})


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where("false")


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
