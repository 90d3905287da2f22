"""Quality rules with thresholds that follow the data.

Each document gets counts; each rate's distribution per language and source is kept as a mergeable
quantile sketch: a log-linear histogram (16 bins per power of two, so 1/16 relative error), whose
merge is a sum of counts. Sketches of small groups are replaced by the merge over their language,
or over all. A rate fails above median + max(SPREADS * interquartile range, the rate's least spread):
a document is judged by what is usual where it comes from. Nothing here leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, let, strip, text_of, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Rates are integers in 1/SCALE.
SCALE = 10_000
#: Rate: least spread, so that a group of near-equal documents doesn't fail ordinary ones.
RATES = {"symbol_rate": 2_500, "bang_rate": 5_000, "repeat_rate": 2_000, "dup_rate": 4_000}
SPREADS = 6
#: Groups of fewer documents take the sketch of their language, or of all.
LEAST_GROUP = 100
#: Up to so many groups (each under 100 bytes) thresholds are broadcast; beyond, a join shuffles.
BROADCAST_GROUPS = 50_000


def windows_of(words: Column) -> Column:
    """Hash of each 5-word window, from the words' hashes."""
    at = lambda w, i, k: F.element_at(w, (i + k).cast("int"))
    hashes = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(*[at(w, i, k) for k in range(WINDOW)]))
    return F.when(F.size(words) >= WINDOW, let(F.transform(words, lambda w: F.xxhash64(w)), hashes)).otherwise(F.array().cast("array<bigint>"))


def covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: by sorting, so near-linear in any text."""

    def positions(s: Column) -> Column:
        none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
        sides = F.arrays_zip(s.alias("s"), F.concat(none, s).alias("p"), F.concat(F.slice(s, 2, F.size(s)), none).alias("n"))
        twins = F.filter(sides, lambda z: z["s"].isNotNull() & (F.coalesce(z["s"]["h"] == z["p"]["h"], F.lit(False)) | F.coalesce(z["s"]["h"] == z["n"]["h"], F.lit(False))))
        return F.sort_array(F.transform(twins, lambda z: z["s"]["i"]))

    def total(at: Column) -> Column:
        steps = F.zip_with(at, F.slice(at, 2, F.size(at)), lambda a, b: F.coalesce(F.least(F.lit(WINDOW), b - a), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda n, x: n + x)

    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(ranked, positions), total)


def counts(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_bangs, n_lines; and keep."""
    text = text_of()
    has = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    lines = F.filter(F.split("t", "\n"), lambda x: strip(x) != "")
    d = docs.select("doc_id", *has, *keep, text.alias("t"))
    d = d.select("doc_id", "lang", "source", *keep, "t", words_of(F.col("t")).alias("w"), lines.alias("l"))
    d = d.select(
        "doc_id", "lang", "source", *keep,
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        (F.octet_length("t") - F.octet_length(F.replace("t", F.lit("!"), F.lit("")))).cast("long").alias("n_bangs"),
        F.size("l").cast("long").alias("n_text_lines"),
        windows_of(F.col("w")).alias("h"),
    )
    repeats = F.when(F.size(F.array_distinct("h")) < F.size("h"), covered(F.col("h"))).otherwise(F.lit(0))
    return d.withColumn("n_repeat_words", repeats.cast("long")).drop("h")


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    d = counts(docs, *keep)
    per = lambda a, b: F.when(F.col(b) > 0, F.expr(f"{SCALE} * {a} div {b}")).otherwise(F.lit(0)).cast("long")
    return d.withColumns({
        "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
        "symbol_rate": per("n_symbols", "n_words"),
        "bang_rate": per("n_bangs", "n_words"),
        "repeat_rate": per("n_repeat_words", "n_words"),
        "dup_rate": per("n_dup_lines", "n_text_lines"),
    })


def bin_of(v: Column) -> Column:
    """Log-linear bin: the value itself below 32, then 16 bins per power of two."""
    shift = F.greatest(F.char_length(F.bin(v)) - 5, F.lit(0))
    return (16 * shift + F.call_function("shiftright", v, shift)).cast("int")


def low_of(b: Column) -> Column:
    """The least value of a bin."""
    shift = F.greatest((b / 16).cast("int") - 1, F.lit(0))
    return F.call_function("shiftleft", (b - 16 * shift).cast("long"), shift)


def sketches(m: DataFrame) -> DataFrame:
    """(lang, source, rate, bin, n): the sketch of each group and rate over documents that pass the base rules."""
    rates = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), F.col(r).alias("v")) for r in RATES]))
    return m.where("not base_failed").select("lang", "source", rates.alias("x")).groupBy("lang", "source", F.col("x.rate").alias("rate"), bin_of(F.col("x.v")).alias("bin")).agg(F.count("*").alias("n"))


def quantiles(s: DataFrame, *group: str) -> DataFrame:
    """Per group and rate: q25, q50, q75 (bins' least values) and n. Rows of a group: its bins, a few hundred at most."""
    from pyspark.sql import Window

    by = Window.partitionBy(*group, "rate")
    at = lambda q: F.min(F.when(F.col("upto") * 100 >= q * F.col("total"), F.col("bin")))
    s = s.groupBy(*group, "rate", "bin").agg(F.sum("n").alias("n"))
    s = s.withColumns({"upto": F.sum("n").over(by.orderBy("bin")), "total": F.sum("n").over(by)})
    s = s.groupBy(*group, "rate").agg(F.max("total").alias("n"), *[low_of(at(q)).alias(f"q{q}") for q in (25, 50, 75)])
    least = F.create_map(*[F.lit(x) for kv in RATES.items() for x in kv])[F.col("rate")]
    return s.withColumn("fence", F.col("q50") + F.greatest(SPREADS * (F.col("q75") - F.col("q25")), least))


def thresholds(ws: Workspace, m: DataFrame) -> DataFrame:
    """One row per (lang, source): a fence per rate. Groups without documents that pass the base rules have none."""
    s = ws.write(sketches(m), "sketches")
    wide = lambda q, group, to: q.groupBy(*group).agg(F.max("n").alias(f"{to}_n"), *[F.max(F.when(F.col("rate") == r, F.col("fence"))).alias(f"{to}_{r}") for r in RATES])
    own = wide(quantiles(s, "lang", "source"), ["lang", "source"], "own")
    lang = wide(quantiles(s, "lang"), ["lang"], "lang")
    every = wide(quantiles(s), [], "all")
    pick = lambda r: F.when(F.col("own_n") >= LEAST_GROUP, F.col(f"own_{r}")).when(F.col("lang_n") >= LEAST_GROUP, F.col(f"lang_{r}")).otherwise(F.col(f"all_{r}"))
    joined = own.join(lang, "lang").join(F.broadcast(every), how="left", on=F.lit(True))  # every: one row
    return ws.write(joined.select("lang", "source", *[pick(r).alias(f"max_{r}") for r in RATES]), "thresholds")


def with_verdict(ws: Workspace, m: DataFrame) -> DataFrame:
    t = thresholds(ws, m)
    small = t.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    m = m.join(F.broadcast(t) if small else t, ["lang", "source"], "left")
    fine = F.lit(True)
    for r in RATES:
        fine = fine & F.coalesce(F.col(r) <= F.col(f"max_{r}"), F.lit(True))
    return m.withColumn("kept", ~F.col("base_failed") & fine)


def quality_rules(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text, lang, source; others are ignored): counts, rates, fences, base_failed and kept.

    Null text: no words, so base_failed. Null lang or source counts as ''. Empty text and very long texts
    need nothing special; repeated rows each count; a rate equal to its fence passes; an empty table
    gives an empty result; a group in which all fail the base rules has no fence to miss.
    """
    ws = Workspace(spark)
    return with_verdict(ws, ws.write(measured(docs), "measured"))


def quality_filter(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns."""
    ws = Workspace(spark)
    # Counted once, beside the row: the text is written with its rates instead of being counted or moved again.
    row = docs.select("doc_id", "text", "lang", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    return with_verdict(ws, ws.write(measured(row, "whole"), "measured")).where("kept").select("whole.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    per = lambda a, b, name: f"CASE WHEN {b} > 0 THEN {SCALE} * {a} // {b} ELSE 0 END AS {name}"
    rates = ", ".join(per(*x) for x in (("n_symbols", "n_words", "symbol_rate"), ("n_bangs", "n_words", "bang_rate"), ("n_repeat_words", "n_words", "repeat_rate"), ("n_dup_lines", "n_text_lines", "dup_rate")))
    least = "CASE rate " + " ".join(f"WHEN '{r}' THEN {v}" for r, v in RATES.items()) + " END"
    low = lambda b: f"CAST(({b} - 16 * greatest({b} // 16 - 1, 0)) AS BIGINT) << greatest({b} // 16 - 1, 0)::INT"

    def level(name: str, group: list[str]) -> str:
        g = "".join(f"{x}, " for x in group)
        return f"""
{name}_c AS (SELECT {g}rate, bin, sum(n) AS n FROM sketch GROUP BY {g}rate, bin),
{name}_u AS (SELECT *, sum(n) OVER (PARTITION BY {g}rate ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {g}rate) AS total FROM {name}_c),
{name}_b AS (SELECT {g}rate, max(total) AS n, {", ".join(f"min(bin) FILTER (upto * 100 >= {q} * total) AS b{q}" for q in (25, 50, 75))} FROM {name}_u GROUP BY {g}rate),
{name}_q AS (SELECT {g}rate, n, {", ".join(f"{low(f'b{q}')} AS q{q}" for q in (25, 50, 75))} FROM {name}_b),
{name}_f AS (SELECT {g}rate, n, q50 + greatest({SPREADS} * (q75 - q25), {least}) AS fence FROM {name}_q),
{name} AS (SELECT {g}max(n) AS {name}_n, {", ".join(f"max(fence) FILTER (rate = '{r}') AS {name}_{r}" for r in RATES)} FROM {name}_f {"GROUP BY " + ", ".join(group) if group else ""})"""

    return rf"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents
), win AS (
  SELECT doc_id, i, w[i:i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM docs)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1
), cover AS (
  SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat_words FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM again) GROUP BY doc_id
), counted AS (
  SELECT doc_id, lang, source, len(w) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs,
    len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_text_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN cover USING (doc_id)
), m AS (
  SELECT *, {rates}, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
), flat AS (
  {" UNION ALL ".join(f"SELECT lang, source, '{r}' AS rate, {r} AS v FROM m WHERE NOT base_failed" for r in RATES)}
), sketch AS (
  SELECT lang, source, rate, 16 * greatest(length(bin(v)) - 5, 0) + (v >> greatest(length(bin(v)) - 5, 0)::INT) AS bin, count(*) AS n FROM flat GROUP BY ALL
), {level("own", ["lang", "source"])}, {level("langs", ["lang"])}, {level("every", [])},
fences AS (
  SELECT o.lang, o.source, {", ".join(f"CASE WHEN own_n >= {LEAST_GROUP} THEN own_{r} WHEN langs_n >= {LEAST_GROUP} THEN langs_{r} ELSE every_{r} END AS max_{r}" for r in RATES)}
  FROM own o JOIN langs USING (lang) CROSS JOIN every
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(f"coalesce({r} <= max_{r}, true)" for r in RATES)} AS kept
FROM m LEFT JOIN fences USING (lang, source)
"""


SQL = _sql()
