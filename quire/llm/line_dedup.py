"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches of rising doc_id. A batch's distinct line keys (128-bit hashes) are
merge-anti-joined with the runs that earlier batches left; keys found there lose all their lines in
the batch, keys that are new keep their lines in the batch's smallest doc_id and form a new run.
Runs are bucketed and sorted by key, so a batch meets them without shuffling them again. `fanout`
runs of one level are merged into one of the next, so few runs are ever open.

Hot lines: a batch's keys are combined before the shuffle, and the join that finds the lines to
drop is a plain sort-merge join, whose hot partitions Spark splits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LAST_ID, Workspace, ascii_lower, key128, shuffle_partitions, strip, text_of

KEYS = ["h1", "h2"]


class Runs:
    """The levelled runs: written tables of (h1, h2), bucketed and sorted by key; `close` deletes them."""

    def __init__(self, ws: Workspace, fanout: int):
        self.ws, self.spark, self.fanout = ws, ws.spark, fanout
        self.buckets = shuffle_partitions(ws.spark)
        self.levels: list[list[tuple[str, str]]] = []
        self.compactions = 0

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(t) for level in self.levels for t, _ in level]

    def save(self, df: DataFrame) -> tuple[str, str]:
        name, path = f"quire_run_{uuid.uuid4().hex}", self.ws.path("run")
        df.select(*KEYS).write.bucketBy(self.buckets, *KEYS).sortBy(*KEYS).option("path", path).saveAsTable(name)
        return name, path

    def add(self, df: DataFrame) -> None:
        self.place(0, self.save(df))

    def place(self, level: int, run: tuple[str, str]) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = self.spark.table(old[0][0])
            for name, _ in old[1:]:
                merged = merged.unionByName(self.spark.table(name))
            new = self.save(merged.repartition(self.buckets, *KEYS))
            for name, path in old:
                self.spark.sql(f"DROP TABLE {name}")
                self.ws.drop(path)
            self.compactions += 1
            self.place(level + 1, new)

    def close(self) -> None:
        for level in self.levels:
            for name, path in level:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
                self.ws.drop(path)


def keyed(docs: DataFrame, *keep: Column) -> DataFrame:
    """id: doc_id, a null one last; row: tells rows of one doc_id apart by their text."""
    text = text_of()
    return docs.select("doc_id", *keep, text.alias("text"), F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("row"))


def lines_of(rows: DataFrame, min_chars: int) -> DataFrame:
    """(id, row, pos, h1, h2) of each line whose key is long enough."""
    lines = rows.select("id", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    key = ascii_lower(strip(F.col("line")))
    h1, h2 = key128(F.col("key"))
    return lines.select("id", "row", "pos", key.alias("key")).where(F.char_length("key") >= min_chars).select("id", "row", "pos", h1.alias("h1"), h2.alias("h2"))


def bounds(docs: DataFrame, batches: int) -> list[int]:
    """Upper ids of the batches but the last."""
    if batches < 2:
        return []
    cuts = docs.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)])).first()[0]
    return sorted(set(cuts or []))


class LineIndex:
    """The lines of all batches so far. Each batch loses the lines that earlier ones have and adds its own as a run.

    Within a batch, lines stay in the smallest doc_id that holds them. Close it, or use it in a with
    statement: its runs are tables of the session's catalogue. Results stay readable after that.
    """

    def __init__(self, spark: SparkSession, *, min_chars: int = 10, fanout: int = 2):
        self.ws, self.min_chars = Workspace(spark), min_chars
        self.runs = Runs(self.ws, fanout)

    def __enter__(self) -> LineIndex:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def close(self) -> None:
        self.runs.close()

    def drop(self, lines: DataFrame) -> DataFrame:
        """(id, row, pos): the sorted positions of the lines that a batch's rows lose. lines: as lines_of gives them."""
        keys = lines.groupBy(*KEYS).agg(F.min("id").alias("first"), F.max("id").alias("last"))
        seen = F.lit(False)
        for i, run in enumerate(self.runs.tables()):
            keys = keys.join(run.withColumn(f"in{i}", F.lit(True)), KEYS, "left")
            seen = seen | F.coalesce(F.col(f"in{i}"), F.lit(False))
        keys = self.ws.write(keys.select(*KEYS, "first", "last", seen.alias("seen")), "keys")
        lost = keys.where("seen or first < last")
        gone = lines.join(lost, KEYS).where("seen or id > first").groupBy("id", "row").agg(F.array_sort(F.collect_set("pos")).alias("pos"))
        gone = self.ws.write(gone, "drops")
        self.runs.add(keys.where("not seen"))
        self.ws.done(keys)
        return gone

    def add(self, docs: DataFrame) -> DataFrame:
        """The next batch: what line_dedup returns, for docs against themselves and all batches before."""
        rows = keyed(docs)
        lines = self.ws.write(lines_of(rows, self.min_chars), "lines")
        gone = self.drop(lines)
        self.ws.done(lines)
        return assemble(rows, gone)


def line_dedup(spark: SparkSession, docs: DataFrame, *, min_chars: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """Per row of docs (columns doc_id, text; others are ignored): doc_id, n_lines, n_dropped, text.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at least
    min_chars code points that several documents hold lose their lines except in the smallest doc_id.

    Null or empty text: one empty line, kept. Ties: lines of one key in its smallest document all stay.
    Repeated rows: rows with equal doc_id are one document, each row is returned. A null doc_id counts
    as the largest. An empty table gives an empty result. Very long texts are split line by line.
    """
    rows = keyed(docs)
    return assemble(rows, dropped(spark, docs, rows, min_chars=min_chars, batches=batches, fanout=fanout))


def dedup_columns(spark: SparkSession, docs: DataFrame, *, min_chars: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """The rows of docs with all their columns, text (null stays null) and n_chars after line_dedup."""
    rows = keyed(docs, F.struct(*[F.col(c) for c in docs.columns]).alias("whole"))
    found = assemble(rows, dropped(spark, docs, rows, min_chars=min_chars, batches=batches, fanout=fanout), "whole")
    new = {"text": F.when(F.col("whole.text").isNotNull(), F.col("text")), "n_chars": F.when(F.col("whole.text").isNotNull(), F.char_length("text").cast("long"))}
    return found.select(*[(new[c] if c in new else F.col(f"whole.{c}")).alias(c) for c in docs.columns])


def dropped(spark: SparkSession, docs: DataFrame, rows: DataFrame, *, min_chars: int, batches: int, fanout: int) -> DataFrame:
    """(id, row, pos): the sorted positions of the lines that the rows (docs, keyed) lose."""
    with LineIndex(spark, min_chars=min_chars, fanout=fanout) as index:
        cuts = bounds(docs, batches)
        batch = F.lit(0)
        for c in cuts:
            batch = batch + (F.col("id") > c).cast("int")
        # Texts are read once; a batch then reads its own lines.
        lines = index.ws.write(lines_of(rows, min_chars).withColumn("batch", batch), "lines", by="batch")
        gone = [index.drop(lines.where(F.col("batch") == k).drop("batch")) for k in range(len(cuts) + 1)]
        index.ws.done(lines)
    out = gone[0]
    for g in gone[1:]:
        out = out.unionByName(g)
    return out


def assemble(rows: DataFrame, drops: DataFrame, *keep: str) -> DataFrame:
    """The rows' texts without the lines at drops.pos (sorted)."""
    joined = rows.join(drops.withColumnRenamed("pos", "gone"), ["id", "row"], "left").select(
        "doc_id", *keep, "text", F.coalesce("gone", F.array().cast("array<int>")).alias("gone"), F.split("text", "\n").alias("lines")
    )
    n = F.size("lines")
    # Flags from the gaps between dropped positions: linear in the number of lines.
    before = F.concat(F.array(F.lit(-1)), F.col("gone"))
    after = F.concat(F.col("gone"), F.array(n))
    gap = lambda a, b: F.concat(F.array_repeat(F.lit(True), b - a - 1), F.array(F.lit(False)))
    stays = F.flatten(F.zip_with(before, after, gap))
    kept = F.array_join(F.zip_with("lines", F.slice(stays, F.lit(1), n), lambda x, s: F.when(s, x)), "\n")  # skips nulls
    return joined.select(
        "doc_id",
        *keep,
        n.cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.when(F.size("gone") == 0, F.col("text")).otherwise(kept).alias("text"),
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, p AS pos, l[p] AS line FROM (
    SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS p FROM (
      SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), keyed AS (
  SELECT doc_id, pos, line,
    translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), firsts AS (
  SELECT k, min(doc_id) AS f FROM keyed WHERE length(k) >= 10 GROUP BY k
), marked AS (
  SELECT doc_id, pos, line, f IS NOT NULL AND doc_id > f AS gone FROM keyed LEFT JOIN firsts USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
