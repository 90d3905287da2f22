"""Files of results as tables: strict JSON objects, run records with what was rejected, parsed texts that are made once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text

META = "source_pdf string, source_file string, provider string, model string, elapsed_seconds string"
RESULT = f"title string, chapters array<struct<level:string,chapter:string,page:string,level_reason:string>>, _meta struct<{META.replace(' string', ':string').replace(', ', ',')}>"


def read_objects(spark: SparkSession, path: str, schema: str, *, glob: str = "*.json") -> DataFrame:
    """(path and the schema's fields) of files that hold one JSON object each; a file that doesn't is an error."""
    d = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").option("pathGlobFilter", glob).json(path)
    return d.withColumn("path", F.input_file_name())


def run_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of the *_toc.json files of a folder: path, source, provider, model, elapsed_seconds; and path, reason of those without
    a source, a provider or a whole number of seconds, or that are no JSON object."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*_toc.json").withColumn("path", F.input_file_name())
    o = F.from_json("value", f"_meta struct<{META.replace(' string', ':string').replace(', ', ',')}>")
    d = files.select("path", o.alias("o")).select("path", F.col("o").isNotNull().alias("_object"), F.col("o._meta").isNotNull().alias("_told"), "o._meta.*")
    source = F.coalesce(F.nullif(clean_text("source_pdf"), F.lit("")), F.nullif(clean_text("source_file"), F.lit("")))
    d = d.select("path", "_object", "_told", F.element_at(F.split(source, r"[/\\]"), -1).alias("source"), F.trim("provider").alias("provider"), F.trim("model").alias("model"), F.col("elapsed_seconds").try_cast("double").alias("elapsed_seconds"))
    why = F.when(~F.col("_told"), "no _meta").when(F.col("source").isNull(), "no source").when(F.coalesce("provider", F.lit("")) == "", "no provider").when(F.col("elapsed_seconds").isNull(), "no seconds")
    d = d.withColumn("reason", why)
    cols = ["path", "source", "provider", "model", "elapsed_seconds"]
    return d.where("reason is null").select(*cols), d.where("reason is not null").select("path", "reason")


def input_names(spark: SparkSession, path: str) -> DataFrame:
    """(name): the lower-case names of a folder's PDF files."""
    from .layout import catalogue

    return catalogue(spark, path).select(F.lower("name").alias("name")).distinct()


def of_inputs(records: DataFrame, names: DataFrame, *, everything: bool = False) -> DataFrame:
    """The records of the inputs named; all of them if asked for, or if there are no inputs."""
    if everything or names.isEmpty():
        return records
    return records.join(names, F.lower("source") == F.col("name"), "left_semi")


def made_once(spark: SparkSession, path: str, make: Callable[[], DataFrame], *, again: bool = False) -> DataFrame:
    """The table at path; made and written there if it isn't yet, or if it is to be made again."""
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    there = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)
    if again or not there:
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def pair(spark: SparkSession, chunk: str, parsed: str) -> DataFrame:
    """(chunk fields, text): an explicit chunk file with the parsed text that goes with it."""
    c = read_objects(spark, chunk, "source_pdf string, chunk string, start_page int, end_page int, text string").withColumnRenamed("text", "chunk_text")
    return c.join(spark.read.text(parsed, wholetext=True).withColumnRenamed("value", "parsed_text"))
