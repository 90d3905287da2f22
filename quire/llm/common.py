"""What the operators share: the shared folder, written tables, small column helpers."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

#: ASCII white space as the operators' contracts define it.
WS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Spark's setting that deletes an execution's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A null id counts as the largest.
LAST_ID = 2**63 - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.

    Unset, a session of one process (local) gets a folder of its own; on a cluster that is an error.
    """
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quire-"))
        where = sc.getCheckpointDir()
    return where.rstrip("/")


class Workspace:
    """Written tables of one operator call in the shared folder.

    A written table cuts lineage: a lost executor costs a read of the table, not what made it. What is
    left when the driver's process ends is deleted then; `done` deletes a table that has no reader any more.
    """

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/quire-{uuid.uuid4().hex}"
        self.n = 0
        self.paths: dict[int, tuple[DataFrame, str]] = {}
        atexit.register(self._at_exit)

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def write(self, df: DataFrame, name: str, *, by: str | None = None, codec: str = "snappy") -> DataFrame:
        """df as a written table, in folders by a column; the shuffle files that made it go at once."""
        path = self.path(name)
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path, partitionBy=by, compression=codec)
        finally:
            self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = out, path
        return out

    def done(self, *tables: DataFrame) -> None:
        """Deletes tables that `write` gave: nothing reads them any more."""
        for t in tables:
            self.drop(self.paths.pop(id(t))[1])

    def keep_only(self, *tables: DataFrame) -> None:
        """Deletes what `write` gave but for these tables."""
        keep = {id(t) for t in tables}
        self.done(*[t for k, (t, _) in list(self.paths.items()) if k not in keep])

    def drop(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def drop_all(self) -> None:
        """Deletes every written table: call it when no result of the operator is needed any more."""
        self.paths.clear()
        self.drop(self.root)
        atexit.unregister(self._at_exit)

    def _at_exit(self) -> None:
        with contextlib.suppress(Exception):  # the JVM may have gone first
            self.drop(self.root)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def own(columns: list[str], *names: str) -> list[str]:
    """The names, lengthened where columns (case doesn't count) have them."""
    taken = {c.lower() for c in columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def let(value: Column, body) -> Column:
    """body(v) with v bound to value, computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z only; lower() is faster and does the same in ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS))


def words_of(text: Column) -> Column:
    """The runs of characters other than ASCII white space."""
    body = strip(text)
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+"))


def key128(c: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes."""
    return F.xxhash64(c), F.xxhash64(F.lit(0x5DEECE66D), c)
