"""Sessions, and the package on their Python workers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package: nothing to do where PYTHONPATH names its folder, else its files go along once."""
    package = Path(__file__).parent
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    # The driver serves this file to the executors for as long as it lives.
    folder = tempfile.mkdtemp(prefix="quire-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def spread(df: DataFrame) -> DataFrame:
    """df in as many partitions as shuffles have: before work that costs much for each byte, which a file of one row group would leave to one task."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def local(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A session in this process, for tests and benchmarks."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName("quire")
    for k, v in {"spark.sql.shuffle.partitions": "8", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g", **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()
