"""Folds over the rows of groups in order, as one pass over sorted partitions.

A group costs no call of its own, and only what the fold holds is in memory, however large the group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ship


def _in_order(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """df with _first, which tells a group's first row: a window leaves its partitions in order of groups and rows, and keeps a distribution that fits."""
    return df.withColumn("_first", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1)


def appended(df: DataFrame, keys: list[str], order: list[str | Column], needs: list[str], start: Callable[[], Callable[..., tuple]], schema: str) -> DataFrame:
    """df with the columns of schema: start() gives a group's step, which takes the `needs` of each row in order and returns the row's new values."""
    ship(df.sparkSession)
    new = StructType.fromDDL(schema)
    names = df.columns

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        step, kinds = None, [to_arrow_type(f.dataType) for f in new]
        for b in batches:
            rows = []
            for first, *values in zip(b.column("_first").to_pylist(), *[b.column(c).to_pylist() for c in needs], strict=True):
                if first:
                    step = start()
                rows.append(step(*values))
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*names, *new.names])

    return _in_order(df, keys, order).mapInArrow(run, StructType([*df.schema, *new]))


def folded(df: DataFrame, keys: list[str], order: list[str | Column], fold: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str, at_once: int = 4096) -> DataFrame:
    """The rows of schema that fold gives for each group's rows (df's columns as tuples, in order), sent on at_once at a time."""
    ship(df.sparkSession)
    new = StructType.fromDDL(schema)
    names = df.columns

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in new]
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=new.names)

        def numbered():
            n = 0
            for b in batches:
                for first, *values in zip(b.column("_first").to_pylist(), *[b.column(c).to_pylist() for c in names], strict=True):
                    n += first
                    yield n, tuple(values)

        held: list[tuple] = []
        for _, rows in groupby(numbered(), lambda x: x[0]):
            for found in fold(r for _, r in rows):
                held.append(found)
                if len(held) >= at_once:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)

    return _in_order(df, keys, order).mapInArrow(run, new)
