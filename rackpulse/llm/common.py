"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rackpulse.session import stage

__all__ = ["documents", "pick", "replaced", "slices", "stage", "table", "task_number", "text_bytes"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` cut to the named columns (new=old), found by their exact name.

    Other columns, whatever their names (``Text`` beside ``text``), cannot
    clash with the operator's own columns.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.select(*[plain[f"c{names.index(old)}"].alias(new) for new, old in columns.items()])


def replaced(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with the columns of these exact names replaced, in their place;
    the values are expressions over the column names ``c0``, ``c1``, ..."""
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.select(*[columns.get(n, F.col(f"c{i}")) for i, n in enumerate(names)]).toDF(*names)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``most`` bytes of one text
    column (one row at least)."""
    texts = batch.column(batch.schema.get_field_index(column))
    start, held = 0, 0
    sizes = pc.binary_length(texts).fill_null(0).to_pylist()
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()


def task_number() -> int:
    """Number of the running task's partition."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0
