"""Helpers that several operators use."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clustertrace.sources.staging import new_path, shared_dir

__all__ = ["give_back", "new_path", "put", "shared_dir", "small_batches", "stored", "text_or_empty"]

def stored(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows written once as Parquet in the shared folder and read back, with their lineage cut.

    ``options`` are the writer's and the reader's.
    What reads the result later sees the same rows whichever executors are lost meanwhile.
    """
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).options(**options).parquet(path)


def text_or_empty(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def put(frame: DataFrame, **columns: Column) -> DataFrame:
    """The frame with these columns added; a column of the same name, in any case of letters, is replaced."""
    names = {n.lower() for n in columns}
    kept = [F.col(f"`{c}`") for c in frame.columns if c.lower() not in names]
    return frame.select(*kept, *(c.alias(n) for n, c in columns.items()))


def give_back() -> None:
    """Hands memory that a finished task no longer needs back to the system.

    Spark keeps Python workers for later tasks, and what they hold counts until they end.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another system's library
        pass


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000, size: str = "4m", read_rows: int | None = None) -> Iterator[None]:
    """Fewer rows and bytes in a batch between Spark and Python meanwhile, for what is run inside.

    A batch is held several times over, by the executor and by its Python workers. A row longer than ``size`` is
    a batch of its own. With ``read_rows``, Parquet is read in batches of so many rows too.
    """
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    if read_rows is not None:
        keys.append("spark.sql.parquet.columnarReaderBatchSize")
    before = {key: spark.conf.get(key) for key in keys}
    most = int(before[keys[0]])
    spark.conf.set(keys[0], str(min(rows, most) if most > 0 else rows))
    spark.conf.set(keys[1], size)
    if read_rows is not None:
        spark.conf.set(keys[2], str(min(read_rows, int(before[keys[2]]))))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
