"""Reading the test tables and cutting lineage with written tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import fresh_dir

#: Rows go to Python in batches of about this size. Spark's own limit is 64 MB, and a worker and its executor hold each batch several times.
BATCH_BYTES = "1m"
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` and read it back: a cut in the lineage that outlives executors."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on this session's rows go to Python ``BATCH_BYTES`` at a time, unless the caller has set a size."""
    if _BATCH_LIMIT not in spark.conf.getAll:
        spark.conf.set(_BATCH_LIMIT, BATCH_BYTES)


def usual_batches(spark: SparkSession) -> None:
    """Undo ``small_batches``, for work whose rounding follows the ends of batches."""
    if spark.conf.getAll.get(_BATCH_LIMIT) == BATCH_BYTES:
        spark.conf.unset(_BATCH_LIMIT)


@contextmanager
def batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """What is run inside sends its rows to Python ``size`` at a time, unless the caller has set a size."""
    free = _BATCH_LIMIT not in spark.conf.getAll
    if free:
        spark.conf.set(_BATCH_LIMIT, size)
    try:
        yield
    finally:
        if free:
            spark.conf.unset(_BATCH_LIMIT)


def held_out(id_column: str, modulus: int, remainder: int):
    """Rows no model may learn from, by the crc32 of the id as text; a row without id is never learnt from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that hold at least one row."""
    for batch in batches:
        if batch.num_rows:
            yield batch
