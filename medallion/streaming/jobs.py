"""Streaming jobs: each drains what has arrived, then stops (``availableNow``).

Sinks written per micro-batch put every batch in its own folder, named after the batch id and
overwritten as a whole. A batch that is repeated after a failure therefore replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from medallion.operators.quality import CLEAN, QUARANTINE, Expectation, QuarantineRule, tag_quality
from medallion.sources.files import new_file_stream, read_csv_by_header
from medallion.sources.schemas import SchemaHistory, fit, numbers_in_texts, raw_csv, raw_json

BATCH = "_batch"
_PARTITIONS, _OPEN_FILES = "spark.sql.shuffle.partitions", "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _set(spark: SparkSession, key: str, value: int | None):
    """A session setting while something runs; none changes nothing."""
    before = spark.conf.get(key)
    if value:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _drain(
    writer: DataStreamWriter, spark: SparkSession, checkpoint: str, state_partitions: int | None, *target: str, open_files: int | None = None
):
    """Run a stream until it has taken all there is. The first run fixes the number of state partitions.

    A stream plans with the settings it was started with, but file sinks look at the session's whenever they write.
    """
    with _set(spark, _OPEN_FILES, open_files):
        with _set(spark, _PARTITIONS, state_partitions):
            query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(*target)
        query.awaitTermination()
    return query


def run_append(
    df: DataFrame,
    target: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    state_partitions: int | None = None,
    open_files: int | None = None,
) -> StreamingQuery:
    """Append finished rows to a parquet table, each exactly once. Returns the finished query.

    A task that writes into partitions sorts its rows by them, unless they are fewer than ``open_files``: then it keeps a
    file open for each.
    """
    writer = df.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
    return _drain(writer, df.sparkSession, checkpoint, state_partitions, target, open_files=open_files)


def run_batches(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``write(batch, batch_id)``, which must be repeatable."""
    writer = df.writeStream.foreachBatch(write).outputMode(mode)
    return _drain(writer, df.sparkSession, checkpoint, state_partitions)


def _write_batch(batch: DataFrame, target: str, batch_id: int) -> None:
    batch.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    """All batches as one table; columns that came later are NULL in earlier batches."""
    return spark.read.option("mergeSchema", "true").parquet(target).drop(BATCH)


def run_complete(
    df: DataFrame, target: str, checkpoint: str, state_partitions: int | None = None
) -> StreamingQuery:
    """Write a full snapshot of a running aggregate per micro-batch.

    The two latest finished snapshots stay, so a reader of the one before is not cut off; older ones go.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, target, batch_id)
        system, versions = _versions(batch.sparkSession, target)
        for _, old in versions[:-2]:
            system.delete(old, True)

    return run_batches(df, write, checkpoint, "complete", state_partitions)


def _versions(spark: SparkSession, target: str) -> tuple[Any, list[tuple[int, Any]]]:
    """File system of a snapshot table and its finished versions, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in system.listStatus(path)]
    done = [p for p in found if p.getName().startswith(f"{BATCH}=") and system.exists(p.suffix("/_SUCCESS"))]
    return system, sorted(((int(p.getName().split("=")[1]), p) for p in done), key=lambda v: v[0])


def read_snapshot(spark: SparkSession, target: str) -> DataFrame:
    """The latest snapshot of ``run_complete`` whose write was finished."""
    _, versions = _versions(spark, target)
    if not versions:
        raise FileNotFoundError(f"no finished snapshot under {target}")
    return spark.read.parquet(versions[-1][1].toString())


def run_split(
    parsed: DataFrame,
    entity: str,
    expectations: Sequence[Expectation],
    rules: Sequence[QuarantineRule],
    target: str,
    checkpoint: str,
) -> StreamingQuery:
    """Feed the clean and the quarantine table of an entity from one pass over a parsed stream.

    ``parsed`` may count its expectations on the way (``observe_expectations``).
    """
    return run_append(tag_quality(parsed, entity, expectations, rules), target, checkpoint, ["_table"], open_files=len((CLEAN, QUARANTINE)) + 1)


def read_split(spark: SparkSession, target: str) -> tuple[DataFrame, DataFrame]:
    """Clean and quarantine table written by ``run_split``; each reads only its own folder."""
    both = spark.read.parquet(target)
    clean, bad = (both.filter(F.col("_table") == name).drop("_table") for name in (CLEAN, QUARANTINE))
    return clean.drop("_dq_rule", "_dq_detected_at", "_entity"), bad


def ingest_csv(
    spark: SparkSession, path: str, glob: str, target: str, checkpoint: str, infer: bool = False, max_files: int = 1000
) -> StreamingQuery:
    """Load new CSV files whose headers may differ, matched by column name.

    The stream carries file *paths*, so each file is taken once; a batch holds at most
    ``max_files`` of them, which bounds the list that reaches the driver.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = [row["path"] for row in batch.collect()]
        if paths:
            _write_batch(read_csv_by_header(spark, paths, glob, infer), target, batch_id)

    return run_batches(new_file_stream(spark, path, glob, max_files), write, checkpoint)


def ingest_feed(
    spark: SparkSession,
    path: str,
    glob: str,
    target: str,
    checkpoint: str,
    history: SchemaHistory,
    infer: bool = False,
    multi_line: bool = True,
    max_files: int = 1000,
) -> StreamingQuery:
    """Load new CSV or JSON files (by the pattern's ending) under a schema that grows with them.

    The schema is extended before the batch is written, so a table file never holds a column that the history does not know.
    Read the table with ``history.table_schema()``. ``infer`` gives CSV columns types; ``multi_line`` tells
    JSON documents from JSON lines, which large files should use because they can be split. Files may be compressed
    (``.json.gz``); such a file is read by one task, so large deliveries should come as many.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = [row["path"] for row in batch.collect()]
        if not paths:
            return
        if ".json" in PurePosixPath(glob).suffixes:
            raw, found = raw_json(spark, paths, multi_line)
        else:
            raw, found = raw_csv(spark, paths, glob, infer)
        found = numbers_in_texts(raw, found, history.latest())
        _write_batch(fit(raw, history.extend(found), found), target, batch_id)

    return run_batches(new_file_stream(spark, path, glob, max_files), write, checkpoint)
