"""Tables fed by streams whose rows may still change: a key's later row replaces its earlier one.

A stream in update mode sends every key that a micro-batch has touched, with its row as it is now. Each batch is a
folder of changes, overwritten when the batch is repeated; readers take a key's latest change. Changes are folded into
a base table, published as a new version, so that reading does not grow with the number of batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medallion.sources import versions
from medallion.streaming.jobs import BATCH, run_batches

#: Time at which a row became the current one of its key.
CHANGED = "_changed_at"
#: Batches of changes that readers put together before they are folded.
FOLD_AFTER = 16


def _changes(target: str) -> str:
    return f"{target}/changes"


def _base(target: str) -> str:
    return f"{target}/base"


def run_upserts(
    df: DataFrame, target: str, checkpoint: str, keys: Sequence[str], state_partitions: int | None = None, fold_after: int = FOLD_AFTER
) -> StreamingQuery:
    """Run an aggregating stream in update mode into a table with one current row per key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn(CHANGED, F.current_timestamp())
        stamped.write.mode("overwrite").parquet(f"{_changes(target)}/{BATCH}={batch_id}")

    query = run_batches(df, write, checkpoint, "update", state_partitions)
    fold(df.sparkSession, target, keys, fold_after)
    return query


def _finished(spark: SparkSession, target: str) -> list[int]:
    """Numbers of change batches that were written to their end."""
    found = []
    for name in versions.folder_names(spark, _changes(target)):
        done, system = versions.file_system(spark, f"{_changes(target)}/{name}/_SUCCESS")
        if name.startswith(f"{BATCH}=") and system.exists(done):
            found.append(int(name.removeprefix(f"{BATCH}=")))
    return sorted(found)


def _parts(spark: SparkSession, target: str) -> tuple[list[DataFrame], list[int]]:
    """The base and the batches that it does not hold yet, each row with its batch."""
    base = versions.current(spark, _base(target))
    parts = [spark.read.parquet(base)] if base else []
    folded = parts[0].agg(F.max(BATCH)).first()[0] if base else None
    fresh = [n for n in _finished(spark, target) if folded is None or n > folded]
    if fresh:
        paths = [f"{_changes(target)}/{BATCH}={n}" for n in fresh]
        parts.append(spark.read.option("basePath", _changes(target)).parquet(*paths).withColumn(BATCH, F.col(BATCH).cast("long")))
    return parts, fresh


def _latest(parts: list[DataFrame], keys: Sequence[str]) -> DataFrame:
    both = reduce(DataFrame.unionByName, parts)
    # A batch holds a key once, so the order is total and a key has few rows.
    newest = Window.partitionBy(*keys).orderBy(F.desc(BATCH))
    return both.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def read_upserts(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The current row of every key (NULL is a key), with the time of its last change."""
    parts, fresh = _parts(spark, target)
    if not parts:
        raise FileNotFoundError(f"no finished batch under {target}")
    return (_latest(parts, keys) if fresh else parts[0]).drop(BATCH)


def fold(spark: SparkSession, target: str, keys: Sequence[str], after: int = 0) -> bool:
    """Fold the changes into a new version of the base if there are more than ``after`` batches of them.

    Batches that the version before held already are deleted, so readers of that version are not cut off.
    """
    parts, fresh = _parts(spark, target)
    if len(fresh) <= after:
        return False
    old = _finished(spark, target)
    versions.publish(_latest(parts, keys), _base(target))
    for number in old:
        if number < fresh[0]:
            folder, system = versions.file_system(spark, f"{_changes(target)}/{BATCH}={number}")
            system.delete(folder, True)
    return True
