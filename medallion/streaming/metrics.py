"""Counts of passed and failed expectations, taken while a stream's rows flow to their tables."""

from __future__ import annotations

import threading
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from medallion.operators.quality import Expectation
from medallion.streaming.jobs import BATCH

OBSERVED = "expectations"
_SCHEMA = "rule string, action string, passed long, failed long"
_WAIT_SECONDS = 60


class _Observed(StreamingQueryListener):
    """Remembers what each micro-batch has observed, by query and batch."""

    def __init__(self) -> None:
        self.batches: dict[str, dict[int, dict]] = {}
        self.ended: dict[str, threading.Event] = {}

    def end_of(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(OBSERVED)
        if row is not None and row["rows"]:
            self.batches.setdefault(str(event.progress.runId), {})[event.progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.end_of(str(event.runId)).set()


@contextmanager
def observing(spark: SparkSession, rules: Sequence[Expectation], target: str, entity: str):
    """Inside, call ``store(query)`` for a finished query whose frame went through ``observe_expectations``.

    Every batch has a folder of its own, named after entity and batch, so a batch that is repeated replaces its numbers.
    A driver that is lost after a batch was committed and before the query's end takes that batch's numbers with it.
    """
    listener = _Observed()
    spark.streams.addListener(listener)

    def store(query) -> int:
        run = str(query.runId)
        listener.end_of(run).wait(_WAIT_SECONDS)
        batches = listener.batches.get(run, {})
        for number, seen in batches.items():
            rows = [(r.name, r.action, seen["rows"] - seen[r.name], seen[r.name]) for r in rules]
            spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{target}/entity={entity}/{BATCH}={number}")
        return len(batches)

    try:
        yield store
    finally:
        spark.streams.removeListener(listener)


def totals(spark: SparkSession, target: str) -> DataFrame:
    """Per entity and rule the counts over all batches."""
    rows = spark.read.parquet(target)
    return rows.groupBy("entity", "rule", "action").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))

