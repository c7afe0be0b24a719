"""Keep one row per key, in batch and on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row per key (NULL is a key) in the given total order.

    The ``row_number() = 1`` filter lets the planner keep one row per key in every map task
    before the shuffle, so a key that holds a large share of all rows stays cheap.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedupe_stream(df: DataFrame, keys: Sequence[str], salts: int = 8) -> DataFrame:
    """First row seen per key. State is kept for every key ever seen: no watermark, by design.

    A stream has no map-side step that thins out duplicates. Duplicates are therefore removed
    within ``salts`` groups of input partitions first, so the rows of a frequent key are
    shared by that many tasks and at most ``salts`` of them go on.
    """
    if salts > 1:
        df = df.withColumn("_salt", F.spark_partition_id() % salts).dropDuplicates([*keys, "_salt"]).drop("_salt")
    return df.dropDuplicates(list(keys))


def dedupe_first_stream(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row per key in the given total order, whatever the order of arrival. Run in complete mode.

    Each map task sends on one row per key. The survivor is replaced when an earlier one comes.
    """
    rest = [c for c in df.columns if c not in {*keys, *order_by}]
    first = F.min(F.struct(*order_by, *rest)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Ordered dedupe on a batch frame, first-seen dedupe on a stream."""
    return dedupe_stream(df, keys) if df.isStreaming else dedupe_first(df, keys, order_by)


def streaming_exact_distinct(df: DataFrame, group: Sequence[str], id_col: str, out: str, *more) -> DataFrame:
    """Exact distinct ids per group on a stream, where ``count_distinct`` is not allowed.

    NULL ids are not counted. Run in complete or update mode. ``more`` are extra aggregates,
    which see one row per (group, id).
    """
    unique = dedupe_stream(df, [*group, id_col])
    return unique.groupBy(*group).agg(F.count(id_col).alias(out), *more)
