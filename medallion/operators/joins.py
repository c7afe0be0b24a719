"""Lookup joins and group counts that stay safe when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.cleaning import norm_upper

BROADCAST_ROWS = 50_000
HOT_KEYS = 50_000


def checked_lookup(lookup: DataFrame, keys: Sequence[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Prepare a stored lookup table for joining: prove its keys unique and its size.

    One small job counts rows and distinct normalised keys. Duplicate keys raise, since they would
    multiply the joined rows. Up to ``max_rows`` rows the lookup is marked for broadcast;
    beyond that it is returned as it is and the join shuffles.
    """
    counted = lookup.agg(
        F.count("*").alias("rows"),
        F.count_distinct(F.struct(*[norm_upper(k) for k in keys])).alias("keys"),
    ).first()
    if counted["rows"] != counted["keys"]:
        raise ValueError(f"lookup keys {list(keys)} are not unique after upper(trim())")
    return F.broadcast(lookup) if counted["rows"] <= max_rows else lookup


def lookup_expand(df: DataFrame, mapper: DataFrame, column: str, key: str, value: str, out: str) -> DataFrame:
    """Replace a code by its mapped value; an unknown code stays, upper-cased and trimmed."""
    pairs = mapper.select(norm_upper(key).alias("_map_key"), F.col(value).alias("_map_value"))
    code = norm_upper(column)
    return (
        df.withColumn("_code", code)
        .join(pairs, F.col("_code") == F.col("_map_key"), "left")
        .withColumn(out, F.coalesce("_map_value", "_code"))
        .drop("_code", "_map_key", "_map_value")
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name over batch frames or streams."""
    return reduce(DataFrame.unionByName, frames)


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def with_group_count(df: DataFrame, keys: Sequence[str], out: str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Number of rows sharing this row's key (NULL is a key), on every row.

    A window, or a plain join with the counts, would bring all rows of a frequent key into one task.
    Fewer than ``hot_keys`` keys can each hold more than ``1 / hot_keys`` of the rows, so the counts
    of those are broadcast whatever the size of the data. Rows that found their count that way are
    spread over the join of the remaining keys by their input partition instead of their key.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    is_hot = F.col("_n") * hot_keys > counts.agg(F.sum("_n")).scalar()

    def side(rows: DataFrame, prefix: str) -> DataFrame:
        return rows.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys], F.col("_n").alias(f"{prefix}n"))

    hot = side(counts.filter(is_hot), "_hot_")
    cold = side(counts.filter(~is_hot), "_cold_").withColumn("_cold_part", F.xxhash64(*[f"_cold_{k}" for k in keys]))
    part = F.when(F.col("_hot_n").isNull(), F.xxhash64(*keys)).otherwise(F.spark_partition_id())
    return (
        df.join(F.broadcast(hot), _same(keys, "_hot_"), "left")
        .withColumn("_part", part)
        .join(cold, (F.col("_part") == F.col("_cold_part")) & _same(keys, "_cold_"), "left")
        .select(*df.columns, F.coalesce("_hot_n", "_cold_n").alias(out))
    )
