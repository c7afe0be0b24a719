"""Aggregates used by the views, KPIs and scoring."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def inconsistent_keys(df: DataFrame, key: str, attribute: str, out: str, minimum: int = 2) -> DataFrame:
    """Keys that carry at least ``minimum`` different values of an attribute."""
    return df.groupBy(key).agg(F.count_distinct(attribute).alias(out)).filter(F.col(out) >= minimum)


def mean_and_stddev(df: DataFrame, column: str) -> Column:
    """Global mean and sample standard deviation as a scalar subquery, usable on any row.

    The one-row result is planned into the query itself: no cross join and no separate action.
    """
    value = F.col(column).cast("double")
    return df.agg(F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))).scalar()


def zscore(df: DataFrame, column: str, out: str, mean_out: str | None = None) -> DataFrame:
    """Distance from the mean in standard deviations; NULL for a constant or single-row column."""
    stats = mean_and_stddev(df, column)
    scored = df.withColumn(
        out, F.try_divide(F.col(column).cast("double") - stats.getField("mean"), stats.getField("std"))
    )
    return scored.withColumn(mean_out, stats.getField("mean")) if mean_out else scored


def kpis(df: DataFrame, spec: Mapping[str, Column]) -> DataFrame:
    """One row of named aggregates."""
    return df.agg(*[measure.alias(name) for name, measure in spec.items()])
