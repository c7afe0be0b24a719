"""Table readers and writers. A target with a slash is a parquet path, otherwise a catalog table.

A path that was written as a whole holds versions (see ``versions``); readers get the published one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from medallion.sources import versions


def read_table(spark: SparkSession, source: str, evolving: bool = False) -> DataFrame:
    """Static snapshot of a table.

    ``evolving`` reads columns that only some files hold (NULL elsewhere), for which it looks at every file's footer.
    """
    if "/" in source:
        return spark.read.option("mergeSchema", evolving).parquet(versions.current(spark, source) or source)
    return spark.table(source)


def table_exists(spark: SparkSession, source: str) -> bool:
    """Whether anything was ever written to a table, on any file system Spark can read."""
    if "/" not in source:
        return spark.catalog.tableExists(source)
    return versions.exists(spark, source)


def stream_table(spark: SparkSession, path: str, evolving: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """A folder of parquet files as a stream of newly arriving rows.

    ``path`` may be a pattern. With a ``schema`` no file is opened for its columns; otherwise ``evolving`` looks at all
    files, not just at one.
    """
    schema = schema or spark.read.option("mergeSchema", evolving).parquet(path).schema
    return spark.readStream.schema(schema).parquet(path)


def write_overwrite(df: DataFrame, target: str) -> None:
    """Replace a table. A path gets a new version, published when it is whole; ``df`` may read the table itself."""
    if "/" in target:
        versions.publish(df, target)
    else:
        df.write.mode("overwrite").saveAsTable(target)


def write_append(df: DataFrame, target: str) -> None:
    """Add rows to a table; to its current version, if it has versions."""
    if "/" in target:
        df.write.mode("append").parquet(versions.current(df.sparkSession, target) or target)
    else:
        df.write.mode("append").saveAsTable(target)


def refresh_view(spark: SparkSession, target: str, build: Callable[[SparkSession], DataFrame]) -> DataFrame:
    """Recompute a materialised result and replace the stored one."""
    write_overwrite(build(spark), target)
    return read_table(spark, target)
