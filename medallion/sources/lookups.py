"""Small lookup tables built from rows in code, and stored lookup tables with defaults."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from medallion.operators.joins import checked_lookup
from medallion.sources.tables import read_table, write_overwrite

# Region codes and the names they stand for.
REGION_ROWS = (
    ("W", "West"),
    ("C", "Central"),
    ("E", "East"),
    ("S", "South"),
    ("West", "West"),
    ("Central", "Central"),
    ("East", "East"),
    ("South", "South"),
)
REGION_SCHEMA = T.StructType(
    [T.StructField("reg_coded", T.StringType(), False), T.StructField("reg_mapped", T.StringType(), False)]
)


def seed_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Rows written in code as a frame whose exact size the planner knows.

    Joins with it are broadcast by the planner as long as it stays under the broadcast threshold.
    """
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow = to_arrow_schema(schema)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema)


def region_mapper(spark: SparkSession) -> DataFrame:
    """Region lookup with load time. Its keys are unique after upper(trim())."""
    return seed_rows(spark, REGION_ROWS, REGION_SCHEMA).withColumn("md_created_datetime", F.current_timestamp())


def create_lookup(spark: SparkSession, name: str, schema: T.StructType, created: str = "md_created_datetime") -> None:
    """(Re)create a stored lookup table: NOT NULL columns as declared, load time filled by default."""
    columns = [
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    ]
    columns.append(f"{created} TIMESTAMP DEFAULT current_timestamp()")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet")


def fill_lookup(spark: SparkSession, name: str, rows: Sequence[tuple], schema: T.StructType) -> None:
    """Insert rows written in code; columns that are not given take their default."""
    names = ", ".join(schema.fieldNames())
    spark.sql(f"INSERT INTO {name} ({names}) SELECT {names} FROM {{rows}}", rows=seed_rows(spark, rows, schema))


def store_lookup(
    rows: DataFrame, target: str, schema: T.StructType, keys: Sequence[str], created: str = "md_created_datetime"
) -> None:
    """Replace a stored lookup that jobs read, after checking what a table definition would: declared columns, NOT NULL, unique keys.

    The load time is filled where it is absent or NULL. Runs that have begun keep the rows they began with.
    """
    missing = [f.name for f in schema.fields if f.name not in rows.columns]
    if missing:
        raise ValueError(f"lookup columns {missing} are missing")
    given = F.col(created) if created in rows.columns else F.lit(None).cast("timestamp")
    typed = rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], F.coalesce(given, F.current_timestamp()).alias(created)
    )
    strict = [f.name for f in schema.fields if not f.nullable]
    nulls = typed.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in strict]).first().asDict() if strict else {}
    if any(nulls.values()):
        raise ValueError(f"lookup columns {[c for c, n in nulls.items() if n]} must not be NULL")
    checked_lookup(typed, keys)
    write_overwrite(typed, target)


def stored_lookup(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """A stored lookup with its keys proved unique, marked for broadcast if its rows were counted to be few."""
    return checked_lookup(read_table(spark, target), keys)
