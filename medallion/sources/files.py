"""Raw file ingest: CSV and JSON files whose columns drift between files."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One file-name pattern per entity.
ENTITY_GLOBS = {
    "customers": "customers_*.csv",
    "cars": "cars*.csv",
    "claims": "claims_*.json",
    "policy": "policy*.csv",
    "sales": "sales*.csv",
}
_HEAD_BYTES = 1 << 16


def _reader(spark: SparkSession, glob: str, stream: bool = False):
    reader = spark.readStream if stream else spark.read
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the name of the source file and the time of ingestion."""
    return df.withColumn("source_file", F.col("_metadata.file_name")).withColumn(
        "ingestion_timestamp", F.current_timestamp()
    )


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both frames under the union of their columns; absent values are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def infer_schema(spark: SparkSession, path: str, glob: str, fmt: str, sampling: float = 1.0) -> T.StructType:
    """Column types found in the files. Reads them all once unless ``sampling`` is below 1."""
    reader = _reader(spark, glob).option("samplingRatio", sampling)
    if fmt == "csv":
        return reader.option("header", "true").option("inferSchema", "true").csv(path).schema
    return reader.option("multiLine", "true").json(path).schema


def read_csv_stream(spark: SparkSession, path: str, glob: str, schema: T.StructType) -> DataFrame:
    """Stream of new CSV files that all share one header."""
    return with_provenance(_reader(spark, glob, stream=True).option("header", "true").schema(schema).csv(path))


def read_json(
    spark: SparkSession, path: str, glob: str, stream: bool = False, schema: T.StructType | None = None
) -> DataFrame:
    """JSON files holding one document or a list of documents over several lines.

    Such a file cannot be split, so one task reads one file.
    """
    if schema is None and stream:
        schema = infer_schema(spark, path, glob, "json")
    reader = _reader(spark, glob, stream).option("multiLine", "true")
    return with_provenance((reader.schema(schema) if schema else reader).json(path))


def _paths(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    # Only the path column is read, so no file content is loaded.
    return _reader(spark, glob).format("binaryFile").load(path).select("path")


def any_file(spark: SparkSession, path: str, glob: str) -> bool:
    """Whether a feed has brought at least one file."""
    return not _paths(spark, path, glob).isEmpty()


def _head(path: str) -> str:
    """First line of a file, read without loading the rest."""
    from pyarrow import fs

    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        system, name = fs.LocalFileSystem(), unquote(parts.path)
    else:
        system, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://"))
    text = b""
    with system.open_input_stream(name) as source:
        while b"\n" not in text and (more := source.read(_HEAD_BYTES)):
            text += more
    return text.split(b"\n")[0].decode("utf-8-sig").rstrip("\r")


def _heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(header=[_head(p) for p in batch["path"]])


def header_groups(spark: SparkSession, path: str | list[str], glob: str) -> list[tuple[list[str], list[str]]]:
    """Files grouped by header line: (column names, paths). Tasks read only the first block of a file.

    The driver receives one (path, header) pair per file, as much as Spark's own file listing holds.
    """
    heads = _paths(spark, path, glob).mapInPandas(_heads, "path string, header string")
    groups: dict[str, list[str]] = {}
    for found in sorted(heads.collect()):
        if found["header"]:
            groups.setdefault(found["header"], []).append(found["path"])
    return [(next(csv.reader([header])), paths) for header, paths in groups.items()]


def read_csv_by_header(spark: SparkSession, path: str | list[str], glob: str, infer: bool = False) -> DataFrame:
    """CSV files of one entity whose headers differ, matched by column *name*.

    A plain read would apply the first file's header to all files by position. Here each
    distinct header is one read and the reads are united by name. Columns are text unless ``infer``.
    """

    def read(names: list[str], paths: list[str]) -> DataFrame:
        reader = spark.read.option("header", "true")
        if infer:
            return reader.option("inferSchema", "true").csv(paths)
        return reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(paths)

    groups = header_groups(spark, path, glob)
    if not groups:
        raise FileNotFoundError(f"no file with a header matches {glob} under {path}")
    return reduce(evolve, [with_provenance(read(names, paths)) for names, paths in groups])


def new_file_stream(spark: SparkSession, path: str, glob: str, max_files: int = 1000) -> DataFrame:
    """Stream of paths of newly arrived files; at most ``max_files`` per micro-batch."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = _reader(spark, glob, stream=True).option("maxFilesPerTrigger", max_files)
    return reader.format("binaryFile").schema(schema).load(path).select("path")
