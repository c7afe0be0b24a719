"""Row enrichment through a pluggable Python function, run inside partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SUCCESS = "SUCCESS"
FAILED = "FAILED"

# Called once per partition, so that a client is opened once; returns prompt -> response.
MakeFunction = Callable[[], Callable[[str], str]]


def enrich_partitions(
    df: DataFrame,
    function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: T.StructType | str,
    partitions: int = 8,
) -> DataFrame:
    """Run a function over pandas batches with ``partitions`` calls in flight at most."""
    return df.repartition(partitions).mapInPandas(function, schema)


def enrich_rows(
    df: DataFrame, make_function: MakeFunction, prompt: str, model_name: str, partitions: int = 8, out: str = "response"
) -> DataFrame:
    """Add the response to each row's prompt, the model name and SUCCESS or FAILED.

    A call that raises marks its own row FAILED, with the error text as response; other rows go on.
    Rows keep their columns and types. ``partitions`` bounds the calls in flight.
    """
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField(out, T.StringType()),
            T.StructField("model_name", T.StringType()),
            T.StructField("generation_status", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make_function()

        def attempt(text: str) -> tuple[str, str]:
            try:
                return str(call(text)), SUCCESS
            except Exception as error:  # any failure of the plugged-in function belongs to its row
                return str(error), FAILED

        for batch in batches:
            answers = [attempt(text) for text in batch.column(prompt).to_pylist()]
            columns = [
                *batch.columns,
                pa.array([a[0] for a in answers], pa.string()),
                pa.array([model_name] * batch.num_rows, pa.string()),
                pa.array([a[1] for a in answers], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, out, "model_name", "generation_status"])

    return df.repartition(partitions).mapInArrow(run, schema)
