"""Exact nearest neighbours by squared Euclidean distance.

A few queries travel to the corpus, which is scanned where it lies. Many queries and the corpus are both cut into bounded
blocks, and every block of the one meets every block of the other in a task of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from medallion.session import fresh_dir

QUERY_BLOCK = 1024
CORPUS_BLOCK = 1 << 15
#: Distances that differ by less than this many digits are ties, whatever the order of summation.
DIGITS = 10
_ORDER = [("distance", "ascending"), ("_id", "ascending")]


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != len(vectors) * dim:
        raise ValueError(f"corpus vectors must all have {dim} components")
    return flat.reshape(-1, dim)


def _nearest(
    batches: Iterator[pa.RecordBatch], ids: list, id_type: pa.DataType, queries: np.ndarray, k: int
) -> Iterator[pa.RecordBatch]:
    """Best ``k`` rows of one partition for every query, ties broken by id."""
    best: list[pa.Table | None] = [None] * len(ids)
    worst = np.full(len(ids), np.inf)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        points = _matrix(batch.column("_vector"), queries.shape[1])
        rows = pa.Table.from_batches([batch]).drop_columns(["_vector"])
        for q, query in enumerate(queries):
            gap = points - query
            distance = np.einsum("ij,ij->i", gap, gap)
            distance = distance.round(DIGITS)
            distance[np.isnan(distance)] = np.inf  # a missing component: comparable to nothing
            reach = worst[q]
            if len(distance) > k:
                reach = min(reach, np.partition(distance, k - 1)[k - 1])
            near = np.flatnonzero((distance <= reach) & (distance < np.inf))
            if len(near) == 0:
                continue
            found = rows.take(pa.array(near)).append_column("distance", pa.array(distance[near]))
            merged = found if best[q] is None else pa.concat_tables([best[q], found])
            best[q] = merged.sort_by(_ORDER).slice(0, k).combine_chunks()
            if best[q].num_rows == k:
                worst[q] = best[q].column("distance")[k - 1].as_py()
    for query_id, table in zip(ids, best):
        if table is not None:
            yield from table.append_column("_query", pa.array([query_id] * table.num_rows, id_type)).to_batches()


def _ranked(df: DataFrame, keys: Sequence[str | Column], k: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy("distance", "_id")
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def _meeting(id_type: pa.DataType, k: int, schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Best ``k`` rows of a corpus block for every query of a query block."""

    def meet(corpus: pa.Table, asked: pa.Table) -> pa.Table:
        if corpus.num_rows == 0 or asked.num_rows == 0:
            return schema.empty_table()
        vectors = asked.column("_asked").combine_chunks()
        dim = len(vectors[0])
        matrix = _matrix(vectors, dim)
        batches = corpus.drop_columns(["_corner", "_side"]).to_batches()
        best = list(_nearest(iter(batches), asked.column("_query").to_pylist(), id_type, matrix, k))
        return pa.Table.from_batches(best).select(schema.names).cast(schema) if best else schema.empty_table()

    return meet


def _block_join(
    asked: DataFrame, rows: DataFrame, schema: T.StructType, id_type: pa.DataType, k: int, query_block: int, corpus_block: int
) -> DataFrame:
    """Candidates of every query from every block of the corpus.

    Rows are dealt to blocks by their place in the stored tables, not by a key, so blocks are even whatever repeats. The
    corpus is shuffled once per query block and the queries once per corpus block, in pieces that fit a task.
    """
    asked, rows = _stored(asked, "knn-queries"), _stored(rows, "knn-corpus")
    n_sides, n_corners = (max(1, -(-df.count() // size)) for df, size in ((asked, query_block), (rows, corpus_block)))
    dealt = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("_corner", dealt(n_corners)).withColumn("_side", every(n_sides))
    right = asked.withColumn("_side", dealt(n_sides)).withColumn("_corner", every(n_corners))
    met = left.groupBy("_corner", "_side").cogroup(right.groupBy("_corner", "_side"))
    return met.applyInArrow(_meeting(id_type, k, to_arrow_schema(schema)), schema)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def knn_l2(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str,
    query_vector: str,
    corpus_id: str,
    corpus_vector: str,
    payload: Sequence[str] = (),
    query_block: int = QUERY_BLOCK,
    merge_buckets: int = 32,
    corpus_block: int = CORPUS_BLOCK,
) -> DataFrame:
    """``k`` nearest corpus rows per query: query id, corpus id, payload, distance, rank.

    Up to ``query_block`` queries are sent to the tasks, and the corpus is scanned where it lies, never shuffled. More
    are stored, and so is the corpus, from one scan of it; blocks of both meet in tasks (``_block_join``), and no vector
    reaches the driver. Either way a task keeps ``k`` rows per query, and only those travel on. They are merged in two
    steps, first within hash buckets of the corpus id, so that no task receives all candidates of a query.
    """
    id_type = queries.schema[query_id].dataType
    arrow_id = to_arrow_type(id_type)
    rows = corpus.filter(F.col(corpus_vector).isNotNull()).select(
        F.col(corpus_id).alias("_id"), *payload, F.col(corpus_vector).alias("_vector")
    )
    schema = T.StructType(
        [f for f in rows.schema.fields if f.name != "_vector"]
        + [T.StructField("distance", T.DoubleType()), T.StructField("_query", id_type)]
    )

    asked = queries.select(F.col(query_id).alias("_query"), F.col(query_vector).alias("_asked")).filter(F.col(query_vector).isNotNull())
    few = asked.limit(query_block + 1).collect()
    if not few:
        empty = T.StructType([*schema.fields, T.StructField("rank", T.IntegerType())])
        found = queries.sparkSession.createDataFrame([], empty)
    else:
        if len(few) <= query_block:
            ids, matrix = [r[0] for r in few], np.array([r[1] for r in few], dtype=np.float64)
            candidates = rows.mapInArrow(lambda batches: _nearest(batches, ids, arrow_id, matrix, k), schema)
        else:
            candidates = _block_join(asked, rows, schema, arrow_id, k, query_block, corpus_block)
        bucket = F.pmod(F.hash("_id"), F.lit(merge_buckets))
        found = _ranked(_ranked(candidates, ["_query", bucket], k).drop("rank"), ["_query"], k)
    return found.select(F.col("_query").alias(query_id), F.col("_id").alias(corpus_id), *payload, "distance", "rank")
