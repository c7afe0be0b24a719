"""Connected components by repeated contraction, without bringing links to the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.tables import stored


#: So many links (256 KB) are joined by one task; of more, rounds leave so many at last.
FEW = 16_384


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``old, new`` for the nodes of these links that another node of their component replaces."""
    up: dict[int, int] = {}

    def root(c: int) -> int:
        while up.setdefault(c, c) != c:
            up[c] = c = up[up[c]]
        return c

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = sorted((root(a), root(b)))
            up[b] = a
    moves = [(x, root(x)) for x in list(up)]
    ends = list(zip(*[(old, new) for old, new in moves if old != new])) or [(), ()]
    yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], names=["old", "new"])


def _moved(df: DataFrame, column: str, moves: DataFrame) -> DataFrame:
    joined = df.join(moves, F.col(column) == F.col("old"), "left")
    return joined.withColumn(column, F.coalesce("new", column)).drop("old", "new")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a``, ``b``, longs); component: its smallest node.

    Per round every node moves to its neighbour of least priority, if that is less than its own; priorities are
    random and new in each round, so about a third of the nodes of any shape of graph goes per round. Frequent
    nodes are reduced before they are shuffled. The last ``FEW`` links take no rounds. Loops and repeated edges are ignored, null ends too.
    """
    edges = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    ends = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    place = ends.select("node", F.col("node").alias("at"))
    turn = 0
    while n := edges.count():
        if n <= FEW:
            moves = stored(edges.coalesce(1).mapInArrow(_joined, "old long, new long"), "moves")
            place = stored(_moved(place, "at", moves), "place")
            break
        turn += 1

        def priority(column: str, salt: int = turn):
            return F.xxhash64(F.lit(salt), F.col(column))

        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(F.struct(priority("b").alias("p"), F.col("b"))).alias("m"))
        moves = stored(best.filter(F.col("m.p") < priority("a")).select(F.col("a").alias("old"), F.col("m.b").alias("new")), "moves")
        place = stored(_moved(place, "at", moves), "place")
        contracted = _moved(_moved(edges, "a", moves), "b", moves).filter("a <> b")
        edges = stored(contracted.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    least = place.groupBy("at").agg(F.min("node").alias("component"))
    return place.join(least, "at").select("node", "component")
