"""Near duplicates among embeddings: a forest of random-projection trees with spill.

Every tree splits the vectors again and again at a random quantile of a random projection; a vector close to a
split goes to both sides. Vectors that meet in a leaf of any tree are compared exactly. The split points
are fitted on a bounded sample, every vector is indexed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.graph import components
from medallion.llm.tables import stored

COSINE = 0.98
TREES = 6
#: Vectors per leaf aimed at, and rows that one task compares with as many others.
LEAF, BLOCK = 512, 1024
#: Split points are fitted on so many vectors; levels below FITTED use one split point for all their nodes.
SAMPLE, FITTED = 16384, 12


@dataclass(frozen=True)
class Forest:
    directions: np.ndarray  # trees x depth x dimensions
    splits: list[list[np.ndarray]]  # per tree and level: split point of each node, or of all
    spill: float


def fit_forest(sample: np.ndarray, depth: int, trees: int = TREES, cosine: float = COSINE, seed: int = 7) -> Forest:
    """Split points from unit vectors. The spill is half the typical distance of a linked pair along a projection."""
    rng = np.random.default_rng(seed)
    dim = max(sample.shape[1], 1)
    directions = rng.standard_normal((trees, depth, dim))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    splits = []
    for t in range(trees):
        node, levels = np.zeros(len(sample), np.int64), []
        for level in range(depth):
            along = sample @ directions[t, level]
            overall = float(np.median(along)) if len(along) else 0.0
            if level >= FITTED:
                levels.append(np.array([overall]))
                continue
            points = np.full(1 << level, overall)
            order = np.argsort(node, kind="stable")
            edges = np.searchsorted(node[order], np.arange((1 << level) + 1))
            for n in range(1 << level):
                own = along[order[edges[n] : edges[n + 1]]]
                if len(own) >= 16:
                    points[n] = np.quantile(own, rng.uniform(0.4, 0.6))
            levels.append(points)
            node = node * 2 + (along >= points[node])
        splits.append(levels)
    return Forest(directions, splits, math.sqrt(2 * (1 - cosine) / dim) / 2)


def leaves(forest: Forest, unit: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of all vectors in one tree; a row near a split is in several leaves."""
    rows, node = np.arange(len(unit)), np.zeros(len(unit), np.int64)
    for level, points in enumerate(forest.splits[tree]):
        gap = (unit @ forest.directions[tree, level])[rows] - (points[0] if len(points) == 1 else points[node])
        right = gap >= 0
        near = np.flatnonzero(np.abs(gap) < forest.spill)
        node = np.concatenate([node * 2 + right, node[near] * 2 + ~right[near]])
        rows = np.concatenate([rows, rows[near]])
    return rows, node


def _unit(vectors: pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(vectors.flatten(), np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of large or tiny components stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _index(batches: Iterator[pa.RecordBatch], forest: Forest, dim: int) -> Iterator[pa.RecordBatch]:
    """A row per vector and leaf; ``cells`` lists all its leaves as tree and leaf in one number."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 4096):
            part = batch.slice(begin, 4096)
            unit = _unit(part.column("embedding"), dim)
            found = [leaves(forest, unit, t) for t in range(len(forest.splits))]
            rows = np.concatenate([r for r, _ in found])
            cells = np.concatenate([(t << 48) + n for t, (_, n) in enumerate(found)])
            order = np.lexsort((cells, rows))
            rows, cells = rows[order], cells[order]
            edges = np.searchsorted(rows, np.arange(len(unit) + 1))
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(cells))
            taken = pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "cells"]).take(pa.array(rows))
            yield taken.append_column("cell", pa.array(cells))


def _shared_before(left: list[np.ndarray], right: list[np.ndarray], cell: int) -> np.ndarray:
    """Whether two vectors also meet in a cell that counts before ``cell`` (then they are counted there)."""
    known: dict[int, int] = {}

    def matrix(lists: list[np.ndarray]) -> list[tuple[int, int]]:
        return [(i, known.setdefault(int(c), len(known))) for i, cells in enumerate(lists) for c in cells if c < cell]

    a, b = matrix(left), matrix(right)
    if not a or not b:
        return np.zeros((len(left), len(right)), bool)
    x, y = np.zeros((len(left), len(known)), np.float32), np.zeros((len(right), len(known)), np.float32)
    x[tuple(zip(*a))] = 1
    y[tuple(zip(*b))] = 1
    return (x @ y.T) > 0


def _compare(table: pa.Table, cosine: float, dim: int) -> pa.Table:
    """Links among the rows of one leaf (block against itself or another): per vector how many, and whom it reaches."""
    table = table.sort_by("rep")
    cell = table.column("cell")[0].as_py()
    first, second = table.column("p")[0].as_py(), table.column("q")[0].as_py()
    rep, copies = np.asarray(table.column("rep")), np.asarray(table.column("copies"))
    block = np.asarray(table.column("block"))
    unit = _unit(table.column("embedding").combine_chunks(), dim)
    cells = [np.asarray(c.values) for c in table.column("cells")]
    left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
    linked = unit[left] @ unit[right].T >= cosine
    linked &= rep[left][:, None] != rep[right][None, :]
    counts = np.zeros(len(rep), np.int64)
    reach = np.arange(len(rep))
    if linked.any():
        new = linked & ~_shared_before([cells[i] for i in left], [cells[i] for i in right], cell)
        counts[left] += (new * copies[right][None, :]).sum(axis=1)
        if first != second:
            counts[right] += (new * copies[left][:, None]).sum(axis=0)
        while True:  # smallest row reachable, along links of this leaf
            before = reach.copy()
            low = np.where(linked, reach[right][None, :], len(rep)).min(axis=1)
            reach[left] = np.minimum(reach[left], low)
            low = np.where(linked, reach[left][:, None], len(rep)).min(axis=0)
            reach[right] = np.minimum(reach[right], low)
            if (reach == before).all():
                break
    used = (counts > 0) | (reach != np.arange(len(rep)))
    return pa.table({"rep": rep[used], "links": counts[used], "reach": rep[reach[used]]})


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id``, ``embedding``, ``label``).

    Vectors are linked when their labels are equal and their cosine, in double precision, is at least ``cosine``.
    Null vectors and labels, zero vectors and those with a null or non-finite component link with nothing. Equal
    vectors are compared once and count as often as they occur; rows that repeat a vec_id too. A leaf with
    more than ``BLOCK`` vectors is compared block by block in several tasks, so no vector is left out. Vectors
    of different length never link. An empty table gives no row; other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    fine = (
        F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    valid = rows.filter(F.coalesce(fine, F.lit(False))).withColumn("dim", F.size("embedding"))
    # Equal vectors: told by 128 bits of hashes.
    key = ["label", "dim", "k1", "k2"]
    valid = valid.withColumns({"k1": F.xxhash64("embedding"), "k2": F.xxhash64(F.lit(1), "embedding")})
    members = valid.select("vec_id", *key)
    classes = stored(
        valid.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")), "classes"
    )
    parts = []
    for dim, n in sorted((r["dim"], r["n"]) for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()):
        own = classes.filter(F.col("dim") == dim).select("rep", "copies", "label", "embedding")
        sample = own.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("embedding").toArrow()
        depth = max(0, math.ceil(math.log2(max(n, 1) / LEAF)))
        forest = fit_forest(_unit(sample.column("embedding").combine_chunks(), dim), depth, trees, cosine)
        parts.append(_links(own, forest, dim, cosine))
    empty = vectors.sparkSession.createDataFrame([], "rep long, links long, reach long")
    found = empty
    for part in parts:
        found = found.unionByName(part)
    found = stored(found, "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("rep").alias("a"), F.col("reach").alias("b")))
    per_class = (
        classes.select(*key, "rep", "copies")
        .join(links, "rep", "left")
        .join(reached.withColumnRenamed("node", "rep"), "rep", "left")
        .select(*key, (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("c"))
    )
    known = members.join(per_class, key).select("vec_id", F.col("n").alias("n_links"), F.col("c").alias("component_id"))
    alone = rows.filter(~F.coalesce(fine, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return known.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(own: DataFrame, forest: Forest, dim: int, cosine: float) -> DataFrame:
    schema = "rep long, copies long, label {}, embedding array<double>, cells array<long>, cell long".format(
        own.schema["label"].dataType.simpleString()
    )
    indexed = own.mapInArrow(lambda batches: _index(batches, forest, dim), schema)
    sizes = stored(indexed.groupBy("label", "cell").agg(F.count("*").alias("size")).filter("size > 1"), "leaves")
    blocks = F.ceil(F.col("size") / BLOCK)
    placed = indexed.join(sizes, ["label", "cell"]).withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("rep"), blocks)})
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = placed.withColumn("other", others).withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")})
    return (
        pairs.select("label", "cell", "p", "q", "block", "rep", "copies", "embedding", "cells")
        .groupBy("label", "cell", "p", "q")
        .applyInArrow(lambda table: _compare(table, cosine, dim), "rep long, links long, reach long")
    )
