"""Product-quantised codes of vectors; nearest entries are found by equal-average search.

Components become whole numbers, vectors are cut into equal parts, and each part position has a codebook that is refined
in rounds of assignment and averaging. A codebook's entries are sorted by the sum of their components. For each part
the search starts at its own sum and goes outward: as the squared gap between two sums, divided by the dimension,
never exceeds the squared distance, it ends as soon as that bound is strictly above the best distance found. All
arithmetic is in whole numbers, so ties are real ties and go to the lower index.

Edge cases: vectors that are null or hold null or non-finite components are left out; a vector shorter than the longest, or
than a multiple of the number of parts, counts as followed by zeros (so an empty one is all zeros); null ids come after all others when
the first entries are chosen, and of a repeated id the smallest vector gives the entry; with fewer ids than entries the codebooks
are smaller; repeated rows get equal codes; an empty table gives an empty result. Components so large that 64 bits might not hold a
distance are computed with Python's unbounded integers; an error beyond 64 bits is null. Other columns may bear any name.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.tables import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Labels up to this number are broadcast with their totals.
BROADCAST_LABELS = 50_000
_LONG_MAX = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Not null, no null component, no infinity, no NaN."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd


def _whole(value: float) -> int:
    """floor(SCALE * value) of any finite float."""
    return int(value) * SCALE if abs(value) >= 1 << 53 else math.floor(SCALE * value)


def _rows(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The batch's vectors as whole numbers, a row each; Python integers if 64 bits might overflow."""
    column = batch.column("vector")
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    top = np.abs(flat).max(initial=0.0)
    if 4 * (width * SCALE * (top + 1)) ** 2 < 2.0**62:
        numbers = np.floor(SCALE * flat).astype(np.int64)
    else:
        numbers = np.array([_whole(x) for x in flat], dtype=object)
    out = np.zeros((len(lengths), width), numbers.dtype)
    out[np.arange(width) < lengths[:, None]] = numbers
    return out


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry for each part (a row), by equal-average search.

    Every step moves each unfinished part to the entry with the next closest sum, on either side of its own.
    """
    rows, dim = parts.shape
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums = sums[order]
    own = parts.sum(axis=1) if dim else np.zeros(rows, np.int64)
    right = np.searchsorted(sums, own)
    left = right - 1
    best = np.full(rows, -1, np.int64)
    distance = np.zeros(rows, parts.dtype)
    open_rows = np.arange(rows)
    for step in range(len(entries)):
        low, high, mine = left[open_rows], right[open_rows], own[open_rows]
        below = np.abs(mine - sums[np.maximum(low, 0)])
        above = np.abs(sums[np.minimum(high, len(sums) - 1)] - mine)
        go_left = (high == len(sums)) | ((low >= 0) & (below <= above).astype(bool))
        gap = np.where(go_left, below, above)
        if step:
            within = (gap * gap <= dim * distance[open_rows]).astype(bool)
            open_rows, go_left, low, high = open_rows[within], go_left[within], low[within], high[within]
            if not len(open_rows):
                break
        entry = order[np.where(go_left, low, high)]
        off = parts[open_rows] - entries[entry]
        found = (off * off).sum(axis=1) if dim else np.zeros(len(open_rows), np.int64)
        kept, at = distance[open_rows], best[open_rows]
        better = (at < 0) | (found < kept).astype(bool) | ((found == kept).astype(bool) & (entry < at))
        best[open_rows] = np.where(better, entry, at)
        distance[open_rows] = np.where(better, found, kept)
        left[open_rows] = low - go_left
        right[open_rows] = high + ~go_left
    return best, distance


def _typed(entries: list[list[list[int]]], parts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Vectors and codebooks in one number type that holds every distance."""
    top = max((abs(x) for book in entries for e in book for x in e), default=0)
    if parts.dtype == object or 4 * (parts.shape[1] * (top + 1)) ** 2 >= 1 << 62:
        parts, kind = parts.astype(object), object
    else:
        kind = np.int64
    return parts, [np.array(book, dtype=kind).reshape(len(book), -1) for book in entries]


def _assigned(batch: pa.RecordBatch, books: list[list[list[int]]], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per part position: its number, the parts, their nearest entries and distances."""
    vectors, typed = _typed(books, _rows(batch, width))
    dim = width // len(books)
    for p, entries in enumerate(typed):
        parts = vectors[:, p * dim : (p + 1) * dim]
        yield p, parts, *nearest(parts, entries)


def _limbs(x: int) -> list[int]:
    """A whole number of any size in pieces of 30 bits, the sign at each; at least one."""
    sign, x, out = (-1 if x < 0 else 1), abs(x), []
    while x or not out:
        out.append(sign * (x & ((1 << 30) - 1)))
        x >>= 30
    return out


def _sums(books: list[list[list[int]]], width: int):
    """Per task the count and component sums of the parts at each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim = width // len(books)
        count = np.zeros((len(books), len(books[0])), np.int64)
        total = np.zeros((len(books), len(books[0]), dim), object)
        for batch in batches:
            for p, parts, entry, _ in _assigned(batch, books, width):
                count[p] += np.bincount(entry, minlength=count.shape[1])
                for e in np.unique(entry):
                    total[p, e] += parts[entry == e].astype(object).sum(axis=0) if parts.dtype == object else parts[entry == e].sum(axis=0)
        out = [
            (p, e, i, k, int(count[p, e]), limb)
            for p, e in zip(*np.nonzero(count), strict=True)
            for i in range(dim)
            for k, limb in enumerate(_limbs(int(total[p, e, i])))
        ]
        columns = zip(*out, strict=True) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "i", "limb", "n", "x"])

    return run


def _codes(books: list[list[list[int]]], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(entry, distance) for _, _, entry, distance in _assigned(batch, books, width)]
            digits = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
            error = sum((distance.astype(object) for _, distance in found), np.zeros(batch.num_rows, object))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.array([row.tobytes().hex() for row in digits], pa.string()),
                    pa.array([int(x) if x <= _LONG_MAX else None for x in error], pa.int64()),
                ],
                names=["id", "label", "code", "error"],
            )

    return run


def _first_entries(rows: DataFrame, entries: int) -> list[list[float]]:
    """The vectors of the smallest ids."""
    ids = rows.select("id").distinct().orderBy(F.col("id").asc_nulls_last()).limit(entries)
    chosen = rows.join(F.broadcast(ids.withColumnRenamed("id", "_id")), F.col("id").eqNullSafe(F.col("_id")))
    least = chosen.groupBy("id").agg(F.min("vector").alias("vector")).collect()
    return [r["vector"] for r in sorted(least, key=lambda r: (r["id"] is None, r["id"] or 0))]


def fit_codebooks(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[list[list[list[int]]], int]:
    """Codebooks per part position and the padded length of vectors. ``rows``: ``id`` and usable ``vector``.

    A round is one pass: tasks send one row per entry, and the driver sees one per entry of each codebook.
    """
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return [], 0
    width = -(-longest // parts) * parts
    dim = width // parts
    first = [[_whole(x) for x in v] + [0] * (width - len(v)) for v in _first_entries(rows, entries)]
    books = [[v[p * dim : (p + 1) * dim] for v in first] for p in range(parts)]
    for _ in range(rounds):
        partial = rows.select("vector").mapInArrow(_sums(books, width), "part long, entry long, i long, limb long, n long, x long")
        totals = partial.groupBy("part", "entry", "i", "limb").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
        sums = defaultdict(int)
        for r in totals:
            sums[r["part"], r["entry"], r["i"]] += r["x"] << 30 * r["limb"]
        for r in totals:
            if r["limb"] == 0:  # the only piece that every task sends
                books[r["part"]][r["entry"]][r["i"]] = sums[r["part"], r["entry"], r["i"]] // r["n"]
    return books, width


def codebooks_digest(books: list[list[list[int]]]) -> str:
    """SHA-256 over all components by part, entry and place, with commas between."""
    return hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()


def compress(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id``, ``label``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every usable vector."""
    rows = vectors.select(vectors[id_column].alias("id"), vectors[vector].cast("array<double>").alias("vector"), vectors[label].alias("label"))
    rows = rows.filter(usable(F.col("vector")))
    books, width = fit_codebooks(rows)
    kinds = dict(rows.dtypes)
    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    if books:
        codes = stored(rows.mapInArrow(_codes(books, width), schema), "vector-codes")
    else:
        codes = rows.limit(0).select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    whole = F.when(F.count("error") == F.count("*"), F.try_sum("error"))
    totals = stored(codes.groupBy(F.col("label").alias("_label")).agg(whole.alias("label_error")), "vector-labels")
    few = totals.count() <= BROADCAST_LABELS
    joined = codes.join(F.broadcast(totals) if few else totals, F.col("label").eqNullSafe(F.col("_label")))
    return joined.drop("_label").withColumn("codebooks_sha256", F.lit(codebooks_digest(books)))
