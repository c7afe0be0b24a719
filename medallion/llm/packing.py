"""Packing documents into training sequences: bounded-space online best fit, then a merge of what is left.

Every task keeps a fixed number of open windows. A document that fills windows of its own does so; the rest
goes to the open window where it fits best. When it fits none, the fullest window is emitted; if its gap is
worth a cut, it is filled with the head of the document first. Windows still open at the end of a task are
dissolved, and their pieces are packed again over groups of tasks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.tables import small_batches, stored
from medallion.llm.tokens import RANKS, VOCABULARY, tokenized

SEQUENCE = 2048
OPEN_WINDOWS = 32
#: A gap of fewer ids is left as padding rather than cutting a document for it.
MIN_CUT = 8
END_ID = 1
#: So many tasks' remains are merged by one task; each holds at most OPEN_WINDOWS windows.
MERGE_TASKS = 64
_ID_BITS = 32

_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, task int, open boolean"
)
_NAMES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Packer:
    """Open windows of one task. ``place`` takes a length and says where its parts go."""

    def __init__(self, size: int, windows: int, min_cut: int) -> None:
        self.size, self.windows, self.min_cut = size, windows, min_cut
        self.room: list[tuple[int, int]] = []  # (free ids, window), ascending
        self.next = 0

    def _window(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, length: int) -> tuple[list[tuple[int, int, int, int]], list[int]]:
        """Parts (start, length, window, offset) of a document, and the windows that were closed."""
        parts, closed, start = [], [], 0
        while length - start >= self.size:
            window = self._window()
            parts.append((start, self.size, window, 0))
            closed.append(window)
            start += self.size
        while rest := length - start:
            at = bisect_left(self.room, (rest, -1))
            if at < len(self.room):
                free, window = self.room.pop(at)
                parts.append((start, rest, window, self.size - free))
                start = length
                if free > rest:
                    insort(self.room, (free - rest, window))
                else:
                    closed.append(window)
            elif len(self.room) < self.windows:
                insort(self.room, (self.size, self._window()))
            else:
                free, window = self.room.pop(0)
                closed.append(window)
                if free >= self.min_cut:
                    parts.append((start, free, window, self.size - free))
                    start += free
        return parts, closed


def _pack(
    batches: Iterator[pa.RecordBatch], files: tuple[str, str], size: int, windows: int, min_cut: int, task: int | None = None
) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId() if task is None else task
    packer, held = Packer(size, windows, min_cut), {}
    ready: list[tuple] = []

    def batch(rows: list[tuple], is_open: bool) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
        columns += [pa.array(np.full(len(rows), task, np.int32)), pa.array(np.full(len(rows), is_open))]
        return pa.RecordBatch.from_arrays(columns, names=[*_NAMES, "task", "open"])

    for rows, ids, first in tokenized(batches, "_text", *files):
        for doc, begin, end in zip(rows.column("doc_id").to_pylist(), first[:-1], first[1:]):
            own = np.append(ids[begin:end], END_ID).astype("<u4")
            parts, closed = packer.place(len(own))
            for start, length, window, offset in parts:
                crc = zlib.crc32(own[start : start + length].tobytes())
                piece = (doc, start, length, crc, len(own), (task << _ID_BITS) + window, offset)
                held.setdefault(window, []).append(piece)
            for window in closed:
                ready += held.pop(window)
        if len(ready) > 5000:
            yield batch(ready, False)
            ready = []
    if ready:
        yield batch(ready, False)
    if left := [piece for window in held.values() for piece in window]:
        yield batch(left, True)


def _merge(pieces: pd.DataFrame, size: int) -> pd.DataFrame:
    """Pack whole pieces, longest first, each where it fits best."""
    pieces = pieces.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
    room: list[tuple[int, int]] = []
    windows, offsets = [], []
    for length in pieces["length"]:
        at = bisect_left(room, (length, -1))
        free, window = room.pop(at) if at < len(room) else (size, len(windows) and max(windows) + 1)
        windows.append(window)
        offsets.append(size - free)
        if free > length:
            insort(room, (free - length, window))
    group = int(pieces["task"].iloc[0]) // MERGE_TASKS
    # Negative ids: never those of a window that a task has closed.
    return pieces.assign(sequence_id=[-1 - ((group << _ID_BITS) + w) for w in windows], offset=offsets)[list(_NAMES)]


def pack_documents(
    docs: DataFrame,
    vocabulary: tuple[str, str] | None = None,
    size: int = SEQUENCE,
    windows: int = OPEN_WINDOWS,
    min_cut: int = MIN_CUT,
) -> DataFrame:
    """One row per piece: document, place in the document, place in a sequence, crc32 of its ids (little-endian).

    A document is its ids (special strings read as ordinary text) and an end id; each id lies in exactly one
    piece. Null and empty texts are the end id alone. Repeated rows are packed each; an empty table has no
    pieces; other columns are ignored. The remains merged by one task are bounded by ``MERGE_TASKS`` times
    ``windows`` sequences. Packing depends on the partitioning of the input, not on chance: a repeated task
    packs alike. ``vocabulary`` is a tokenizer file and its rank file, which all executors can read.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS)
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    packed = stored(rows.mapInArrow(lambda batches: _pack(batches, vocabulary, size, windows, min_cut), _PIECES), "packed")
    left = packed.filter("open").withColumn("_group", F.floor(F.col("task") / MERGE_TASKS))
    fields = ", ".join(f"{n} long" for n in _NAMES)
    merged = left.groupBy("_group").applyInPandas(lambda pieces: _merge(pieces, size), fields)
    return packed.filter("not open").select(*_NAMES).unionByName(merged)
