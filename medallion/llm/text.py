"""Vectorised work on batches of texts: word bounds and 64-bit word hashes, without a Python loop per word.

A batch is one byte array holding all texts in a row plus their offsets. Hashes are prefix sums of
``value[byte] * P**position``, so the hash of any byte range costs two lookups.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Work on a part takes some hundred bytes for each of its bytes.
CHUNK_BYTES = 1 << 18
_P = 0x9E3779B97F4A7C15 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)
_MASK = (1 << 64) - 1

# White space of the word definition: blank and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
# Letters, digits, apostrophe and all bytes of non-ASCII characters.
WORD_CHARS = np.zeros(256, bool)
WORD_CHARS[[0x27, *range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
# Characters of scripts written without blanks: Thai, Lao, Myanmar, Khmer, Tai, kana, Bopomofo and ideographs.
_SINGLE = [
    (0x0E00, 0x0F00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x1950, 0x19E0), (0x1A20, 0x1AB0), (0x2E80, 0x2FE0),
    (0x3005, 0x3008), (0x3021, 0x302A), (0x3031, 0x3130), (0x31A0, 0x3200), (0x3400, 0x4DC0), (0x4E00, 0xA000),
    (0xA9E0, 0xAA00), (0xAA60, 0xAAE0), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x16FE0, 0x18D80), (0x1AFF0, 0x1B300), (0x20000, 0x32400),
]
_JOINS, _BORDER, _ALONE = 0, 1, 2
# Marks inside words: soft hyphen, joiners, the curly apostrophe.
_INNER = [0xAD, 0x200C, 0x200D, 0x2019]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_LOWER_VALUE = _BYTE_VALUE[LOWER]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column, and ``rows + 1`` offsets into them. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    if column.null_count:
        column = column.fill_null(b"" if wide == pa.large_binary() else "")
    column = column.cast(wide)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_chunks(batch: pa.RecordBatch, name: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch between rows into parts of about ``size`` bytes: first row, end row, bytes, offsets.

    A row is never cut; a text longer than ``size`` makes a part of its own.
    """
    data, offsets = text_bytes(batch.column(name))
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = max(int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1, first + 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


class Powers:
    """Powers of the hash base and of its inverse, grown to the longest part seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _P), ("down", _P_INVERSE)):
                steps = np.full(size, base & _MASK, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


def bounds(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of ``inside`` bytes; a run never crosses a text boundary."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


_KINDS: list[np.ndarray] = []  # filled where it is needed; travels with functions that use it


def _kinds() -> np.ndarray:
    """Per code point whether it joins a word, ends it or is a word of its own."""
    if _KINDS:
        return _KINDS[0]
    kinds = np.full(0x110000, _JOINS, np.uint8)
    for low, high in _SINGLE:
        kinds[low:high] = _ALONE
    for point in [*range(0x80, 0x33000), *range(0xE0000, 0xE0200)]:
        if unicodedata.category(chr(point))[0] in "PSZ" or unicodedata.category(chr(point)) in ("Cc", "Cf"):
            kinds[point] = _BORDER
    kinds[0x2E80:0x2FE0] = _ALONE  # radicals count as symbols
    kinds[_INNER] = _JOINS
    _KINDS.append(kinds)
    return kinds


def script_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word: a run of letters and digits, or one character of a script without blanks."""
    inside, cuts = WORD_CHARS[data], [offsets]
    lead = np.flatnonzero(data >= 0xC2)
    if len(lead):
        last = len(data) - 1
        more = 1 + (data[lead] >= 0xE0).astype(np.int64) + (data[lead] >= 0xF0)
        point = data[lead].astype(np.int64) & (0x3F >> more)
        for k in (1, 2, 3):
            point = np.where(more >= k, point << 6 | (data[np.minimum(lead + k, last)] & 0x3F), point)
        kind = _kinds()[np.minimum(point, 0x10FFFF)]
        border = kind == _BORDER
        for k in range(4):
            inside[np.minimum(lead[border & (more >= k)] + k, last)] = False
        alone = kind == _ALONE
        cuts += [lead[alone], np.minimum(lead[alone] + more[alone] + 1, last + 1)]
    return bounds(inside, np.concatenate(cuts))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hash of each byte range, A-Z read as a-z."""
    powers.reach(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER_VALUE[data] * powers.up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * powers.down[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between white space: starts, ends, hashes, and per text the index of its first word (rows + 1)."""
    starts, ends = bounds(~SPACE[data], offsets)
    return starts, ends, range_hashes(data, starts, ends, powers), np.searchsorted(starts, offsets)


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words; a text with fewer words has one, over all its words.

    Returns the hashes and per text the index of its first shingle (rows + 1).
    """
    counts = np.diff(first)
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    length = np.minimum(counts, k)
    row = np.repeat(np.arange(len(counts)), sizes)
    at = first[:-1][row] + np.arange(begin[-1]) - begin[:-1][row]
    total = np.full(len(at), 0, np.uint64)
    span = length[row]
    for j in range(k):
        step = np.minimum(at + j, max(len(hashes) - 1, 0))
        total = np.where(j < span, mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[step] + np.uint64(j + 1)), total) if len(at) else total
    return total, begin
