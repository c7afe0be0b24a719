"""Byte-level BPE ids of whole texts, with each distinct piece of a task tokenized once.

The vocabulary's pre-tokenizer splits a text into pieces (words with their leading blank, numbers, marks,
white space) that are merged independently. The split is done for a whole batch at once; distinct pieces go to
the tokenizer, and their ids are laid out again in text order. The ids equal those of whole-text tokenization.
Short pieces, nearly all, are merged from the vocabulary's rank file, which is several times faster than the
full tokenizer; long ones go through the tokenizer itself, whose time stays in proportion to the length.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from medallion.llm.text import Powers, mix, text_chunks

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
SHORT_PIECE = 48
CACHE_PIECES = 300_000
_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
# The English endings that the vocabulary's split takes as pieces of their own.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def character_classes() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    import regex

    kinds = np.full(0x110000, _OTHER, np.uint8)
    patterns = [(kind, regex.compile(p)) for kind, p in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+"))]
    for low in range(0, len(kinds), 0x800):  # a part at a time: as a whole, the characters take more than 100 MB
        if 0xD800 <= low < 0xE000:
            continue
        part = "".join(map(chr, range(low, low + 0x800)))
        for kind, pattern in patterns:
            for run in pattern.finditer(part):
                kinds[low + run.start() : low + run.end()] = kind
    return kinds


def piece_starts(symbols: np.ndarray, edges: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Starts of all pieces, as positions in ``symbols`` (code points of texts in a row; ``edges``: their bounds)."""
    n = len(symbols)
    kind = kinds[symbols]
    edge = np.zeros(n + 1, bool)
    edge[edges] = True
    start = np.ones(n + 1, bool)
    start[1:n] = (kind[1:] != kind[:-1]) | edge[1:n]
    # The last blank before a word belongs to the word; other white space before it stands alone.
    blank = kind == _SPACE
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & ~edge[1:n])
    start[last] = True
    start[last[symbols[last] == 0x20] + 1] = False
    # An ending after an apostrophe, where a piece begins there.
    mark = np.flatnonzero((symbols == 0x27) & start[:n])
    taken = np.zeros(len(mark), bool)
    padded = np.concatenate([symbols, np.zeros(2, symbols.dtype)])
    cut = np.concatenate([edge, np.ones(2, bool)])
    for ending in ENDINGS:
        hit = ~taken
        for j, letter in enumerate(ending):
            hit &= (padded[np.minimum(mark + 1 + j, n + 1)] == ord(letter)) & ~cut[mark + 1 + j]
        at = mark[hit]
        start[at + 1] = False
        start[at + 1 + len(ending)] = True
        taken |= hit
    return np.flatnonzero(start[:n])


class PieceTokenizer:
    """Ids of batches of texts. Holds at most ``CACHE_PIECES`` pieces beside those of one batch."""

    def __init__(self, path: str, ranks: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.short = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=merges, special_tokens={})
        # Strings of the vocabulary's added tokens are one id each wherever they occur.
        self.added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile(b"|".join(re.escape(t.encode()) for t in longest)) if longest else None
        self.kinds = character_classes()
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
        self.powers = Powers()
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        short, whole = self.short.encode_ordinary, self.tokenizer.encode
        ids = [
            [self.added[p]] if p in self.added else short(p) if len(p) <= SHORT_PIECE else whole(p, add_special_tokens=False).ids
            for p in pieces
        ]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        starts = len(self.ids) + np.concatenate([[0], np.cumsum(counts)[:-1]])
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum()))
        self.ids = np.concatenate([self.ids, flat])
        everything = np.concatenate([self.hashes, hashes])
        order = np.argsort(everything, kind="stable")
        self.hashes = everything[order]
        self.starts = np.concatenate([self.starts, starts])[order]
        self.counts = np.concatenate([self.counts, counts])[order]

    def _added_spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of all strings of added tokens, row by row where there are any."""
        begins, stops = [], []
        if self.added_pattern:
            raw = data.tobytes()
            at = self.added_pattern.search(raw)
            while at:
                row = int(np.searchsorted(offsets, at.start(), side="right")) - 1
                end = int(offsets[row + 1])
                for hit in self.added_pattern.finditer(raw, int(offsets[row]), end):
                    begins.append(hit.start())
                    stops.append(hit.end())
                at = self.added_pattern.search(raw, end)
        return np.array(begins, np.int64), np.array(stops, np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and ``rows + 1`` offsets into them."""
        if len(data) == 0:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        symbols = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        at_byte = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        begins, stops = self._added_spans(data, offsets)
        edges = np.sort(np.concatenate([offsets, begins, stops]))
        starts = at_byte[piece_starts(symbols, np.searchsorted(at_byte, edges), self.kinds)]
        if len(begins):
            span = np.searchsorted(begins, starts, side="left") - 1  # the last that begins before
            starts = starts[(span < 0) | (starts >= stops[np.maximum(span, 0)])]
        ends = np.append(starts[1:], len(data))
        self.powers.reach(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers.up[: len(data)], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * self.powers.down[starts] + (ends - starts).astype(np.uint64))
        distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > CACHE_PIECES:
            self._clear()
        slot = np.minimum(np.searchsorted(self.hashes, distinct), max(len(self.hashes) - 1, 0))
        new = self.hashes[slot] != distinct if len(self.hashes) else np.ones(len(distinct), bool)
        if new.any():
            raw, where = data.tobytes(), example[new]
            self._learn(distinct[new], [raw[a:b].decode() for a, b in zip(starts[where], ends[where])])
        slot = np.searchsorted(self.hashes, distinct)[which]
        counts = self.counts[slot]
        end = np.cumsum(counts)
        index = np.repeat(self.starts[slot] - (end - counts), counts) + np.arange(end[-1])
        first = np.searchsorted(starts, offsets)
        return self.ids[index], np.concatenate([[0], end])[first]


def tokenized(
    batches: Iterator[pa.RecordBatch], name: str, path: str, ranks: str
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of each part of a batch with their ids and id offsets."""
    tokenizer = PieceTokenizer(path, ranks)
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch, name):
            yield batch.slice(first, end - first), *tokenizer.encode(data, offsets)
