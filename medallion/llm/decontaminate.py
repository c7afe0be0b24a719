"""Benchmark items found in documents, up to a share of edited words.

Items are cut into parts of at most 60 words; if an item matches, some part matches with its share of the edits. Parts, and
windows of documents as long, are embedded by random walks (CGK): each step emits the word under a pointer, which moves on
or stays by a random bit of that word, so walks over texts of small edit distance fall into step and emit mostly equal
words: edit distance becomes Hamming distance. Words sampled from the emitted sequence are the key of a hash table. How many walks
a length needs for the recall wanted is found by embedding random edited texts of that length. Windows begin at
every word near which enough three-word runs of items stand for a match. Where a window meets a part, the words
around must hold as many of the item's runs as the edits leave whole, and are compared with the whole item by exact edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.jaccard import BROADCAST_IDS
from medallion.llm.tables import small_batches, stored
from medallion.llm.text import Powers, mix, range_hashes, script_bounds, text_bytes, text_chunks

#: Edited words allowed, as a share of the item's words.
EDITS = 0.2
#: Items with fewer words are too short to be told from ordinary text.
MIN_WORDS = 2
RUN = 3
#: Longer items are sought by parts of this many words at most.
PART_WORDS = 60
#: Share of edited parts that the walks must find; parts of long items are many, so items are found more often.
RECALL = 0.9995
#: Keys of a walk, emitted words of a key.
SAMPLES, KEY_WORDS = 16, 2
#: Random texts that tell how many walks a length needs, and walks tried on each.
TRIALS, TRIED_WALKS = 400, 48
#: Window lengths grow by this factor; a part is sought with the nearest one.
GROWTH = 1.1
MARK_BITS = 18
#: Cells of a table held at once: keys of windows, words of regions.
CELLS = 1 << 21
#: Items searched for in one pass over the documents.
BLOCK_ITEMS = 20_000


def allowed_edits(words: np.ndarray | int):
    return np.where(np.asarray(words) >= 6, np.floor(EDITS * np.asarray(words) + 1e-9), 0).astype(np.int64)


@dataclass(frozen=True)
class Parts:
    """Parts of items of one window length."""

    window: int
    steps: tuple[np.ndarray, np.ndarray]  # of the walks
    least: int  # item runs that a match leaves whole, at least
    keys: np.ndarray  # sorted keys of all tables
    item: np.ndarray  # per key its item, and the part's place in it
    at: np.ndarray
    marks: np.ndarray  # first bits that some key has


@dataclass(frozen=True)
class Items:
    """Items in a row, and how they are found."""

    ids: np.ndarray
    words: np.ndarray
    first: np.ndarray  # items + 1
    edits: np.ndarray
    runs: np.ndarray  # sorted hashes of all runs
    parts: list[Parts]
    members: np.ndarray  # sorted hashes of a run and its item
    pairs: np.ndarray  # sorted hashes of the items of two words
    pair_item: np.ndarray


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends = script_bounds(data, offsets)
    return range_hashes(data, starts, ends, powers), np.searchsorted(starts, offsets), starts, ends


def _runs(words: np.ndarray, k: int = RUN) -> np.ndarray:
    if len(words) < k:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + words[j : len(words) - k + 1 + j])
    return total


def _member(runs: np.ndarray, item: np.ndarray) -> np.ndarray:
    return mix(runs + mix(item.astype(np.uint64) + np.uint64(1)))


def _steps(window: int, walks: int) -> tuple[np.ndarray, np.ndarray]:
    """Random multipliers (walks x steps) and sampled steps (walks x samples x key words) of a window length."""
    multipliers, sampled = [], []
    for walk in range(walks):
        rng = np.random.default_rng((window, walk))
        multipliers.append(rng.integers(1, 1 << 62, 2 * window, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        sampled.append(rng.integers(0, max(1, int(1.9 * window)), (SAMPLES, KEY_WORDS)))
    return np.array(multipliers), np.array(sampled)


def walk_keys(
    words: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int, walks: int, steps: tuple[np.ndarray, np.ndarray] | None = None
) -> np.ndarray:
    """Keys (ranges x walks * samples) of word ranges: what random walks over each range show at the sampled steps."""
    multipliers, sampled = steps or _steps(window, walks)
    padded = np.append(words, np.uint64(0))
    at = np.broadcast_to(starts.astype(np.int64), (walks, len(starts))).copy()
    last = ends.astype(np.int64)
    # All walks over all ranges go one step at a time; only sampled steps are kept.
    kept, slot = np.unique(sampled, return_inverse=True)
    seen, due = np.empty((len(kept), walks, len(starts)), np.uint64), 0
    for step in range(int(kept[-1]) + 1):
        word = padded[np.where(at < last, at, len(words))]
        if kept[due] == step:
            seen[due] = word
            due += 1
        at += (word * multipliers[:, step, None] >> np.uint64(63)).astype(np.int64)
    key = np.broadcast_to(np.arange(walks * SAMPLES, dtype=np.uint64).reshape(walks, SAMPLES, 1), (walks, SAMPLES, len(starts)))
    every = np.arange(walks)[:, None]
    for chosen in np.moveaxis(slot.reshape(sampled.shape), 2, 0):
        key = mix(key * np.uint64(31) + seen[chosen, every])
    return key.reshape(walks * SAMPLES, len(starts)).T


def walks_needed(window: int, length: int, edits: int, recall: float = RECALL) -> int:
    """Walks after which a part of ``length`` words with ``edits`` random edits shares a key with its original, at that rate.

    Measured on random texts: each one's rate per walk counts by itself, as hard texts stay hard for every walk.
    """
    if edits == 0:
        return 1
    rng = np.random.default_rng((window, length, edits))
    originals, changed = [], []
    for _ in range(TRIALS):
        words = rng.integers(1, 1 << 62, length + edits).tolist()
        fresh, one = words[length:], words[:length]
        originals.append(list(one))
        for word in fresh:
            at, turn = int(rng.integers(len(one))), rng.random()
            if turn < 0.4:
                one[at] = word
            elif turn < 0.7:
                del one[at]
            else:
                one.insert(at, word)
        changed.append((one + rng.integers(1, 1 << 62, length + edits).tolist())[:window])
    sides = []
    for texts in (originals, changed):
        flat = np.array([w for t in texts for w in t], np.uint64)
        ends = np.cumsum([len(t) for t in texts])
        sides.append(walk_keys(flat, np.concatenate([[0], ends[:-1]]), ends, window, TRIED_WALKS))
    met = (sides[0] == sides[1]).reshape(TRIALS, TRIED_WALKS, SAMPLES).any(axis=2).sum(axis=1)
    missed = 1 - (met + 0.5) / (TRIED_WALKS + 1)
    walks = 1
    while (missed**walks).mean() > 1 - recall:
        walks += 1
    return walks


def prepare(ids: list[int], texts: pa.Array) -> Items:
    data, offsets = text_bytes(texts)
    words, first, _, _ = word_hashes(data, offsets, Powers())
    lengths = np.diff(first)
    kept = np.flatnonzero(lengths >= MIN_WORDS)
    words = words[np.repeat(lengths >= MIN_WORDS, lengths)]
    lengths = lengths[kept]
    first = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    # Runs inside one item.
    item = np.repeat(np.arange(len(kept)), lengths - RUN + 1)
    at = np.arange(len(item)) + item * (RUN - 1)
    grams = _runs(words)
    runs = np.unique(grams[at])
    # Parts of items by window length.
    pieces = -(-lengths // PART_WORDS)
    owner = np.repeat(np.arange(len(kept)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin, end = first[owner] + nth * lengths[owner] // pieces[owner], first[owner] + (nth + 1) * lengths[owner] // pieces[owner]
    size, share = end - begin, allowed_edits(lengths)[owner] // pieces[owner]
    # Items without edits are sought at their very length.
    window = np.where(share == 0, size, np.maximum(RUN, np.round(GROWTH ** np.round(np.log(np.maximum(size, 1)) / np.log(GROWTH)))))
    parts = []
    for w in np.unique(window[size >= RUN]).astype(int):
        rows = np.flatnonzero((window == w) & (size >= RUN))
        hardest = rows[np.argmax(share[rows] / size[rows])]
        walks = walks_needed(w, int(size[hardest]), int(share[hardest]))
        least = int(np.maximum(size[rows] - RUN + 1 - RUN * share[rows], 1).min())
        keys = walk_keys(words, begin[rows], end[rows], w, walks)
        order = np.argsort(keys.ravel(), kind="stable")
        of = rows[order // keys.shape[1]]
        marks = np.zeros(1 << MARK_BITS, bool)
        marks[(keys.ravel() >> np.uint64(64 - MARK_BITS)).astype(np.int64)] = True
        parts.append(Parts(w, _steps(w, walks), least, keys.ravel()[order], owner[of], begin[of] - first[owner[of]], marks))
    two = np.flatnonzero(lengths == 2)
    pairs = _runs(words, 2)[first[two]] if len(two) else np.zeros(0, np.uint64)
    order = np.argsort(pairs, kind="stable")
    return Items(
        np.array(ids, np.int64)[kept], words, first, allowed_edits(lengths), runs, parts, np.unique(_member(grams[at], item)),
        pairs[order], two[order],
    )


def infix_distance(pattern: np.ndarray, lengths: np.ndarray, region: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of each pattern to any part of its region (zero-padded rows), and where that part ends."""
    n, width = region.shape
    across = np.arange(width + 1)
    row = np.zeros((n, width + 1), np.int32)
    best, end = np.full(n, np.iinfo(np.int32).max), np.zeros(n, np.int64)
    for i in range(pattern.shape[1]):
        step = np.empty_like(row)
        step[:, 0] = i + 1
        np.minimum(row[:, :-1] + ((region != pattern[:, i : i + 1]) | (region == 0)), row[:, 1:] + 1, out=step[:, 1:])
        row = np.minimum.accumulate(step - across, axis=1) + across
        done = np.flatnonzero(lengths == i + 1)
        if len(done):
            end[done] = row[done].argmin(axis=1)
            best[done] = row[done, end[done]]
    return best, end


def _contains(known: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in the sorted array, and whether it is there."""
    slot = np.minimum(np.searchsorted(known, x), len(known) - 1)
    return slot, known[slot] == x


def _starts(first: np.ndarray, hits: np.ndarray, window: int, least: int) -> np.ndarray:
    """First words of windows around which ``least`` runs stand close enough for a match."""
    slack = window // 4 + 1
    at = np.flatnonzero(hits)
    if len(at) < least:
        return np.zeros(0, np.int64)
    low, high = at[: len(at) - least + 1], at[least - 1 :]
    owner = np.searchsorted(first, low, side="right") - 1
    close = (high - low < window + 2 * slack) & (high < first[owner + 1])
    low, high, owner = low[close], high[close], owner[close]
    begin, end = np.maximum(high - window - slack + 1, first[owner]), np.minimum(low + slack, first[owner + 1] - 1)
    # Overlapping stretches of starts, counted by where they begin and end.
    open_at = np.zeros(len(hits) + 1, np.int64)
    np.add.at(open_at, begin, 1)
    np.add.at(open_at, np.maximum(end, begin - 1) + 1, -1)
    return np.flatnonzero(np.cumsum(open_at) > 0)


def _meet(words: np.ndarray, first: np.ndarray, hits: np.ndarray, part: Parts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows that share a key with a part: first word of the window, item, the part's place in it."""
    starts = _starts(first, hits, part.window, part.least)
    walks = len(part.steps[0])
    step = max(1, CELLS // (walks * max(8 * SAMPLES, 2 * part.window)))
    for cut in range(0, len(starts), step):
        at = starts[cut : cut + step]
        ends = np.minimum(at + part.window, first[np.searchsorted(first, at, side="right")])
        keys = walk_keys(words, at, ends, part.window, walks, part.steps).ravel()
        # Most keys are no part's; a look at their first bits tells so.
        maybe = np.flatnonzero(part.marks[(keys >> np.uint64(64 - MARK_BITS)).astype(np.int64)])
        keys = keys[maybe]
        low, high = np.searchsorted(part.keys, keys), np.searchsorted(part.keys, keys, side="right")
        size = high - low
        for piece in _parts_of(size):
            many = size[piece]
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            known = np.repeat(low[piece], many) + nth
            window = np.repeat(maybe[piece], many) // (walks * SAMPLES)
            yield at[window], part.item[known], part.at[known]


def _parts_of(size: np.ndarray) -> Iterator[slice]:
    """Stretches of rows that stand for about CELLS cells."""
    edges = np.searchsorted(np.cumsum(size) // CELLS, np.arange(int(size.sum()) // CELLS + 2))
    yield from (slice(a, b) for a, b in zip(edges[:-1], edges[1:]) if b > a)


def _candidates(words: np.ndarray, first: np.ndarray, hits: np.ndarray, items: Items) -> tuple[np.ndarray, ...]:
    """Regions (text, item, first word, end word) around windows that met a part and hold enough runs of any item."""
    lengths = np.diff(items.first)
    # Each edited word changes at most RUN runs.
    least, slack = np.maximum(lengths - RUN + 1 - RUN * items.edits, 1), lengths // 4 + 1
    total = np.concatenate([[0], np.cumsum(hits)])
    shift = int(lengths.max()) + 1
    places = len(hits) + 2 * shift
    found = [np.zeros(0, np.int64)]
    for part in items.parts:
        for at, item, offset in _meet(words, first, hits, part):
            text = np.searchsorted(first, at, side="right") - 1
            # A match starts as far before the part as in the item, up to the edits; one region serves ``slack`` starts.
            place = (at - offset - first[text]) // slack[item]
            found.append(np.unique((text * len(lengths) + item) * places + place + shift))
    key = np.unique(np.concatenate(found))
    text, item = key // places // len(lengths), key // places % len(lengths)
    begin = first[text] + (key % places - shift) * slack[item] - items.edits[item]
    end = np.minimum(begin + slack[item] + lengths[item] + 2 * items.edits[item], first[text + 1])
    begin = np.maximum(begin, first[text])
    good = total[np.maximum(end - RUN + 1, begin)] - total[begin] >= least[item]
    order = np.argsort(lengths[item[good]], kind="stable")
    return tuple(x[good][order] for x in (text, item, begin, end))


def _parts(width: np.ndarray) -> Iterator[slice]:
    """Rows in a row that hold about CELLS cells at their largest width (ascending)."""
    low = 0
    while low < len(width):
        high = low + max(1, CELLS // int(width[min(low + 2047, len(width) - 1)]))
        yield slice(low, min(high, low + 2048))
        low = min(high, low + 2048)


def _pairs(words: np.ndarray, first: np.ndarray, items: Items) -> tuple[np.ndarray, ...]:
    """Items of two words: text, item, distance, word where it ends; the first place per text."""
    shown = _runs(words, 2) if len(items.pairs) else np.zeros(0, np.uint64)
    low, high = np.searchsorted(items.pairs, shown), np.searchsorted(items.pairs, shown, side="right")
    at = np.flatnonzero(high > low)
    text = np.searchsorted(first, at, side="right") - 1
    at, text = at[at + 2 <= first[text + 1]], text[at + 2 <= first[text + 1]]
    _, one = np.unique(np.stack([text, low[at]]), axis=1, return_index=True)
    at, text = at[one], text[one]
    size = high[at] - low[at]
    nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    item = items.pair_item[np.repeat(low[at], size) + nth]
    return np.repeat(text, size), item, np.zeros(len(item), np.int64), np.repeat(at + 2, size)


def _search(words: np.ndarray, first: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Verified (text, item, distance, word where the match ends) among all texts in a part."""
    out = [_pairs(words, first, items)]
    grams = _runs(words)
    if len(grams) == 0 or len(items.runs) == 0:
        return out[0]
    hits = np.zeros(len(words), bool)
    hits[: len(grams)] = _contains(items.runs, grams)[1]
    last = first[1:][np.diff(first) > 0]
    hits[np.concatenate([last - 1, np.maximum(last - 2, 0)])] = False  # runs that would cross into the next text
    lengths = np.diff(items.first)
    least = np.maximum(lengths - RUN + 1 - RUN * items.edits, 1)
    text, item, begin, end = _candidates(words, first, hits, items)
    width = lengths + 2 * items.edits + lengths // 4 + 1
    # Runs of this very item.
    enough = np.zeros(len(item), bool)
    for rows in _parts(width[item]):
        i = item[rows]
        index = begin[rows][:, None] + np.arange(int(width[i].max()))
        row, column = np.nonzero((index < end[rows][:, None] - RUN + 1) & hits[np.minimum(index, len(hits) - 1)])
        _, own = _contains(items.members, _member(grams[index[row, column]], i[row]))
        enough[rows] = np.bincount(row[own], minlength=len(i)) >= least[i]
    text, item, begin, end = text[enough], item[enough], begin[enough], end[enough]
    for rows in _parts(width[item]):
        i = item[rows]
        index = items.first[i][:, None] + np.arange(int(lengths[i].max()))
        pattern = np.where(index < items.first[i + 1][:, None], items.words[np.minimum(index, len(items.words) - 1)], np.uint64(0))
        index = begin[rows][:, None] + np.arange(int(width[i].max()))
        region = np.where(index < end[rows][:, None], words[np.minimum(index, len(words) - 1)], np.uint64(0))
        distance, last = infix_distance(pattern, lengths[i], region)
        good = distance <= items.edits[i]
        out.append((text[rows][good], i[good], distance[good].astype(np.int64), (begin[rows] + last)[good]))
    return tuple(np.concatenate(c) for c in zip(*out))


_MATCH = "doc_id long, item_id long, distance int, item_words int, end int"


def _find(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
    powers, lengths = Powers(), np.diff(items.first)
    for batch in batches:
        for begin, _, data, offsets in text_chunks(batch):
            words, first, _, ends = word_hashes(data, offsets, powers)
            best: dict[tuple[int, int], tuple[int, int]] = {}
            for t, item, distance, end in zip(*_search(words, first, items)):
                key, place = (int(t), int(item)), int(ends[end - 1] - offsets[t])
                best[key] = min(best.get(key, (1 << 30, 0)), (int(distance), place))
            if best:
                docs = batch.column("doc_id").to_pylist()
                out = [(docs[begin + t], int(items.ids[i]), d, int(lengths[i]), e) for (t, i), (d, e) in sorted(best.items())]
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, x) for c, x in zip(zip(*out), types)], names=[f.split()[0] for f in _MATCH.split(", ")]
                )


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, distance, item_words, end``: items found in documents, once per row and item, at best distance.

    ``distance`` counts inserted, deleted and replaced words (runs of letters and digits, A-Z as a-z; each character
    of a script without blanks is a word); up to 20 % of the item's words are allowed, none for items under six words;
    items of one word are not sought.
    ``end`` is the byte of the text where the match ends. Null and empty texts hold nothing; rows with a null
    doc_id are reported with it; a repeated item is reported per item_id; items without id are ignored. Whole texts
    are searched. Items come in blocks of ``BLOCK_ITEMS``, one pass over the documents each.
    """
    small_batches(docs.sparkSession)
    items = benchmark.filter("item_id is not null and text is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    total = items.count()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.sparkSession.createDataFrame([], _MATCH)
    blocks = -(-total // BLOCK_ITEMS)
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id").toArrow()
        sought = prepare(part.column("item_id").to_pylist(), part.column("text").combine_chunks())
        found = found.unionByName(rows.mapInArrow(lambda b, s=sought: _find(b, s), _MATCH))
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents, all columns, in which no benchmark item is found; rows without doc_id are judged as one document."""
    leaks = stored(find_leaks(docs, benchmark).select("doc_id").distinct(), "leaks").withColumnRenamed("doc_id", "_leak")
    side = F.broadcast(leaks) if leaks.count() <= BROADCAST_IDS else leaks
    return docs.join(side, docs["doc_id"].eqNullSafe(leaks["_leak"]), "left_anti")
