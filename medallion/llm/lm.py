"""Log-likelihood of whole documents under a gated recurrent language model learnt from the corpus.

Counts of all training words are exact and stay distributed. The most frequent words are clustered by the company
they keep and binned by frequency into classes; other words have classes by their form. A recurrent network
gives the probability of the next word's class; inside a class a word's softmax logit is the log of its count.
The network is trained in parallel on all training documents; tasks' weights are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm import gru
from medallion.llm.tables import BATCH_BYTES, batches_of, held_out, stored, usual_batches
from medallion.llm.text import LOWER, Powers, mix, text_bytes, text_chunks, words

MODULUS, HELD = 7, 2
#: Words with classes of their own; words with an embedding of their own; words whose counts every task holds.
HEAD, INPUTS, COMMON = 16_384, 4_096, 200_000
CLUSTERS, BINS = 6, 6
SHAPES = 48
PROFILE = 64
#: Bits of a hash that lead to its place among the common words.
LEADING = 18
#: Input partitions whose words' profiles one task sums.
COMPANY_PARTS = 4
#: Documents and most frequent words whose counts are held as a matrix for profiles.
COMPANY_DOCUMENTS, COMPANY_TOP = 256, 1_024
#: Each training document trains the network in one of as many rounds.
ROUNDS = 3
#: Words that train the network in one go.
STREAMED = 3_000_000
#: Words that a task sorts at a time to count them; some 35 bytes for each.
COUNTED = 1_000_000
#: Distinct words that a task counts before it hands them on.
DISTINCT = 1_000_000
#: Texts to score go to Python in batches of this size, and are scored side by side up to this many bytes. Fewer side by side
#: would take more time: 3.1 s a batch of 16 MB at 4 MB, 4.6 s at 1 MB.
SCORED_BATCH, SCORED_BYTES = "4m", 6 << 20
END = np.uint64(0x5851F42D4C957F2D)


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Form of a word: kind of its end, and a hash of the last two bytes before closing marks."""
    last = data[ends - 1]
    letter = (last >= 0x80) | ((LOWER[last] >= 0x61) & (LOWER[last] <= 0x7A))
    stop = (last == 0x2C) | (last == 0x2E)
    kind = np.where(letter, 0, np.where(stop, 1, 2))
    cut = np.maximum(ends - np.where(letter, 0, np.where(stop, 1, 3)), starts + 1)
    a, b = LOWER[data[cut - 1]].astype(np.uint64), LOWER[data[np.maximum(cut - 2, starts)]].astype(np.uint64)
    return (kind * 16 + (mix(a * np.uint64(256) + b) & np.uint64(15)).astype(np.int64)).astype(np.int64)


def document_words(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shapes of all words, an end after each text; and per text the index of its first (rows + 1)."""
    starts, ends, hashes, first = words(data, offsets, powers)
    at = first[1:]
    hashes = np.insert(hashes, at, END)
    forms = np.insert(shapes(data, starts, ends) if len(starts) else np.zeros(0, np.int64), at, SHAPES - 1)
    return hashes, forms, first + np.arange(len(first))


def distinct_words(hashes: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, ascending, the form and the number of each. Equal words have equal forms."""
    # Plain sorts are much faster than sorting positions, so forms are sorted in place of the hashes' last bits.
    few = np.uint64(63)
    both = np.sort((hashes & ~few) | forms.astype(np.uint64))
    hashes_up = np.sort(hashes)
    new = np.ones(len(hashes), bool)
    np.not_equal(hashes_up[1:], hashes_up[:-1], out=new[1:])
    at = np.flatnonzero(new)
    distinct = hashes_up[at]
    if (np.diff(distinct >> np.uint64(6)) == 0).any():  # words that differ in the last bits alone
        distinct, first, n = np.unique(hashes, return_index=True, return_counts=True)
        return distinct, forms[first], n
    return distinct, (both[at] & few).astype(forms.dtype), np.diff(np.append(at, len(hashes)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers, held, size = Powers(), [], 0
    counted: list[tuple] = []  # distinct words of earlier parts

    def merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, forms, n = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(hashes)
        hashes = hashes[order]
        at = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        return hashes[at], forms[order[at]], np.add.reduceat(n[order], at)

    def report() -> pa.RecordBatch:
        hashes, forms, n = counted.pop()
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(forms.astype(np.int32)), pa.array(n)], names=["word", "shape", "n"])

    for batch in batches:
        for _, _, data, offsets in text_chunks(batch):
            hashes, forms, _ = document_words(data, offsets, powers)
            held.append((hashes, forms.astype(np.uint8)))
            size += len(hashes)
            if size >= COUNTED:
                counted = [merged([*counted, distinct_words(*(np.concatenate(x) for x in zip(*held)))])]
                held, size = [], 0
                if len(counted[0][0]) >= DISTINCT:
                    yield report()
    if held:
        counted = [merged([*counted, distinct_words(*(np.concatenate(x) for x in zip(*held)))])]
    if counted:
        yield report()


@dataclass(frozen=True)
class Words:
    """What every task knows: the most frequent words with counts, and classes."""

    common: np.ndarray  # sorted hashes
    counts: np.ndarray
    rank: np.ndarray  # place by frequency, 0 the most frequent
    classes: np.ndarray  # class by rank, for the first HEAD words
    log_mass: np.ndarray  # natural log of the normaliser inside each class
    own: int  # number of classes of frequent words; the shapes follow

    @cached_property
    def _places(self) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first common word by leading bits, and the words with one more at the end."""
        edges = np.arange(1 << LEADING, dtype=np.uint64) << np.uint64(64 - LEADING)
        return np.searchsorted(self.common, edges).astype(np.int32), np.append(self.common, ~np.uint64(0))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word in ``common`` (any, if it is not there) and whether it is there."""
        if len(self.common) == 0:
            return np.zeros(len(hashes), np.int32), np.zeros(len(hashes), bool)
        first, words = self._places
        slot = first[hashes >> np.uint64(64 - LEADING)]
        below = np.flatnonzero(words[slot] < hashes)
        while len(below):
            slot[below] += 1
            below = below[words[slot[below]] < hashes[below]]
        np.minimum(slot, len(self.common) - 1, out=slot)
        return slot, words[slot] == hashes

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each word (or the number of common words) and whether it is common."""
        slot, found = self.find(hashes)
        return np.where(found, self.rank[slot], len(self.common)) if len(self.common) else slot, found

    def read(self, ranks: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Network input and class of each word."""
        inputs = np.where(ranks < INPUTS, ranks, INPUTS + forms)
        if len(self.classes) == 0:
            return inputs, self.own + forms
        own = ranks < len(self.classes)
        return inputs, np.where(own, self.classes[np.minimum(ranks, len(self.classes) - 1)], self.own + forms)


def _previous(inputs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """What is read before each step: the word before, or the end at the start of a document."""
    before = np.empty_like(inputs)
    before[1:] = inputs[:-1]
    before[first[:-1]] = INPUTS + SHAPES
    return before


def _ids(batches: Iterator[pa.RecordBatch], known: Words) -> Iterator[pa.RecordBatch]:
    """Ranks and shapes of the words of each document, as one number of four bytes each."""
    powers = Powers()
    for batch in batches:
        for begin, end, data, offsets in text_chunks(batch):
            hashes, forms, first = document_words(data, offsets, powers)
            ranks, _ = known.look_up(hashes)
            codes, places = (ranks * SHAPES + forms).astype("<i4"), (4 * first).astype(np.int64)
            # As bytes: Spark would handle the elements of arrays one by one, each time they are read.
            coded = pa.Array.from_buffers(pa.large_binary(), end - begin, [None, pa.py_buffer(places), pa.py_buffer(codes)])
            yield pa.RecordBatch.from_arrays([batch.column("turn").slice(begin, end - begin), coded.cast(pa.binary())], names=["turn", "ids"])


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ``_ids`` of all documents in a row, and per document the index of its first (rows + 1)."""
    data, offsets = text_bytes(batch.column("ids"))
    return data.view("<i4"), offsets // 4


def _sum_rows(batches: Iterator[pa.RecordBatch], size: int, merge: int) -> Iterator[pa.RecordBatch]:
    """One row: the sum of all rows' vectors and weights."""
    total, weight, task = np.zeros(size), 0.0, None
    for batch in batches:
        for t, w, v in zip(*(batch.column(c) for c in ("task", "weight", "vector"))):
            total += np.frombuffer(v.as_buffer(), np.float64)
            weight += w.as_py()
            task = t.as_py()
    if task is not None:
        yield _row(task // merge, weight, total)


def _row(task: int, weight: float, vector: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array([task], pa.int64()), pa.array([weight], pa.float64()), pa.array([vector.astype(np.float64).tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["task", "weight", "vector"])


_ROW = "task long, weight double, vector binary"


def summed(rows: DataFrame, size: int, merge: int = 64) -> tuple[np.ndarray, float]:
    """Sum of the tasks' vectors, in steps: at most ``merge`` rows and 64 MB per task, until so few are left for the driver."""
    merge = max(2, min(merge, (1 << 23) // size))
    rows = stored(rows, "vectors")
    left = rows.count()
    while left > merge:
        left = -(-left // merge)
        rows = rows.repartition(left, F.floor(F.col("task") / merge)).mapInArrow(lambda b: _sum_rows(b, size, merge), _ROW)
        rows = stored(rows, "vectors")
        left = rows.count()
    total, weight = np.zeros(size), 0.0
    for row in rows.collect():
        total += np.frombuffer(row["vector"], np.float64)
        weight += row["weight"]
    return total, weight


def _company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per frequent word the summed profiles of the documents it occurs in. A profile: shares of the top words."""
    total = np.zeros((HEAD, PROFILE))
    for batch in batches:
        codes, first = _codes(batch)
        for low in range(0, len(first) - 1, COMPANY_DOCUMENTS):
            edges = first[low : low + COMPANY_DOCUMENTS + 1]
            docs, ranks = len(edges) - 1, codes[edges[0] : edges[-1]] // SHAPES
            doc = np.repeat(np.arange(docs), np.diff(edges))
            # Counts by document of the words that most documents hold; of the others, word by word below.
            top = ranks < COMPANY_TOP
            times = np.bincount(doc[top] * COMPANY_TOP + ranks[top], minlength=docs * COMPANY_TOP).reshape(docs, -1).astype(float)
            norm = np.sqrt((times[:, :PROFILE] ** 2).sum(axis=1, keepdims=True))
            profiles = times[:, :PROFILE] / np.maximum(norm, 1)  # at least 1, if there is any
            total[:COMPANY_TOP] += times.T @ profiles
            other = np.flatnonzero(~top & (ranks < HEAD))
            ranks, cuts = ranks[other], np.searchsorted(doc[other], np.arange(docs + 1))
            for profile, begin, end in zip(profiles, cuts[:-1], cuts[1:]):
                seen, count = np.unique(ranks[begin:end], return_counts=True)
                total[seen] += count[:, None] * profile
    yield _row(TaskContext.get().partitionId(), 1.0, total.ravel())


def cluster_words(company: np.ndarray, counts: np.ndarray, seed: int = 3, rounds: int = 25) -> tuple[np.ndarray, int]:
    """Class of each frequent word: a cluster by direction (k-means on the sphere), then bins of equal mass in it."""
    n = len(counts)
    x = company[:n] / np.maximum(np.linalg.norm(company[:n], axis=1, keepdims=True), 1e-9)
    rng = np.random.default_rng(seed)
    weight = np.sqrt(counts.astype(float))
    centres = x[rng.integers(0, max(1, min(n, 200)), 1)]
    while len(centres) < CLUSTERS:  # spread the first centres
        far = (1 - (x @ centres.T).max(axis=1)).clip(0) * weight
        centres = np.concatenate([centres, x[[int(far.argmax())]]])
    for _ in range(rounds):
        cluster = (x @ centres.T).argmax(axis=1)
        for k in range(CLUSTERS):
            mass = (x[cluster == k] * weight[cluster == k, None]).sum(axis=0)
            norm = np.linalg.norm(mass)
            if norm:
                centres[k] = mass / norm
    classes = np.zeros(n, np.int64)
    for k in range(CLUSTERS):
        own = np.flatnonzero(cluster == k)
        if len(own):
            before = np.cumsum(counts[own]) - counts[own]
            classes[own] = k * BINS + np.minimum(before * BINS // counts[own].sum(), BINS - 1)
    return classes, CLUSTERS * BINS


def _streams(batches: Iterator[pa.RecordBatch], known: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Inputs, classes and starts of documents in a row, about STREAMED words at a time."""
    held: list[tuple] = []
    for batch in batches:
        codes, first = _codes(batch)
        inputs, classes = known.read(codes // SHAPES, codes % SHAPES)
        fresh = np.zeros(len(codes), bool)
        fresh[first[:-1]] = True
        held.append((_previous(inputs, first).astype(np.int32), classes.astype(np.int32), fresh))
        if sum(len(x[0]) for x in held) >= STREAMED:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held = []
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _train(batches: Iterator[pa.RecordBatch], known: Words, p: gru.Params) -> Iterator[pa.RecordBatch]:
    weight = 0
    for inputs, classes, fresh in _streams(batches, known):
        p, weight = gru.train(p, inputs, classes, fresh), weight + len(inputs)
    if weight:
        yield _row(TaskContext.get().partitionId(), float(weight), gru.flat(p) * weight)


@dataclass(frozen=True)
class Model:
    words: Words
    network: gru.Params
    counts: DataFrame
    total: int
    distinct: int


def frequent_words(counts: DataFrame, most: int) -> DataFrame:
    """The ``most`` words of ``counts`` (word, n) with the largest n, by smaller word among equals.

    Histograms of n, and of words where very many share the last n, find first what can be among them, so that the one task
    that sorts them reads little more than ``most`` rows, not as many from every task. Both have bounded numbers of steps.
    """
    level = F.floor(F.log2("n") * 16).cast("int")
    steps = counts.groupBy(level.alias("level")).agg(F.count("*").alias("size"), F.min("n").alias("low"), F.max("n").alias("high"))
    seen = 0
    for step in sorted(steps.collect(), key=lambda r: -r["level"]):
        before, seen = seen, seen + step["size"]
        if seen < most:
            continue
        likely = F.col("n") >= step["low"]
        if step["low"] == step["high"]:
            place = F.shiftright("word", 52)
            ties = counts.filter(F.col("n") == step["low"]).groupBy(place.alias("place")).agg(F.count("*").alias("size"))
            for tie in sorted(ties.collect(), key=lambda r: r["place"]):
                before += tie["size"]
                if before >= most:
                    likely = (F.col("n") > step["low"]) | ((F.col("n") == step["low"]) & (place <= tie["place"]))
                    break
        counts = counts.filter(likely)
        break
    return counts.orderBy(F.desc("n"), "word").limit(most)


def learn(docs: DataFrame) -> Model:
    """Exact counts over all training documents (crc32(doc_id) modulo 7 not 2), classes, and the network."""
    usual_batches(docs.sparkSession)
    training = docs.filter(~held_out("doc_id", MODULUS, HELD)).select("doc_id", "text")
    parts = training.select("text").mapInArrow(_count, "word long, shape int, n long")
    with batches_of(docs.sparkSession, BATCH_BYTES):
        counts = stored(parts.groupBy("word").agg(F.sum("n").alias("n"), F.min("shape").alias("shape")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = frequent_words(counts, COMMON).toArrow()
    hashes = np.asarray(top.column("word").combine_chunks()).view(np.uint64)
    n, shape = np.asarray(top.column("n").combine_chunks()), np.asarray(top.column("shape").combine_chunks())
    order = np.argsort(hashes)
    known = Words(hashes[order], n[order], order, np.zeros(0, np.int64), np.zeros(0), 0)

    turn = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(ROUNDS)).cast("int").alias("turn")
    with batches_of(docs.sparkSession, BATCH_BYTES):
        ids = stored(training.select(turn, "text").mapInArrow(lambda b: _ids(b, known), "turn int, ids binary"), "ids")
    # A task's profiles take 8 MB however few documents it has, so there are fewer tasks, though one for each core.
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, ids.rdd.getNumPartitions() // COMPANY_PARTS)
    company, _ = summed(ids.coalesce(tasks).mapInArrow(_company, _ROW), HEAD * PROFILE)
    head = min(HEAD, len(n))
    classes, own = cluster_words(company.reshape(HEAD, PROFILE), n[:head]) if head else (np.zeros(0, np.int64), 0)

    # Normalisers: frequent words by their counts, other words by counts plus one, and one for the unknown.
    by_shape = {r["shape"]: (r["n"], r["v"]) for r in counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    mass = np.zeros(own + SHAPES)
    if head:
        mass[:own] = np.bincount(classes, n[:head], minlength=own)
    frequency = mass.copy()
    for s in range(SHAPES):
        all_n, all_v = by_shape.get(s, (0, 0))
        mine = shape[:head] == s
        frequency[own + s] = all_n - n[:head][mine].sum()
        mass[own + s] = frequency[own + s] + (all_v - mine.sum()) + 1
    known = Words(known.common, known.counts, known.rank, classes.astype(np.int32), np.log(np.maximum(mass, 1)), own)

    network = gru.initial(INPUTS + SHAPES + 1, frequency)
    for turn in range(ROUNDS):
        now = network
        rows = ids.filter(F.col("turn") == turn).select("ids").mapInArrow(lambda b, p=now: _train(b, known, p), _ROW)
        vector, weight = summed(rows, gru.flat(now).size)
        if weight:
            network = gru.unflat(vector / weight, now)
    return Model(known, network, counts, int(total), int(distinct))


_SCORED = "row long, doc_id long, n_tokens long, n_common long, common_log double, class_log double, rare array<long>, times array<int>"


def _score(batches: Iterator[pa.RecordBatch], known: Words, p: gru.Params) -> Iterator[pa.RecordBatch]:
    powers, row = Powers(), TaskContext.get().partitionId() << 33
    head = len(known.classes)
    log_plus = np.log10(known.counts + 1.0)
    # Inside its class a frequent word has its count, another word its count plus one.
    log_own = np.where(known.rank < head, np.log10(np.maximum(known.counts, 1)) - log_plus, 0.0)
    value = -known.log_mass
    for batch in batches:
        # Equal parts: each has its few long texts, which are read side by side with nothing else at the end.
        whole = int(pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0)
        for begin, end, data, offsets in text_chunks(batch, size=whole // -(-whole // SCORED_BYTES) + 1 if whole else 1):
            pieces = [document_words(*part, powers) for part in _cut(data, offsets)]
            hashes, forms = np.concatenate([x[0] for x in pieces]), np.concatenate([x[1].astype(np.int32) for x in pieces])
            first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[2]) for x in pieces]))])
            del pieces
            slot, found = known.find(hashes)
            ranks = np.where(found, known.rank[slot] if len(known.common) else 0, len(known.common)).astype(np.int32)
            inputs, classes = known.read(ranks, forms)
            score = gru.document_scores(p, _previous(inputs, first), classes, first, value) / np.log(10)
            plus = np.where(found, log_plus[slot], 0.0) if len(known.common) else np.zeros(len(hashes))
            shift = np.where(found, log_own[slot], 0.0) if len(known.common) else plus
            starts = first[:-1]
            common = np.add.reduceat(plus, starts)
            rare_at = np.flatnonzero(~found)
            text = np.searchsorted(first, rare_at, side="right") - 1
            order = np.lexsort((hashes[rare_at], text))
            text, rare = text[order], hashes[rare_at][order]
            new = np.ones(len(rare), bool)
            new[1:] = (text[1:] != text[:-1]) | (rare[1:] != rare[:-1])
            place = np.flatnonzero(new)
            times = np.diff(np.append(place, len(rare)))
            edges = pa.array(np.searchsorted(text[place], np.arange(end - begin + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(end - begin)),
                    batch.column("doc_id").slice(begin, end - begin),
                    pa.array(np.diff(first)),
                    pa.array(np.add.reduceat(found.astype(np.int64), starts)),
                    pa.array(common),
                    pa.array(score + np.add.reduceat(shift, starts) + common),
                    pa.ListArray.from_arrays(edges, pa.array(rare[place].view(np.int64))),
                    pa.ListArray.from_arrays(edges, pa.array(times, pa.int32())),
                ],
                names=[f.split()[0] for f in _SCORED.split(", ")],
            )
            row += end - begin


def _cut(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Parts of about a megabyte for the work per byte."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = max(int(np.searchsorted(offsets, offsets[first] + (1 << 20), side="right")) - 1, first + 1)
        yield data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Words are runs of bytes other than white space, A-Z as a-z, told apart by 64-bit hashes; an end is counted after
    them, so null and empty texts have one token. ``base_score`` is the unigram log10 probability with one
    added to each count, ``score`` the model's. Rows without doc_id are scored and count as held out; repeated rows
    score alike; other columns are ignored. With no training documents both scores rest on the unknown word.
    """
    usual_batches(docs.sparkSession)
    known, network = model.words, model.network
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with batches_of(docs.sparkSession, SCORED_BATCH):
        scored = stored(rows.mapInArrow(lambda b: _score(b, known, network), _SCORED), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("t"))
    found = (
        rare.join(model.counts.select("word", "n"), "word")
        .groupBy("row")
        .agg(F.sum("t").alias("known"), F.sum(F.col("t") * F.log10(F.col("n") + 1)).alias("log"))
    )
    size = np.log10(model.total + model.distinct + 1.0)
    log = F.coalesce("log", F.lit(0.0))
    return scored.select("row", "doc_id", "n_tokens", "n_common", "common_log", "class_log").join(found, "row", "left").select(
        "doc_id",
        held_out("doc_id", MODULUS, HELD).alias("held_out"),
        "n_tokens",
        (F.col("n_common") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("common_log") + log - F.col("n_tokens") * F.lit(float(size))).alias("base_score"),
        (F.col("class_log") + log).alias("score"),
    )
