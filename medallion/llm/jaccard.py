"""Documents linked by the Jaccard similarity of their word shingles, joined through a token-group matrix.

Documents with equal sets are one class. Classes are partitioned into groups of similar documents: those
with an equal min-hash band are compared with the band's first class, what is linked stays together, and what shares
its most frequent band forms a group, linked or not. The
matrix says which group holds which token. Two sets with a similarity of 80 % share a token among the
first fifth of either set, in any order of tokens common to all, so the matrix keeps those alone; frequent tokens
come last in the order. A member meets another group only if it holds a token of that group's row and their sizes fit,
and two groups whose members meet are opened only if the union of their tokens, folded into counts per token class, allows the
overlap that a link needs. Members of opened groups, and those of one group, meet in blocks: a task bounds the overlaps of two
blocks by bit maps as long as the sets, without their texts. Where few pairs are left, their texts are compared exactly; where
many are left, a task reads the texts of both blocks and returns no more links than join its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.graph import components
from medallion.llm.tables import small_batches, stored
from medallion.llm.text import Powers, mix, shingle_hashes, text_bytes, text_chunks, words

WORDS, PERCENT = 5, 80
BINS, BANDS = 8, 4
FOLDS = 64
#: A set of n tokens has a map of n to 2n bits, this many at least.
LEAST_BITS = 256
#: Tokens counted at a time by a task, and how often one must occur there to be reported as frequent.
COUNTED, REPORTED = 4_000_000, 2
#: Frequent tokens: in so many documents at least; the list is broadcast and holds the most frequent ones.
FREQUENT, FREQUENT_KEPT = 32, 200_000
#: So many neighbouring partitions are counted by one task, which sees frequent tokens better than a small one.
COUNT_TOGETHER = 8
#: Documents of a block, and tokens unless one document has more; what is linked beyond a block is a group of its own.
BLOCK, BLOCK_TOKENS = 256, 1 << 20
#: Two blocks whose bit maps leave more pairs than so many a document are compared by a task that reads all their texts.
PAIRS_KEPT = 2
#: Cells of a matrix of bits that is unpacked at a time.
UNPACKED = 1 << 22
#: Ids up to this many (8 MB) are broadcast to pick their texts, more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _needed(n: np.ndarray | int):
    """Smallest overlap with a linked set of at least the same size as one's own similarity allows."""
    return -(-PERCENT * n // 100)


def _tokens(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    powers = Powers()
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch, name):
            _, _, hashes, first_word = words(data, offsets, powers)
            yield batch.slice(first, end - first), *shingle_hashes(hashes, first_word, WORDS)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens that occur REPORTED times or more among COUNTED tokens of a task."""
    held, n = np.empty(COUNTED, np.uint64), 0

    def report(own: np.ndarray) -> pa.RecordBatch:
        own.sort()  # in place, and only what repeats is taken out: the tokens are held once
        again = own[1:][own[1:] == own[:-1]]
        start = np.flatnonzero(np.concatenate([again[:1] == again[:1], again[1:] != again[:-1]]))
        counts = np.diff(np.append(start, len(again))) + 1
        often = counts >= REPORTED
        return pa.RecordBatch.from_arrays([pa.array(again[start[often]].view(np.int64)), pa.array(counts[often])], names=["token", "n"])

    for _, tokens, _ in _tokens(batches):
        while len(tokens):
            fits = tokens[: COUNTED - n]
            held[n : n + len(fits)] = fits
            n, tokens = n + len(fits), tokens[len(fits) :]
            if n == COUNTED:
                yield report(held)
                n = 0
    if n:
        yield report(held[:n])


def frequent_tokens(docs: DataFrame) -> np.ndarray:
    """Hashes of frequent tokens, rarest first: at most FREQUENT_KEPT. They only order tokens; any list is exact."""
    texts = docs.select("text")
    tasks = max(2 * docs.sparkSession.sparkContext.defaultParallelism, texts.rdd.getNumPartitions() // COUNT_TOGETHER)
    counts = texts.coalesce(tasks).mapInArrow(_frequent, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "token").limit(FREQUENT_KEPT)
    return np.asarray(top.select("token").toArrow().column("token").combine_chunks())[::-1].view(np.uint64)


_SIGNATURE = "doc_id long, n_shingles long, f1 long, f2 long, prefix array<long>, bands array<long>, folds array<int>, bits binary"


def _bit_map(own: np.ndarray) -> bytes:
    """Bits of the tokens' lowest bits; the lower half of a map joined with its upper half is the map of half the length."""
    size = max(LEAST_BITS, 1 << (len(own) - 1).bit_length())
    marks = np.zeros(size, bool)
    marks[(own & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").tobytes()


def _signatures(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.argsort(frequent)
    by_hash = np.append(frequent[order], np.uint64(0))
    rank = np.append(order, 0)
    for rows, tokens, first in _tokens(batches):
        slot = np.searchsorted(by_hash[:-1], tokens)
        is_frequent = (by_hash[slot] == tokens) & (slot < len(frequent))
        sums, sizes, prefixes, bands, maps = [], [], [], [], []
        folds = np.zeros((rows.num_rows, FOLDS), np.int32)
        for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
            own, at = np.unique(tokens[a:b], return_index=True)
            n = len(own)
            sizes.append(n)
            if n == 0:
                sums.append((0, 0))
                prefixes.append(own)
                bands.append(own)
                maps.append(b"")
                continue
            sums.append((own.sum(), mix(own).sum()))
            often = is_frequent[a:b][at]
            if often.any():
                late = own[often]
                late = late[np.argsort(rank[slot[a:b][at][often]])]
                ordered = np.concatenate([own[~often], late])
            else:
                ordered = own
            prefixes.append(ordered[: n - _needed(n) + 1])
            bins = np.zeros(BINS, np.uint64)
            bin_of = (own & np.uint64(BINS - 1)).astype(np.int64)
            bins[bin_of[::-1]] = own[::-1]  # the smallest of each bin is written last
            filled = (bins[0::2] > 0) | (bins[1::2] > 0)
            bands.append(mix(bins[0::2] * np.uint64(31) + bins[1::2] + np.arange(BANDS, dtype=np.uint64))[filled])
            maps.append(_bit_map(own))
            folds[i] = np.bincount((own >> np.uint64(58)).astype(np.int64), minlength=FOLDS)
        pair = np.array(sums, np.uint64).reshape(-1, 2).view(np.int64)

        def lists(parts: list[np.ndarray]) -> pa.Array:
            edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            values = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
            return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values))

        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(np.ascontiguousarray(pair[:, 0])),
                pa.array(np.ascontiguousarray(pair[:, 1])),
                lists(prefixes),
                lists(bands),
                pa.ListArray.from_arrays(pa.array(np.arange(rows.num_rows + 1) * FOLDS, pa.int32()), pa.array(folds.ravel())),
                pa.array(maps, pa.binary()),
            ],
            names=[f.split()[0] for f in _SIGNATURE.split(", ")],
        )


def _sets(column: pa.Array, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    _, _, hashes, first_word = words(data, offsets, powers)
    return shingle_hashes(hashes, first_word, WORDS)


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= PERCENT * (len(a) + len(b) - both)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole texts have similar enough sets."""
    powers = Powers()
    for batch in batches:
        for begin in range(0, batch.num_rows, 32):
            rows = batch.slice(begin, 32)
            (x, xs), (y, ys) = _sets(rows.column("ta"), powers), _sets(rows.column("tb"), powers)
            keep = [_similar(np.unique(x[xs[i] : xs[i + 1]]), np.unique(y[ys[i] : ys[i + 1]])) for i in range(rows.num_rows)]
            yield rows.select(["a", "b"]).filter(pa.array(keep))


def _texts(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of those ids, one row each. Texts of other documents are not moved."""
    ids = stored(ids.distinct(), "ids")
    chosen = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return stored(docs.select("doc_id", "text").join(chosen, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")


def verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those pairs (``a``, ``b``) of doc_ids whose texts are linked."""
    pairs = stored(pairs, "pairs")
    texts = _texts(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))), docs)
    sides = [texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}")) for x in ("a", "b")]
    rows = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "ta", "tb")
    return rows.mapInArrow(_linked, "a long, b long")


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose folded unions leave room for the overlap of a link between sets of ``na`` and ``nb`` tokens at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        x, y = (np.asarray(batch.column(c).flatten()).reshape(-1, FOLDS) for c in ("fa", "fb"))
        room = np.minimum(x, y).sum(axis=1, dtype=np.int64)
        least = np.asarray(batch.column("na")) + np.asarray(batch.column("nb"))
        keep = room * (100 + PERCENT) >= PERCENT * least
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _opened(pairs: DataFrame, of_a: DataFrame, of_b: DataFrame) -> DataFrame:
    """Pairs that may hold a link, by the matrix rows of either end: id, n (least size), folds."""
    for x, matrix in (("a", of_a), ("b", of_b)):
        pairs = pairs.join(matrix.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("folds").alias(f"f{x}")), x)
    return pairs.mapInArrow(_open, "a long, b long")


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose bit maps leave room for a link: a bit that only one map has stands for a token that only one set has."""
    for batch in batches:
        keep = []
        for na, nb, xa, xb in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "xa", "xb"))):
            bits = 8 * min(len(xa), len(xb))
            maps = []
            for data in (xa, xb):
                value = int.from_bytes(data, "little")
                for half in range(len(data) * 8 // bits, 1, -1):
                    value = (value & ((1 << (half - 1) * bits) - 1)) | (value >> (half - 1) * bits)
                maps.append(value)
            x, y = maps
            room = min(na - (x & ~y).bit_count(), nb - (y & ~x).bit_count())
            keep.append(room * (100 + PERCENT) >= PERCENT * (na + nb))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _met(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """Pairs of documents that may be linked, by their bit maps."""
    for x in ("a", "b"):
        maps = heads.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("bits").alias(f"x{x}"))
        pairs = pairs.join(maps, x)
    return pairs.mapInArrow(_may_link, "a long, b long")


def _unpacked(maps: list[bytes], bits: int) -> np.ndarray:
    """One row of 0 and 1 per map, all maps of one length, folded to ``bits``."""
    rows = np.unpackbits(np.frombuffer(b"".join(maps), np.uint8).reshape(len(maps), -1), axis=1, bitorder="little")
    return rows.reshape(len(maps), -1, bits).max(axis=1).astype(np.float32)


def _room(xa: np.ndarray, na: np.ndarray, xb: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Bound of the overlap of each left set with each right set, as in ``_may_link``."""
    both = xa @ xb.T
    return np.minimum((na - xa.sum(axis=1))[:, None] + both, (nb - xb.sum(axis=1))[None, :] + both)


def _left_over(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs of the ``left`` and the other documents of two blocks that may be linked and are not joined yet."""
    left = np.asarray(table.column("left"))
    n, place = (np.asarray(table.column(c)) for c in ("n_shingles", "place"))
    maps = table.column("bits").to_pylist()
    lengths = 8 * np.array([len(m) for m in maps], np.int64)
    for la in np.unique(lengths[left]):
        for lb in np.unique(lengths[~left]):
            if max(la, lb) > 2 * min(la, lb):
                continue  # the longer set has more than twice the tokens
            bits = int(min(la, lb))
            step = max(1, UNPACKED // int(max(la, lb)))
            xs, ys = np.flatnonzero(left & (lengths == la)), np.flatnonzero(~left & (lengths == lb))
            for p in range(0, len(xs), step):
                x = xs[p : p + step]
                ux = _unpacked([maps[i] for i in x], bits)
                for q in range(0, len(ys), step):
                    y = ys[q : q + step]
                    room = _room(ux, n[x], _unpacked([maps[i] for i in y], bits), n[y])
                    may = room * (100 + PERCENT) >= PERCENT * (n[x][:, None] + n[y][None, :])
                    i, j = np.nonzero(may & (place[x][:, None] != place[y][None, :]))
                    yield x[i], y[j]


_MET = "ga long, gb long, i int, j int, a long, b long"


def _block_pairs(table: pa.Table) -> pa.Table:
    """Pairs of two blocks that may be linked, by their bit maps; one row without them if there are too many."""
    table = table.combine_chunks()
    ids = np.asarray(table.column("doc_id"))
    pairs, n = [np.empty((0, 2), np.int64)], 0
    for x, y in _left_over(table):
        pairs.append(np.sort(np.stack([ids[x], ids[y]], axis=1), axis=1))
        n += len(x)
        if n > PAIRS_KEPT * table.num_rows:
            break
    own = table.select(["ga", "gb", "i", "j"])
    if n > PAIRS_KEPT * table.num_rows:
        ends = [pa.nulls(1, pa.int64())] * 2
    else:
        found = np.unique(np.concatenate(pairs), axis=0)  # within a block each pair is met from both sides
        ends = [pa.array(np.ascontiguousarray(found[:, k])) for k in (0, 1)]
    own = own.take(pa.array(np.zeros(len(ends[0]), np.int64)))
    return own.append_column("a", ends[0]).append_column("b", ends[1])


def _overlaps(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Tokens that each of the sets at ``rows`` has in common with each of those at ``columns``."""
    sizes = np.array([len(own) for own in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[token] > 1
    owner, token = np.repeat(np.arange(len(sets)), sizes)[shared], (np.cumsum(count > 1) - 1)[token[shared]]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    step = max(1, UNPACKED // len(sets))
    both = np.zeros((len(rows), len(columns)))
    for first in range(0, int(token[-1]) + 1 if len(token) else 0, step):
        a, b = np.searchsorted(token, (first, first + step))
        marks = np.zeros((len(sets), min(step, int(token[-1]) + 1 - first)), np.float32)
        marks[owner[a:b], token[a:b] - first] = 1
        both += marks[rows] @ marks[columns].T
    return both


def _block_links(table: pa.Table) -> pa.Table:
    """Links between the ``left`` and the other documents of two blocks, without those that others of them imply."""
    table = table.combine_chunks()
    left = np.asarray(table.column("left"))
    ids, one, of = np.unique(np.asarray(table.column("doc_id")), return_index=True, return_inverse=True)
    place = np.asarray(table.column("place"))[one]
    tokens, first = _sets(table.column("text").take(pa.array(one)).combine_chunks(), Powers())
    sets = [np.unique(tokens[a:b]) for a, b in zip(first[:-1], first[1:])]
    x, y = of[left], of[~left]
    both = _overlaps(sets, x, y)
    sizes = np.array([len(own) for own in sets])
    linked = (both > 0) & (100 * both >= PERCENT * (sizes[x][:, None] + sizes[y][None, :] - both)) & (place[x][:, None] != place[y][None, :])
    up: dict[int, int] = {}

    def root(c: int) -> int:
        while up.setdefault(c, c) != c:
            up[c] = c = up[up[c]]
        return c

    found = []
    for i, j in np.argwhere(linked).tolist():
        i, j = x[i], y[j]
        a, b = root(int(place[i])), root(int(place[j]))
        if a != b:
            up[a] = b
            found.append((int(ids[i]), int(ids[j])))
    ends = list(zip(*found)) or [(), ()]
    return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})


def _blocks():
    """Number of blocks of a group's rows with ``n_shingles``, as an aggregate."""
    return F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_TOKENS)).cast("int")


_KEY, _PAIR = ["ga", "gb"], ["ga", "gb", "i", "j"]


def _dealt(members: DataFrame) -> DataFrame:
    """Members, with their other columns, once for each pair of blocks (ga, gb, i, j) that they are in."""
    start = F.when(F.expr("ga = gb and left"), F.col("own")).otherwise(0)
    end = F.when(~F.col("left"), F.when(F.expr("ga = gb"), F.col("own")).otherwise(F.col("ki") - 1)).otherwise(F.col("kj") - 1)
    met = members.withColumn("other", F.explode(F.sequence(start, end)))
    met = met.withColumn("i", F.when(F.col("left"), F.col("own")).otherwise(F.col("other")))
    return met.withColumn("j", F.when(F.col("left"), F.col("other")).otherwise(F.col("own"))).drop("own", "other", "ki", "kj")


def _together(met: DataFrame):
    """Rows by pair of blocks. Work follows the number of pairs, so small partitions are not put together by their bytes."""
    return met.repartition(int(met.sparkSession.conf.get("spark.sql.shuffle.partitions")), *_PAIR).groupBy(*_PAIR)


def _compared(left: DataFrame, right: DataFrame, heads: DataFrame, place: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) between the members (ga, gb, doc_id, ki, kj) of two sides with equal ``ga``, ``gb``, whose numbers of
    blocks are ``ki`` and ``kj``; within a group (``ga = gb``, both sides equal) each pair of blocks meets once. ``place``
    says what is joined already. Texts go only to what the bit maps leave."""

    def turn(k: str):
        return F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.col(k)).cast("int")

    lefts = left.select(*_KEY, "doc_id", F.lit(True).alias("left"), turn("ki").alias("own"), "kj", "ki")
    rights = right.select(*_KEY, "doc_id", F.lit(False).alias("left"), turn("kj").alias("own"), "kj", "ki")
    members = stored(lefts.unionByName(rights), "members")
    known = heads.select("doc_id", "n_shingles", "bits").join(place, "doc_id")
    met = stored(_together(_dealt(members.join(known, "doc_id"))).applyInArrow(_block_pairs, _MET), "met")
    links = verify(met.filter("a is not null").select("a", "b"), docs)
    many = met.filter("a is null").select(*_PAIR)
    if many.isEmpty():
        return links
    full = stored(_dealt(members).join(many, _PAIR, "left_semi"), "full")
    full = full.join(_texts(full.select("doc_id"), docs), "doc_id").join(place, "doc_id")
    return links.unionByName(_together(full).applyInArrow(_block_links, "a long, b long"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``: smallest doc_id that links of similarity >= 80 % reach.

    A set is a document's distinct runs of five words; with fewer words the whole sequence is its one run, without
    words it is empty and linked with nothing. Runs are told apart by 64-bit hashes. Null texts are empty; rows
    without doc_id have no component; rows that repeat a doc_id should repeat its text (else the smaller set of hashes
    decides for all of them). An empty table gives no row; other columns are ignored. Sets of any length and
    groups of any size are compared exactly; no token or partner is dropped.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    frequent = frequent_tokens(docs)
    signed = stored(docs.mapInArrow(lambda batches: _signatures(batches, frequent), _SIGNATURE), "signatures")
    known = signed.filter("doc_id is not null and n_shingles > 0").select("doc_id", "n_shingles", "f1", "f2")
    key = ["n_shingles", "f1", "f2"]
    classes = known.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    member = stored(known.join(classes, key).groupBy("doc_id").agg(F.min("rep").alias("rep")), "members")
    reps = member.filter("doc_id = rep").select("doc_id")
    heads = stored(signed.join(reps, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "heads")

    # Groups of similar documents.
    band = heads.select("doc_id", F.explode("bands").alias("band"))
    lead = band.groupBy("band").agg(F.min("doc_id").alias("a"), F.count("*").alias("n")).filter("n > 1")
    banded = stored(band.join(lead, "band"), "bands")
    near = verify(banded.filter("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct(), docs)
    near = stored(near, "near")
    grouped = components(near).withColumnRenamed("node", "doc_id")
    parts = stored(
        heads.select("doc_id", "n_shingles", "folds").join(grouped, "doc_id", "left").withColumn("part", F.coalesce("component", "doc_id")), "parts"
    )
    # Documents linked so far stay together; a few of them, or one, go to the group of the most frequent band of their first.
    few = parts.groupBy("part").agg(F.count("*").alias("n")).filter(F.col("n") <= BLOCK).select(F.col("part").alias("doc_id"))
    choice = banded.join(few, "doc_id", "left_semi").groupBy("doc_id").agg(F.max(F.struct("n", "band")).alias("most"))
    choice = choice.select(F.col("doc_id").alias("part"), F.col("most.band").alias("band"))
    group = parts.join(choice, "part", "left").select("doc_id", "n_shingles", "folds", "part", F.coalesce("band", "part").alias("grp"))
    group = stored(group, "groups")
    kinds = stored(group.groupBy("grp").agg(F.min("part").alias("part"), F.max("part").alias("last")), "kinds")

    # The matrix: tokens that more than one document holds, dealt out once by token.
    cells = heads.select(F.explode("prefix").alias("token"), "doc_id").repartition("token")
    several = cells.groupBy("token").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("token")
    cells = stored(cells.join(several.hint("shuffle_hash"), "token", "left_semi"), "cells")
    cells = stored(cells.join(group.select("doc_id", "grp", "n_shingles"), "doc_id"), "cells")
    rows = cells.groupBy("token", F.col("grp").alias("b")).agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"))
    # Members and the groups that they share a token with; of two groups that hold a link both have such members.
    fits = F.expr(f"grp <> b and 100 * most >= {PERCENT} * n_shingles and 100 * n_shingles >= {PERCENT} * least")
    shared = stored(cells.join(rows, "token").filter(fits).select("doc_id", "n_shingles", "grp", "b").distinct(), "shared")
    pairs = shared.filter("grp < b").select(F.col("grp").alias("a"), "b").distinct()
    pairs = pairs.join(shared.filter("grp > b").select(F.col("b").alias("a"), F.col("grp").alias("b")).distinct(), ["a", "b"], "left_semi")
    unions = group.groupBy(F.col("grp").alias("id")).agg(
        F.min("n_shingles").alias("n"), F.array(*[F.max(F.col("folds")[i]) for i in range(FOLDS)]).alias("folds")
    )
    opened = stored(_opened(stored(pairs, "group_pairs"), unions, unions), "opened")

    # Opened groups: the members that share a token with the other group.
    both = opened.select(F.col("a").alias("grp"), "b").unionByName(opened.select(F.col("b").alias("grp"), F.col("a").alias("b")))
    allowed = shared.join(both, ["grp", "b"], "left_semi").select(F.col("doc_id").alias("a"), "b", F.col("grp").alias("g"), "n_shingles")
    allowed = stored(allowed, "allowed")
    left = allowed.filter("g < b").select(F.col("g").alias("ga"), F.col("b").alias("gb"), "a", "n_shingles")
    right = allowed.filter("g > b").select(F.col("b").alias("ga"), F.col("g").alias("gb"), F.col("a").alias("b"), "n_shingles")
    turns = left.groupBy("ga", "gb").agg(F.count("*").alias("na"), _blocks().alias("ki")).join(
        right.groupBy("ga", "gb").agg(F.count("*").alias("nb"), _blocks().alias("kj")), ["ga", "gb"]
    )
    turns = turns.select("ga", "gb", F.least("na", "nb").alias("turns"), "ki", "kj")
    for x in ("ga", "gb"):
        whole = kinds.filter("part = last").select(F.col("grp").alias(x), F.col("part").alias(f"p{x}"))
        turns = turns.join(whole, x, "left")
    turns = stored(turns, "turns")
    # One link makes two groups of linked documents one: each member first meets about one of the other group, by hashed turns.
    few = turns.filter("turns = 1 or (pga is not null and pgb is not null)").select("ga", "gb", "turns")
    some_left, some_right = (
        side.join(few, ["ga", "gb"]).select("ga", "gb", F.pmod(F.xxhash64(x), F.col("turns")).alias("turn"), x)
        for side, x in ((left, "a"), (right, "b"))
    )
    some = some_left.join(some_right, ["ga", "gb", "turn"])
    links = stored(verify(_met(some.select("a", "b"), heads), docs), "links")
    # Groups that are still apart, or not linked in themselves, are compared in full; with one turn all their members have met.
    of = group.select("doc_id", "part")
    joined = links.join(of.toDF("a", "ga"), "a").join(of.toDF("b", "gb"), "b").select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    place = stored(components(joined), "joined")
    apart = turns.filter("turns > 1").select("ga", "gb", "pga", "pgb", "ki", "kj")
    for x in ("ga", "gb"):
        apart = apart.join(place.toDF(f"p{x}", f"c{x}"), f"p{x}", "left").withColumn(f"c{x}", F.coalesce(f"c{x}", f"p{x}"))
    apart = stored(apart.filter("cga is null or cgb is null or cga <> cgb").select("ga", "gb", "ki", "kj"), "apart")
    full_left, full_right = (
        side.join(apart, ["ga", "gb"]).select("ga", "gb", F.col(x).alias("doc_id"), "ki", "kj") for side, x in ((left, "a"), (right, "b"))
    )
    mixed = kinds.filter("part < last").select("grp")
    inside = group.join(group.join(mixed, "grp", "left_semi").groupBy("grp").agg(_blocks().alias("k")), "grp")
    inside = inside.select(F.col("grp").alias("ga"), F.col("grp").alias("gb"), "doc_id", F.col("k").alias("ki"), F.col("k").alias("kj"))
    now = of.join(place.toDF("part", "place"), "part", "left").select("doc_id", F.coalesce("place", "part").alias("place"))
    links = links.unionByName(_compared(full_left.unionByName(inside), full_right.unionByName(inside), heads, now, docs))

    every = components(near.unionByName(links)).select(F.col("node").alias("rep"), "component")
    found = member.join(every, "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    return signed.select("doc_id", "n_shingles").join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """Documents, all columns, that are the first of their component; rows that repeat a doc_id stay or go together."""
    dropped = jaccard_components(docs).filter("component_id <> doc_id").select("doc_id").distinct()
    dropped = stored(dropped, "duplicates")
    return docs.join(F.broadcast(dropped) if dropped.count() <= BROADCAST_IDS else dropped, "doc_id", "left_anti")
