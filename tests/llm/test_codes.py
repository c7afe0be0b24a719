import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, id string"


def _dist(a, b):
    return sum((int(x) - int(y)) ** 2 for x, y in zip(a, b, strict=True))


def _plain(rows):
    """The contract in Python integers: rows (vec_id, embedding, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return [], None
    width = -(-max(len(r[1]) for r in kept) // 8) * 8
    dim = width // 8
    ints = [[math.floor(4096 * x) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    cut = lambda v: [v[p * dim : (p + 1) * dim] for p in range(8)]
    first = {}
    for r, v in sorted(zip(kept, ints, strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[1])):
        first.setdefault(r[0], v)
    books = [[cut(v)[p] for v in list(first.values())[:16]] for p in range(8)]
    near = lambda part, book: min(range(len(book)), key=lambda e: (_dist(part, book[e]), e))
    for _ in range(6):
        for p in range(8):
            groups = {}
            for v in ints:
                groups.setdefault(near(cut(v)[p], books[p]), []).append(cut(v)[p])
            for e, parts in groups.items():
                books[p][e] = [sum(c) // len(parts) for c in zip(*parts, strict=True)]
    out = []
    for r, v in zip(kept, ints, strict=True):
        codes = [near(cut(v)[p], books[p]) for p in range(8)]
        out.append((r[0], r[2], "".join(f"{c:02x}" for c in codes), sum(_dist(cut(v)[p], books[p][c]) for p, c in enumerate(codes))))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    totals = {}
    for _, label, _, error in out:
        totals[label] = totals.get(label, 0) + error
    return sorted(((i, lab, c, e, totals[lab]) for i, lab, c, e in out), key=repr), digest


def _found(df):
    rows = df.collect()
    return sorted(((r["id"], r["label"], r["code"], r["error"], r["label_error"]) for r in rows), key=repr), {r["codebooks_sha256"] for r in rows}


@pytest.mark.parametrize("kind", [np.int64, object])
@pytest.mark.parametrize("spread, dim, entries", [(3, 4, 16), (50, 8, 16), (10_000, 8, 16), (2, 1, 5), (100, 8, 1), (0, 3, 4)])
def test_equal_average_search_equals_all_distances(kind, spread, dim, entries):
    rnd = np.random.default_rng(spread + dim)
    parts = rnd.integers(-spread, spread + 1, (400, dim)).astype(kind)
    book = rnd.integers(-spread, spread + 1, (entries, dim)).astype(kind)
    book[-1] = book[0]  # a tie, to be won by the lower index
    index, distance = vectorcodes.nearest(parts, book)
    for part, i, d in zip(parts, index, distance, strict=True):
        all_of = [_dist(part, e) for e in book]
        assert d == min(all_of) and i == all_of.index(d)


def test_search_skips_far_entries():
    """The bound ends the search: an entry beyond it is never measured."""

    class Counting(np.ndarray):
        seen = 0

        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                Counting.seen += len(key)
            return np.asarray(super().__getitem__(key))

    book = np.arange(16 * 4).reshape(16, 4) * 1000
    vectorcodes.nearest(np.zeros((100, 4), np.int64) + 5, book.view(Counting))
    assert Counting.seen < 100 * 4


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "i") for r in rows], SCHEMA).repartition(3)


def test_codes_equal_plain_rounds(spark):
    rnd = np.random.default_rng(3)
    rows = [(i * 7 % 401, [float(x) for x in np.float32(rnd.normal(i % 5, 0.3, 16))], i % 3 or None) for i in range(400)]
    rows += [rows[5]] * 30
    expected, digest = _plain(rows)
    found, digests = _found(vectorcodes.compress(_frame(spark, rows)))
    assert found == expected and digests == {digest}


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(50, None, 1), (51, [1.0, None], 1), (52, [nan] * 8, 1), (53, [1.0, -inf], None)]
    rows = [(0, [], 1), (1, [0.5], None), (2, [-0.25] * 11, None), (None, [3.0] * 16, 2), (2, [0.125] * 11, 1), (3, [0.0] * 16, 1)]
    expected, digest = _plain(odd + rows)
    found, digests = _found(vectorcodes.compress(_frame(spark, odd + rows)))
    assert found == expected and digests == {digest} and len(found) == len(rows)
    assert _found(vectorcodes.compress(_frame(spark, odd)))[0] == []
    assert vectorcodes.compress(_frame(spark, rows).filter(F.lit(False))).count() == 0
    assert [r[2:4] for r in _found(vectorcodes.compress(_frame(spark, [(1, [], 1)] * 3)))[0]] == [("00" * 8, 0)] * 3


def test_huge_components(spark):
    rows = [(i, [float(np.float32(10.0**k)) for k in (i % 3, 3, 5, i % 7, 0, 1, 2, 6)], 1) for i in range(40)]
    assert _found(vectorcodes.compress(_frame(spark, rows)))[0] == _plain(rows)[0]
    huge = [(0, [3e38] * 8, 1), (1, [-3e38] * 8, 1), *((i, [1e30 * i] * 8, 2) for i in range(2, 40))]
    found, _ = _found(vectorcodes.compress(_frame(spark, huge)))
    wide = {r[0]: r for r in _plain([(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in huge])[0]}
    for i, label, code, error, _ in found:
        assert code == wide[i][2] and error == (wide[i][3] if wide[i][3] < 1 << 63 else None)
