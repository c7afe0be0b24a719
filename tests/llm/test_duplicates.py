import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medallion.llm import graph, jaccard, neardup
from medallion.llm.tables import load


def smallest(links, nodes):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2200)]
    df = spark.createDataFrame(links + [(5, 5), (None, 3)], "a long, b long")
    links = [(a, b) for a, b in links if a != b]
    want = smallest(links, {n for pair in links for n in pair})
    assert {r.node: r.component for r in graph.components(df).collect()} == want
    assert graph.components(df.limit(0)).count() == 0


def test_few_links_take_no_rounds(spark, monkeypatch):
    """A chain is contracted by one task; with more links than that task may take, rounds come first."""
    links = [(i, i + 1) for i in range(400)] + [(1000, 1000 + i) for i in range(1, 50)]
    df = spark.createDataFrame(links, "a long, b long")
    want = smallest(links, {n for pair in links for n in pair})
    written = []
    monkeypatch.setattr(graph, "stored", lambda frame, label, write=graph.stored: written.append(label) or write(frame, label))
    assert {r.node: r.component for r in graph.components(df).collect()} == want
    assert written.count("moves") == 1
    monkeypatch.setattr(graph, "FEW", 60)
    assert {r.node: r.component for r in graph.components(df).collect()} == want
    assert written.count("moves") > 3


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


@pytest.fixture(params=["as shipped", "all tokens frequent"])
def settings(request, monkeypatch):
    if request.param != "as shipped":
        monkeypatch.setattr(jaccard, "FREQUENT", 2)


def test_jaccard_against_all_pairs(spark, settings):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [f"c{i}" for i in range(30)]
    texts = []
    for _ in range(25):
        words = [*common, *rng.choice(vocabulary, rng.integers(1, 90))]
        texts.append(" ".join(words))
        for _ in range(int(rng.integers(0, 6))):
            own = list(words)
            for _ in range(int(rng.integers(0, 6))):
                own[int(rng.integers(0, len(own)))] = str(rng.choice(vocabulary))
            texts.append(" ".join(own).upper() if rng.random() < 0.3 else " ".join(own))
    texts += ["", None, "a b", "a b", "a b c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and (both := len(sets[a] & sets[b])) and 100 * both >= 80 * len(sets[a] | sets[b])]
    want = smallest(links, sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}
    kept = {r.doc_id for r in jaccard.keep_one_of_each(docs).collect()}
    assert kept == {i for i in sets if want[i] == i}


def test_jaccard_of_a_family(spark, monkeypatch):
    """Many documents that are alike without being linked, most of them; some are, through several blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(90)]
    texts = []
    for k in range(160):
        own = list(base)
        for at in rng.choice(90, 3 if k % 4 else 1, replace=False):
            own[at] = f"n{k}x{at}"
        texts.append(" ".join(own))
    texts += [f"{t} tail" for t in texts[:5]]
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * (both := len(sets[a] & sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - both)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert got == smallest(links, sets) and 10 < len(set(got.values())) < 150


def linked(texts):
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and (both := len(sets[a] & sets[b])) and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)]
    return smallest(links, sets)


@pytest.mark.parametrize("kept", [0, 2, 1000])
def test_blocks_with_few_and_with_many_pairs(spark, monkeypatch, kept):
    """The links do not depend on whether pairs or whole blocks get their texts, nor on how wide the matrices are."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "PAIRS_KEPT", kept)
    monkeypatch.setattr(jaccard, "UNPACKED", 1 << 12)
    rng = np.random.default_rng(11)
    texts = []
    for family in range(3):
        base = [f"w{family}x{i}" for i in range(60)]
        for k in range(40):
            own = list(base)
            for at in rng.choice(60, int(rng.integers(0, 3)), replace=False):
                own[at] = f"n{family}x{k}x{at}"
            texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()} == linked(texts)


def test_overlaps_are_exact(monkeypatch):
    monkeypatch.setattr(jaccard, "UNPACKED", 500)
    rng = np.random.default_rng(12)
    sets = [np.unique(rng.integers(0, 400, n).astype(np.uint64)) for n in (0, 1, 5, 60, 200, 300, 300)]
    rows, columns = np.array([0, 2, 3, 6, 6]), np.array([1, 4, 5, 0])
    want = [[len(np.intersect1d(sets[i], sets[j])) for j in columns] for i in rows]
    assert jaccard._overlaps(sets, rows, columns).tolist() == want
    assert jaccard._overlaps([np.zeros(0, np.uint64)] * 2, np.array([0]), np.array([1])).tolist() == [[0]]


def test_jaccard_edges(edge_docs, empty):
    rows = jaccard.jaccard_components(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert {r.doc_id: r.component_id for r in rows}[5] == 4
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert jaccard.jaccard_components(empty(edge_docs)).count() == 0
    kept = jaccard.keep_one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns and {r.doc_id for r in kept.collect()} == {0, 1, 2, 3, 4, 6, 7, 8, 9, None}


def test_forest_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LEAF", 64)  # a deep forest on few vectors
    monkeypatch.setattr(neardup, "BLOCK", 32)  # leaves in several blocks
    rng = np.random.default_rng(3)
    heads = rng.standard_normal((60, 24))
    x = np.concatenate([heads, *[heads[rng.integers(0, 60, 120)] + rng.standard_normal((120, 24)) * 0.1 for _ in range(5)], heads[:5]])
    x = np.concatenate([x, heads[0] + rng.standard_normal((150, 24)) * 0.05])
    labels = rng.integers(0, 2, len(x))
    rows = [(i, [float(v) for v in x[i]], int(labels[i])) for i in range(len(x))]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    found = sum(r.n_links for r in got.values())
    assert found <= near.sum() and found >= 0.99 * near.sum()
    if found == near.sum():
        want = smallest([(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if a < b], range(len(x)))
        assert {i: r.component_id for i, r in got.items()} == want


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1)]
    rows += [(8, [None, 1.0], 1), (9, [1.0, 0.0], None), (10, [1.0], 1), (11, [1.0, 0.0], 1), (12, [1e-300, 0.0], 1), (13, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit("clash"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()}
    assert {i for i, (n, _, _) in got.items() if n} == {1, 2, 11, 12}
    assert got[2] == (3, 1, False) and got[1] == (3, 1, True) and got[13] == (0, 13, True)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_recall_on_the_table(spark):
    df = load(spark, "/root/testdata/sf0.01", "embeddings")
    rows = df.collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r.label for r in rows])
    links = int(((x @ x.T >= 0.98) & (label[:, None] == label[None, :])).sum()) - len(rows)
    assert neardup.near_duplicates(df).agg(F.sum("n_links")).first()[0] >= 0.9 * links


def test_bit_maps_keep_every_link():
    rng = np.random.default_rng(5)
    rows = []
    for n in (1, 2, 10, 250, 256, 300, 1000, 3000):
        for share in (0.0, 0.5, 0.88, 0.95, 1.0):
            for grown in (1.0, 1.1, 1.25, 8.0):
                a = rng.integers(0, 1 << 63, n).astype(np.uint64)
                fresh = rng.integers(0, 1 << 63, max(int(n * grown), 1)).astype(np.uint64)
                b = np.concatenate([a[: int(share * n)], fresh[int(share * n) :]])
                rows.append((np.unique(a), np.unique(b)))
    maps = [[jaccard._bit_map(own) for own in side] for side in zip(*rows)]
    sizes = [[len(own) for own in side] for side in zip(*rows)]
    ids = list(range(len(rows)))
    batch = pa.RecordBatch.from_pydict({"a": ids, "b": ids, "na": sizes[0], "nb": sizes[1], "xa": maps[0], "xb": maps[1]})
    kept = set(next(jaccard._may_link(iter([batch]))).column("a").to_pylist())
    both = [len(np.intersect1d(a, b)) for a, b in rows]
    linked = {i for i in ids if both[i] and 100 * both[i] >= 80 * (len(rows[i][0]) + len(rows[i][1]) - both[i])}
    apart = {i for i in ids if both[i] == 0 and len(rows[i][0]) >= 10}
    assert linked and linked <= kept and apart and not apart & kept
