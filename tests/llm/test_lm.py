import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from medallion.llm import gru, lm
from medallion.llm.queries import op3_lm
from medallion.llm.tables import load

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER)), None]


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def base(docs):
    counts = Counter(t for r in docs if not held(r.doc_id) for t in tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    return counts, n, lambda text: sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(text))


def test_query_against_counts(spark):
    docs = load(spark, "/root/testdata/sf0.001", "documents").collect()
    counts, n, score = base(docs)
    rows = {r.doc_id: r for r in op3_lm(spark, "/root/testdata/sf0.001").collect()}
    assert len(rows) == len(docs)
    for d in docs:
        r, words = rows[d.doc_id], tokens(d.text)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(d.doc_id), len(words), n)
        assert r.n_known == sum(counts[t] > 0 for t in words)
        assert r.base_score == pytest.approx(score(d.text), rel=1e-9)


def test_model_beats_the_unigram_on_held_out(spark):
    rows = op3_lm(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r.score for r in rows) > 0.97 * sum(r.base_score for r in rows)


def test_probabilities_sum_to_one(spark):
    """Over all training words and one unknown, after a given context."""
    texts = ["the cat sat", "the dog sat on the mat", "a cat and a dog"] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = lm.learn(docs)
    vocabulary = sorted({t for i, text in enumerate(texts) if not held(i) for t in tokens(text) if t})
    probe = spark.createDataFrame([(i, f"the {w}") for i, w in enumerate(vocabulary)] + [(900, "the"), (901, "the"), (902, "")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in lm.score_documents(probe, model).collect()}
    assert scores[900] == scores[901]
    # P(the) and P(end | the) from scores of prefixes is not available; the classes' distribution is checked instead.
    p = model.network
    logits = np.zeros(gru.HIDDEN, np.float32) @ p["out"] + p["prior"]
    share = np.exp(logits - logits.max())
    share /= share.sum()
    mass = np.exp(model.words.log_mass)
    inside = np.zeros(len(mass))
    for rank, c in enumerate(model.words.classes):
        inside[c] += model.words.counts[model.words.rank == rank][0] / mass[c]
    assert share.sum() == pytest.approx(1, abs=1e-5) and inside.max() <= 1 + 1e-9


def test_every_training_document_is_learnt_from(spark, monkeypatch):
    """A word that one document alone holds has a profile and an embedding moved by training."""
    seen = []
    monkeypatch.setattr(lm, "cluster_words", lambda company, counts, real=lm.cluster_words: seen.append(company.copy()) or real(company, counts))
    docs = spark.createDataFrame([(i, f"only{i} the and only{i} of") for i in range(200)], "doc_id long, text string")
    model = lm.learn(docs.repartition(3))
    n = len(model.words.common)
    assert n == 4 + sum(not held(i) for i in range(200))
    assert (np.linalg.norm(seen[0][:n], axis=1) > 0).all()
    start = gru.initial(lm.INPUTS + lm.SHAPES + 1, np.ones(model.words.own + lm.SHAPES))["embed"]
    assert (model.network["embed"][4:n] != start[4:n]).any(axis=1).all()  # after the four that all documents hold


@pytest.mark.parametrize("most", [1, 7, 150, 3999, 4000, 9000])
def test_frequent_words_are_those_of_a_plain_sort(spark, most):
    rng = np.random.default_rng(most)
    words = rng.integers(-(2**63), 2**63 - 1, 4000)
    counts = np.where(rng.random(4000) < 0.7, 1, rng.zipf(1.5, 4000).clip(1, 10**9))
    table = spark.createDataFrame([(int(w), int(n)) for w, n in zip(words, counts)], "word long, n long").repartition(5)
    got = [(r.n, r.word) for r in lm.frequent_words(table, most).collect()]
    assert got == [(n, w) for n, w in sorted(zip(counts.tolist(), words.tolist()), key=lambda r: (-r[0], r[1]))[:most]]


def test_gradients_and_carried_state():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.initial(20, rng.integers(1, 50, 7)).items()}
    inputs, targets = rng.integers(0, 20, (3, 5)), rng.integers(0, 7, (3, 5))
    fresh, live, h = rng.random((3, 5)) < 0.3, rng.random((3, 5)) < 0.8, rng.standard_normal((3, gru.HIDDEN)) * 0.1
    _, g, _ = gru.window_gradients(p, inputs, targets, fresh, h, live)
    for k in p:
        i = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        ends = []
        for step in (1e-5, -1e-5):
            q = {n: v.copy() for n, v in p.items()}
            q[k][i] += step
            ends.append(gru.window_gradients(q, inputs, targets, fresh, h, live)[0])
        assert g[k][i] == pytest.approx((ends[0] - ends[1]) / 2e-5 / live.sum(), rel=1e-3)
    # A document over several windows scores as step by step.
    n = 3 * gru.WINDOW + 5
    inputs, classes = rng.integers(0, 20, n), rng.integers(0, 7, n)
    state, total = np.zeros((1, gru.HIDDEN)), 0.0
    for t in range(n):
        loss, _, state = gru.window_gradients(p, inputs[None, [t]], classes[None, [t]], np.array([[False]]), state, np.array([[True]]))
        total -= loss
    first = np.array([0, n])
    assert gru.document_scores(p, inputs, classes, first, np.zeros(7))[0] == pytest.approx(total, rel=1e-4)


def test_edges(spark, edge_docs, empty):
    model = lm.learn(edge_docs)
    rows = lm.score_documents(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert lm.score_documents(empty(edge_docs), model).count() == 0
    none = lm.learn(empty(edge_docs))
    assert lm.score_documents(edge_docs, none).count() == edge_docs.count()


def test_profiles_come_from_few_tasks(spark, monkeypatch):
    """Each task's profiles take 8 MB, so their number must not be that of the input partitions."""
    seen, summed, setting = [], lm.summed, "spark.sql.files.maxPartitionBytes"
    monkeypatch.setattr(lm, "summed", lambda rows, size, *a: (seen.append((size, rows.rdd.getNumPartitions())), summed(rows, size, *a))[1])
    before = spark.conf.get(setting)
    spark.conf.set(setting, "64k")
    try:
        docs = spark.createDataFrame([(i, f"one two three word{i % 9} word{i}") for i in range(160)], "doc_id long, text string").repartition(40)
        model = lm.learn(docs)
    finally:
        spark.conf.set(setting, before)
    assert model.total > 0
    assert [n for size, n in seen if size == lm.HEAD * lm.PROFILE] == [10]


def test_each_task_hands_on_a_word_once(spark, monkeypatch):
    """However many parts its texts are counted in; counts and forms are those of plain sums."""
    monkeypatch.setattr(lm, "COUNTED", 40)
    texts = [f"The cat sat, on{i % 7} the mat. {i}" for i in range(100)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    rows = [r for part in lm._count(iter([batch, batch])) for r in part.to_pylist()]
    words = [w for text in texts for w in tokens(text)]
    assert len({r["word"] for r in rows}) == len(rows) == len(set(words))
    assert sorted(r["n"] for r in rows) == sorted(2 * n for n in Counter(words).values())


@pytest.mark.parametrize("step", [1, 1 << 40])
def test_distinct_words_are_those_of_a_plain_unique(step):
    """Also if words differ in the last bits of their hashes alone."""
    hashes = np.random.default_rng(3).integers(0, 90, 2000).astype(np.uint64) * np.uint64(step)
    forms = (hashes % np.uint64(47)).astype(np.int64)
    want = np.unique(hashes, return_index=True, return_counts=True)
    got = lm.distinct_words(hashes, forms)
    assert all((a == b).all() for a, b in zip(got, (want[0], forms[want[1]], want[2])))


@pytest.mark.parametrize("size", [0, 1, 1000])
def test_common_words_are_found_as_by_a_binary_search(size):
    rng = np.random.default_rng(size)
    drawn = rng.integers(0, 1 << 63, size).astype(np.uint64) >> rng.integers(0, 40, size).astype(np.uint64)
    common = np.unique(np.append(drawn, np.array([0, 2**64 - 1], np.uint64)[:size]))
    known = lm.Words(common, np.ones(len(common), np.int64), np.arange(len(common)), np.zeros(0, np.int64), np.zeros(0), 0)
    probe = np.concatenate([common, common + np.uint64(1), rng.integers(0, 1 << 63, 500).astype(np.uint64), np.array([0, 2**64 - 1], np.uint64)])
    ranks, found = known.look_up(probe)
    assert (found == np.isin(probe, common)).all()
    assert (ranks == np.where(found, np.searchsorted(common, probe), len(common))).all()


def test_profiles_are_those_of_single_documents(spark, monkeypatch):
    """Frequent words are summed as a matrix, others one by one; both as the definition says."""
    rng = np.random.default_rng(4)
    monkeypatch.setattr(lm, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    docs = [np.minimum(rng.zipf(1.2, rng.integers(0, 400)) - 1, lm.HEAD + 5) for _ in range(600)] + [np.full(3, lm.PROFILE)]
    batch = pa.RecordBatch.from_pydict({"ids": [(d * lm.SHAPES).astype("<i4").tobytes() for d in docs]})
    want = np.zeros((lm.HEAD, lm.PROFILE))
    for d in docs:
        profile = np.bincount(d[d < lm.PROFILE], minlength=lm.PROFILE).astype(float)
        if profile.any():
            np.add.at(want, d[d < lm.HEAD], profile / np.linalg.norm(profile))
    (row,) = lm._company(iter([batch]))
    assert np.allclose(np.frombuffer(row.column("vector")[0].as_py()).reshape(want.shape), want)


def test_long_and_short_documents_score_alike_alone_and_together():
    """Documents read side by side in blocks, with steps of several blocks."""
    rng = np.random.default_rng(6)
    p = gru.initial(50, rng.integers(1, 50, 9))
    lengths = np.concatenate([rng.integers(1, 40, 700), [300, 1]])
    first = np.concatenate([[0], np.cumsum(lengths)])
    inputs, classes, value = rng.integers(0, 50, first[-1]), rng.integers(0, 9, first[-1]), rng.standard_normal(9)
    together = gru.document_scores(p, inputs, classes, first, value)
    for k in (0, 5, 350, 700, 701):
        part = slice(first[k], first[k + 1])
        alone = gru.document_scores(p, inputs[part], classes[part], np.array([0, lengths[k]]), value)
        assert together[k] == pytest.approx(alone[0], rel=1e-5)
