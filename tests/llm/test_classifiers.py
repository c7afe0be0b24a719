import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import quality, toxicity
from medallion.llm.queries import op1_quality, op6_toxicity
from medallion.llm.sampling import labelled_sample
from medallion.llm.tables import load


def accuracy(spark, scored, label):
    rows = scored.join(load(spark, "/root/testdata/sf0.01", "labels"), "doc_id").filter("held_out").select("score", "predicted", label).toPandas()
    bad, good = rows[rows[label] == 0].score, rows[rows[label] == 1].score
    above = (good.to_numpy()[:, None] > bad.to_numpy()[None, :]).mean()
    return above, (rows.predicted == rows[label]).mean()


def test_quality_held_out(spark):
    scored = op1_quality(spark, "/root/testdata/sf0.01")
    assert scored.count() == 1000 and scored.filter("score < 0 or score > 1").count() == 0
    above, right = accuracy(spark, scored, "quality")
    assert above > 0.85 and right > 0.85


def test_toxicity_held_out(spark):
    above, right = accuracy(spark, op6_toxicity(spark, "/root/testdata/sf0.01"), "toxic")
    assert right > 0.85 and above > 0.6


def test_quality_gradients():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(32, 120, n, dtype=np.uint8)) for n in (0, 5, 300, 900)]
    at = quality.Layout(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts]))
    p = {k: v.astype(np.float64) for k, v in quality.initial(3).items()}
    y, weight = np.array([0, 1, 1, 0]), np.ones(4)
    _, g = quality.gradients(p, at, y, weight)
    for k in p:
        i = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        ends = []
        for step in (1e-5, -1e-5):
            q = {n: v.copy() for n, v in p.items()}
            q[k][i] += step
            ends.append(quality.gradients(q, at, y, weight)[0])
        assert g[k][i] == pytest.approx((ends[0] - ends[1]) / 2e-5, rel=1e-3)


def test_quality_does_not_depend_on_the_batch():
    texts = [b"", b"abc", b"the quick brown fox " * 40]
    p = quality.initial()
    whole = quality.forward(p, quality.Layout(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])))
    alone = [quality.forward(p, quality.Layout(np.frombuffer(t, np.uint8), np.array([0, len(t)])))[0] for t in texts]
    assert np.allclose(whole, alone, atol=1e-5)


def test_repeated_rows_score_alike(spark, labels):
    """Each document three times among others, in other partitions: one score, to the last bit."""
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    marks = load(spark, "/root/testdata/sf0.01", "labels")
    again = docs.unionByName(docs.orderBy(F.desc("doc_id"))).unionByName(docs.repartition(7))
    for module, fit, score in ((quality, quality.fit, quality.score_quality), (toxicity, toxicity.fit, toxicity.score_toxicity)):
        scores = score(again, fit(docs, marks)).groupBy("doc_id").agg(F.countDistinct("score").alias("n"), F.count("*").alias("rows"))
        assert scores.filter("n <> 1 or rows <> 3").count() == 0


def test_noisy_or_locates_the_sentence(spark):
    clean = "It was a day like any. We went out. Then home!"
    rows = [(i, clean + (" You utter scumbag! Bye." if i % 2 else " Bye."), i % 2) for i in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    marks = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    found = toxicity.score_toxicity(docs, toxicity.fit(docs, marks), ("doc_id", "text")).collect()
    for r in found:
        assert (r.score >= 0.5) == bool(r.doc_id % 2)
        spots = [r.text[s.start : s.start + s.length] for s in r.offending]
        assert spots == (["You utter scumbag"] if r.doc_id % 2 else [])


@pytest.mark.parametrize("module, fit, score", [(quality, quality.fit, quality.score_quality), (toxicity, toxicity.fit, toxicity.score_toxicity)])
def test_edges(edge_docs, labels, empty, module, fit, score):
    model = fit(edge_docs, labels)
    rows = score(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 4}) == 1
    assert score(empty(edge_docs), model).count() == 0
    nothing = fit(empty(edge_docs), empty(labels))
    assert score(edge_docs, nothing).count() == edge_docs.count()


def test_reject_keeps_columns(edge_docs, labels):
    kept = toxicity.reject_toxic(edge_docs, labels.withColumn("toxic", F.lit(0)))
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()


def test_sample_holds_one_row_of_a_repeated_id(spark):
    """Whatever share of the rows an id has; the rows' order and partitions do not matter."""
    rows = [(i, f"text {i}") for i in range(60)] + [(3, f"again {i}") for i in range(500)] + [(4, None)] * 50 + [(None, "x")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(3, 1)] * 9, "doc_id long, quality int")
    taken = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        sample, weights = labelled_sample(docs, labels, "quality", 10)
        taken.append(sorted((r.doc_id, r._y, r.text) for r in sample.collect()))
        assert len({r[0] for r in taken[-1]}) == len(taken[-1]) == 20 and set(weights) == {0, 1}
    assert taken[0] == taken[1]
    everything = {r.doc_id: r.text for r in labelled_sample(docs, labels, "quality", 60)[0].collect()}
    assert everything[4] == "text 4" and everything.get(3, "again 0") == "again 0"
