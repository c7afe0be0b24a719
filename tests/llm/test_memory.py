"""What a worker and its executor hold at a time does not follow the size of Spark's batches."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medallion.llm import decontaminate, jaccard, lm, packing, tables, toxicity

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def usual(spark):
    assert LIMIT not in spark.conf.getAll or spark.conf.get(LIMIT) == tables.BATCH_BYTES
    spark.conf.unset(LIMIT)
    yield spark
    spark.conf.unset(LIMIT)


@pytest.fixture
def docs(spark):
    words = F.transform(F.sequence(F.lit(1), F.lit(200)), lambda k: F.xxhash64("id", k).cast("string"))
    return spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.array_join(words, " ").alias("text"))


def largest_batch(df):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    return df.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]


@pytest.mark.parametrize("step", ["toxicity", "toxicity fit", "near duplicates", "decontamination", "packing"])
def test_texts_go_to_workers_in_small_batches(usual, docs, step):
    assert largest_batch(docs) > 8 << 20
    few = docs.limit(3)
    if step == "toxicity":
        toxicity.score_toxicity(few, toxicity.ToxicModel(np.zeros(1 << toxicity.BITS, np.float32), 0.0))
    elif step == "toxicity fit":
        toxicity.fit(few, usual.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int"))
    elif step == "near duplicates":
        jaccard.jaccard_components(few)
    elif step == "decontamination":
        decontaminate.find_leaks(few, usual.createDataFrame([(1, "a benchmark item of a few words")], "item_id long, text string"))
    else:
        packing.pack_documents(few)
    assert largest_batch(docs) < 2 << 20


def test_a_size_that_the_caller_has_set_holds(usual):
    usual.conf.set(LIMIT, "3m")
    tables.small_batches(usual)
    assert usual.conf.get(LIMIT) == "3m"
    tables.usual_batches(usual)
    assert usual.conf.get(LIMIT) == "3m"


def test_language_model_reads_the_same_batches_after_other_operators(usual, docs):
    tables.small_batches(usual)
    lm.learn(docs.limit(5))
    assert LIMIT not in usual.conf.getAll


def test_language_model_reads_texts_in_small_batches(usual, docs, monkeypatch):
    """Counting and coding 1 MB at a time, scoring 4 MB; training on numbers reads what it has always read."""
    sizes, write = {}, lm.stored

    def watched(df, label):
        if label in ("counts", "ids", "scored"):
            sizes[label] = largest_batch(docs)
        return write(df, label)

    monkeypatch.setattr(lm, "stored", watched)
    few = docs.limit(5)
    lm.score_documents(few, lm.learn(few))
    assert sizes["counts"] < 2 << 20 and sizes["ids"] < 2 << 20 and sizes["scored"] < 6 << 20
    assert LIMIT not in usual.conf.getAll
    usual.conf.set(LIMIT, "3m")
    with tables.batches_of(usual, "1m"):
        assert usual.conf.get(LIMIT) == "3m"
    assert usual.conf.get(LIMIT) == "3m"


def test_language_model_counts_few_words_at_a_time():
    rng = np.random.default_rng(1)
    texts = [" ".join(map(str, rng.integers(0, 5000, 500))) for _ in range(200)]
    batch = pa.RecordBatch.from_pydict({"text": texts * 26})  # 2.6 million words
    tracemalloc.start()
    got = list(lm._count(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 80 << 20
    assert sum(sum(b.column("n").to_pylist()) for b in got) == 26 * 200 * 501


def test_rejecting_toxic_documents_sends_texts_once(usual, docs, monkeypatch):
    seen = []
    score = toxicity.score_toxicity
    monkeypatch.setattr(toxicity, "score_toxicity", lambda rows, *a: seen.append(rows.columns) or score(rows, *a))
    bad = docs.limit(40).withColumn("text", F.when(F.col("doc_id") % 2 == 1, F.lit("vile slur! vile slur again.")).otherwise(F.col("text")))
    marks = bad.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    bad = bad.select(F.lit("s").alias("source"), "text", "doc_id", F.when(F.col("doc_id") > 2, 1).alias("_text"))
    kept = toxicity.reject_toxic(bad, marks)
    assert seen == [["row"]] and kept.columns == bad.columns
    assert {r.doc_id for r in kept.collect()} == set(range(0, 40, 2))
    assert kept.exceptAll(bad).count() == 0


def test_counting_tokens_holds_them_once(monkeypatch):
    n, parts = 130_000, 40
    part = lambda k: np.random.default_rng(k).integers(0, 1 << 22, n, dtype=np.uint64)
    monkeypatch.setattr(jaccard, "_tokens", lambda batches: ((None, part(k), None) for k in range(parts)))
    tracemalloc.start()
    got = list(jaccard._frequent(iter([])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 96 << 20
    every = np.concatenate([part(k) for k in range(parts)])
    want = []
    for begin in range(0, len(every), jaccard.COUNTED):
        token, count = np.unique(every[begin : begin + jaccard.COUNTED], return_counts=True)
        want.append((token[count >= jaccard.REPORTED].view(np.int64), count[count >= jaccard.REPORTED]))
    assert len(got) == len(want)
    for batch, (token, count) in zip(got, want):
        assert (np.asarray(batch.column("token")) == token).all() and (np.asarray(batch.column("n")) == count).all()


def test_counting_tokens_of_little(monkeypatch):
    monkeypatch.setattr(jaccard, "COUNTED", 4)
    parts = [[7, 7], [], [5], [7, 1, 1, 1, 1, 1, 1, 1, 2], [2]]
    monkeypatch.setattr(jaccard, "_tokens", lambda batches: ((None, np.array(p, np.uint64), None) for p in parts))
    got = [(b.column("token").to_pylist(), b.column("n").to_pylist()) for b in jaccard._frequent(iter([]))]
    assert got == [([7], [3]), ([1], [4]), ([1], [3]), ([], [])]
    monkeypatch.setattr(jaccard, "_tokens", lambda batches: iter([]))
    assert list(jaccard._frequent(iter([]))) == []
