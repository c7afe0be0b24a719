import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.functions.embedding import embed
from medallion.functions.text import as_text, chunk_text, extract_fields, parse_text_blocks, render, row_json
from medallion.operators.knn import knn_l2
from medallion.plans import retrieval


def search(spark, queries, corpus, k, **more):
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "q int, qv array<float>")
    c = spark.createDataFrame([(i, v.tolist(), f"t{i}") for i, v in enumerate(corpus)], "c bigint, cv array<float>, t string")
    found = knn_l2(q, c.repartition(3), k, "q", "qv", "c", "cv", payload=["t"], **more)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.q, r["rank"])):
        assert r.t == f"t{r.c}"
        got.setdefault(r.q, []).append((r.c, r.distance))
    return got


def brute_force(queries, corpus, k):
    out = {}
    for i, q in enumerate(queries):
        d = ((corpus.astype(np.float64) - q.astype(np.float64)) ** 2).sum(axis=1)
        order = np.lexsort((np.arange(len(d)), d))[:k]
        out[i] = [(int(j), float(d[j])) for j in order]
    return out


@pytest.mark.parametrize("block", [1024, 2])
def test_nearest_neighbours_against_brute_force(spark, block):
    rng = np.random.default_rng(1)
    corpus = rng.normal(size=(500, 8)).astype(np.float32)
    queries = rng.normal(size=(5, 8)).astype(np.float32)
    got, expected = search(spark, queries, corpus, 7, query_block=block), brute_force(queries, corpus, 7)
    assert {q: [c for c, _ in v] for q, v in got.items()} == {q: [c for c, _ in v] for q, v in expected.items()}
    for q in expected:
        assert [d for _, d in got[q]] == pytest.approx([d for _, d in expected[q]])


def test_many_queries_against_brute_force_with_one_scan_of_the_corpus(spark):
    """5,000 queries in blocks against a corpus of which a third is one repeated point."""
    rng = np.random.default_rng(4)
    corpus = rng.normal(size=(3000, 8)).astype(np.float32)
    corpus[:1000] = corpus[0]
    queries = rng.normal(size=(5000, 8)).astype(np.float32)
    scanned = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            scanned.add(batch.num_rows)
            yield batch

    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "q int, qv array<float>")
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "c bigint, cv array<float>")
    found = knn_l2(q, c.repartition(3).mapInArrow(counted, c.schema), 3, "q", "qv", "c", "cv", corpus_block=700).collect()
    assert scanned.value == len(corpus)
    got = {}
    for r in sorted(found, key=lambda r: (r.q, r["rank"])):
        got.setdefault(r.q, []).append(r.c)
    assert got == {i: [j for j, _ in v] for i, v in brute_force(queries, corpus, 3).items()}


def test_ties_go_to_the_smallest_id_even_when_a_third_of_the_corpus_is_one_point(spark):
    corpus = np.ones((300, 4), np.float32)
    corpus[100:] = np.random.default_rng(2).normal(size=(200, 4)) + 5
    corpus = corpus[::-1].copy()  # the equal points carry the largest ids
    got = search(spark, np.ones((1, 4), np.float32), corpus, 5)
    assert [c for c, _ in got[0]] == [200, 201, 202, 203, 204]


def test_corpus_smaller_than_k_and_null_vectors(spark):
    q = spark.createDataFrame([(1, [0.0])], "q int, qv array<float>")
    c = spark.createDataFrame([(1, [2.0]), (2, None), (3, [1.0])], "c int, cv array<float>")
    got = knn_l2(q, c, 5, "q", "qv", "c", "cv").collect()
    assert sorted((r["rank"], r.c, r.distance) for r in got) == [(1, 3, 1.0), (2, 1, 4.0)]


def test_vector_with_a_missing_component_is_no_neighbour(spark):
    q = spark.createDataFrame([(1, [0.0])], "q int, qv array<float>")
    c = spark.createDataFrame([(i, [None]) for i in range(9)] + [(9, [2.0])], "c int, cv array<float>").coalesce(1)
    assert [(r.c, r.distance) for r in knn_l2(q, c, 5, "q", "qv", "c", "cv").collect()] == [(9, 4.0)]


def test_no_queries_give_no_rows(spark):
    q = spark.createDataFrame([], "q int, qv array<float>")
    c = spark.createDataFrame([(1, [2.0])], "c int, cv array<float>")
    found = knn_l2(q, c, 5, "q", "qv", "c", "cv")
    assert found.columns == ["q", "c", "distance", "rank"] and found.count() == 0


def test_search_never_shuffles_the_corpus(spark, sf_dir, capsys):
    from queries.registry import nearest_to_centres

    nearest_to_centres(spark, sf_dir).explain()
    plan = capsys.readouterr().out
    scan_side = plan[plan.index("MapInArrow") :]
    assert "Exchange" not in scan_side and "NestedLoop" not in plan


def chunks_of(spark, text, **more):
    df = chunk_text(spark.createDataFrame([(1, text)], "id int, text string"), "text", **more)
    return [r.chunk for r in sorted(df.collect(), key=lambda r: r.chunk_pos)]


@pytest.mark.parametrize("length", [0, 1, 149, 150, 151, 200, 201, 300, 1000])
@pytest.mark.parametrize("size, overlap", [(200, 50), (200, 150), (100, 0), (7, 6)])
def test_chunks_against_slicing(spark, length, size, overlap):
    alphabet = "aé\n𝄞 z"
    text = "".join(alphabet[(i * 7 + i // 5) % len(alphabet)] for i in range(length))
    expected = [text[s : s + size] for s in range(0, length, size - overlap)]
    assert chunks_of(spark, text, size=size, overlap=overlap) == expected


def test_null_text_has_no_chunks_and_overlap_is_checked(spark):
    assert chunks_of(spark, None) == []
    with pytest.raises(ValueError):
        chunks_of(spark, "a", size=5, overlap=5)


def test_templates_print_none(rows):
    df = rows([(1, None)], "a int, b string")
    assert df.select(render("a={a} b={b} c={c}!", c=F.col("a") + 1)).first()[0] == "a=1 b=None c=2!"
    assert df.select(as_text("b")).first()[0] == "None"


@pytest.mark.parametrize(
    "content, text",
    [
        ('[{"type":"reasoning","text":"r"},{"type":"text","text":"a"}]', "a"),
        ('[{"type":"text","text":"a"},{"type":"text","text":"b"}]', "b"),
        ('[1, "x", {"type":"text","text":"a"}]', "a"),
        ('[{"type":"text","text":""}]', '[{"type":"text","text":""}]'),
        ('[{"type":"text"}]', '[{"type":"text"}]'),
        ('[{"type":"reasoning","text":"r"}]', '[{"type":"reasoning","text":"r"}]'),
        ('{"type":"text","text":"a"}', '{"type":"text","text":"a"}'),
        ('[{"type":"text","text":"a"}] and more', '[{"type":"text","text":"a"}] and more'),
        ("plain words", "plain words"),
        ("[broken", "[broken"),
        ("", ""),
        (None, None),
    ],
)
def test_response_blocks(rows, content, text):
    assert rows([(content,)], "c string").select(parse_text_blocks("c")).first()[0] == text


def test_fields(rows):
    df = rows([("Policy Number: 12\nDeductible:   500\nPolicy State: OH",)], "t string")
    got = df.select(extract_fields(F.col("t"), retrieval.FIELD_LABELS).alias("f")).select("f.*").first().asDict()
    assert got == {"policy": "12", "umbrella": None, "deductible": "500", "coverage": None, "state": "OH"}


@pytest.mark.parametrize(
    "question, route",
    [
        ("Compare UMBRELLA deductibles", "umbrella"),
        ("Compare deductible by state", "deductible"),
        ("Compare states", "compare"),
        ("In California?", "state"),
        ("Which state?", "state"),
        ("Hello", "default"),
        (None, "default"),
    ],
)
def test_routes_are_tried_in_order(rows, question, route):
    assert rows([(question,)], "q string").select(retrieval.route_question("q")).first()[0] == route


SOURCES = [
    "Policy Number: 1\nDeductible: 500\nUmbrella Coverage: 0\nPolicy State: OH",
    "Policy Number: 2\nDeductible: 700\nUmbrella Coverage: 5000\nPolicy State: IN",
    "Policy Number: 3\nUmbrella Coverage: Yes",
    "Umbrella Coverage: None",
]


@pytest.mark.parametrize(
    "question, answer",
    [
        ("umbrella?", "Policies with umbrella coverage: ['2', '3']"),
        ("deductible?", "Policy 1 has deductible 500\nPolicy 2 has deductible 700\nPolicy 3 has deductible None"),
        ("compare", "Policy 1 has None coverage\nPolicy 2 has None coverage\nPolicy 3 has None coverage"),
        ("california", "Policies found: ['1', '2']"),
        ("anything", "Relevant policies:\nPolicy 1\nPolicy 2\nPolicy 3"),
    ],
)
def test_answers(rows, question, answer):
    df = rows([(question, SOURCES)], "q string, s array<string>")
    assert df.select(retrieval.compose_answer("q", "s")).first()[0] == answer


def test_embedding_is_a_unit_vector_of_words(rows):
    got = {r.t: np.array(r.e) for r in embed(rows([("Ab cd",), ("CD, ab!",), ("",), (None,)], "t string"), "t", "e", 64).collect()}
    assert np.linalg.norm(got["Ab cd"]) == pytest.approx(1.0, abs=1e-6)
    assert np.array_equal(got["Ab cd"], got["CD, ab!"])
    assert not got[""].any() and not got[None].any() and len(got[None]) == 64


def test_embedding_places_are_md5(rows):
    import hashlib

    place = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 32
    got = np.array(embed(rows([("Élan élan x2 été",)], "t string"), "t", "e", 32).first().e)
    counts = np.zeros(32)
    for term in ("élan", "élan", "x2", "été"):
        counts[place(term)] += 1
    assert got == pytest.approx(counts / np.linalg.norm(counts), abs=1e-7)


def test_retrieval_end_to_end_against_brute_force(spark, rows):
    docs = rows([(i, f"\nPolicy Number: {i}\nDeductible: {500 * (i % 4)}\nPolicy State: S{i % 3}\n") for i in range(60)], "p bigint, d string")
    chunks = retrieval.document_chunks(docs, "p", "d")
    questions = rows([("deductible of policy number 7",), ("policy state S2 number 11",)], "question string")
    known = {r.chunk_id: (r.chunk, np.array(r.v, np.float64)) for r in embed(chunks, "chunk", "v").collect()}
    asked = {r.question: np.array(r.v, np.float64) for r in embed(questions, "question", "v").collect()}
    got = {r.question: r for r in retrieval.answer_questions(questions, chunks).collect()}
    assert set(got) == set(asked)
    for question, vector in asked.items():
        ranked = sorted((float(((v - vector) ** 2).sum()), i) for i, (_, v) in known.items())[:5]
        assert got[question].source_policies == " | ".join(known[i][0] for _, i in ranked)
        assert got[question].confidence_score == pytest.approx(1 / (1 + ranked[0][0]))


def test_history_grows(spark, rows, tmp_path):
    answers = rows([("q", "a", 0.5, "s")], "question string, answer string, confidence_score double, source_policies string")
    for _ in range(2):
        retrieval.log_queries(answers, str(tmp_path / "history"))
    assert spark.read.parquet(str(tmp_path / "history")).count() == 2


def test_repeated_run_replaces_its_own_history(spark, rows, tmp_path):
    schema, target = "question string, answer string, confidence_score double, source_policies string", str(tmp_path / "history")
    retrieval.log_queries(rows([("q", "old", 0.5, "s"), ("r", "old", 0.5, "s")], schema), target, "2024-01-01")
    retrieval.log_queries(rows([("q", "other", 0.5, "s")], schema), target, "2024-01-02")
    retrieval.log_queries(rows([("q", "new", 0.5, "s")], schema), target, "2024-01-01")
    got = {(r[retrieval.RUN], r.question, r.answer) for r in retrieval.query_history(spark, target).collect()}
    assert got == {("2024-01-01", "q", "new"), ("2024-01-02", "q", "other")}


def test_json_keeps_null(rows):
    assert rows([(1, None)], "a int, b double").select(row_json("a", "b")).first()[0] == '{"a":1,"b":null}'
