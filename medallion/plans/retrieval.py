"""Question answering over policy documents: chunk, embed, search, extract, answer."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions.embedding import embed
from medallion.functions.text import as_text, chunk_text, extract_fields, render
from medallion.operators.knn import knn_l2

POLICY_TEXT = (
    "\nPolicy Number: {policy_number}\nDeductible: {policy_deductable}\n"
    "Umbrella Coverage: {umbrella_limit}\nPolicy State: {policy_state}\n"
)
# The labels a field follows in a document.
FIELD_LABELS = {
    "policy": "Policy Number",
    "umbrella": "Umbrella Coverage",
    "deductible": "Deductible",
    "coverage": "Coverage Tier",
    "state": "Policy State",
}
# Words that decide the form of an answer, tested in this order.
ROUTES = (
    ("umbrella", ("umbrella",)),
    ("deductible", ("deductible",)),
    ("compare", ("compare",)),
    ("state", ("california", "state")),
)
TOP_K = 5
RUN = "_run"

Embedder = Callable[[DataFrame, str, str], DataFrame]


def policy_documents(dim_policy: DataFrame) -> DataFrame:
    """One short text per policy."""
    return dim_policy.select("policy_number", render(POLICY_TEXT).alias("policy_doc"))


def document_chunks(documents: DataFrame, doc_id: str, text: str, size: int = 200, overlap: int = 50) -> DataFrame:
    """Chunks with an id made of document id and position."""
    chunks = chunk_text(documents.select(doc_id, text), text, size, overlap)
    return chunks.withColumn("chunk_id", F.concat_ws("-", F.col(doc_id).cast("string"), "chunk_pos"))


def policy_fields(text: Column) -> Column:
    return extract_fields(text, FIELD_LABELS)


def route_question(question: Column | str) -> Column:
    """Form of the answer a question asks for."""
    text = F.lower(F.col(question) if isinstance(question, str) else question)
    tests = [F.when(text.contains(word), F.lit(form)) for form, words in ROUTES for word in words]
    return F.coalesce(*tests, F.lit("default"))


def confidence(distance: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + distance)


def _listed(values: Column) -> Column:
    quoted = F.transform(values, lambda v: F.concat(F.lit("'"), v, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def compose_answer(question: Column | str, sources: Column | str) -> Column:
    """Answer text from the retrieved chunks (best first), in the form the question asks for."""
    chunks = F.col(sources) if isinstance(sources, str) else sources
    fields = F.transform(chunks, policy_fields)
    named = F.filter(fields, lambda f: f["policy"].isNotNull())

    def policies(keep: Callable[[Column], Column]) -> Column:
        return F.transform(F.filter(fields, keep), lambda f: as_text(f["policy"]))

    def lines(line: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(named, line), "\n")

    def policy_is(f: Column) -> Column:
        return F.concat(F.lit("Policy "), f["policy"])

    def has_umbrella(f: Column) -> Column:
        return F.coalesce((f["umbrella"] == "Yes") | (f["umbrella"].try_cast("double") > 0), F.lit(False))

    route = route_question(question)
    return (
        F.when(
            route == "umbrella",
            F.concat(F.lit("Policies with umbrella coverage: "), _listed(policies(has_umbrella))),
        )
        .when(
            route == "deductible",
            lines(lambda f: F.concat(policy_is(f), F.lit(" has deductible "), as_text(f["deductible"]))),
        )
        .when(
            route == "compare",
            lines(lambda f: F.concat(policy_is(f), F.lit(" has "), as_text(f["coverage"]), F.lit(" coverage"))),
        )
        .when(
            route == "state",
            F.concat(F.lit("Policies found: "), _listed(policies(lambda f: f["state"].isNotNull()))),
        )
        .otherwise(F.concat(F.lit("Relevant policies:\n"), lines(policy_is)))
    )


def retrieve(
    questions: DataFrame, chunks: DataFrame, k: int = TOP_K, embedder: Embedder = embed, question: str = "question"
) -> DataFrame:
    """Top chunks per question: question, sources (best first) and confidence of the best.

    ``chunks`` needs ``chunk_id`` and ``chunk``. At most ``k`` chunks per question are collected.
    """
    asked = embedder(questions.select(question).distinct(), question, "_asked")
    corpus = embedder(chunks.select("chunk_id", "chunk"), "chunk", "_known")
    found = knn_l2(asked, corpus, k, question, "_asked", "chunk_id", "_known", payload=["chunk"])
    ranked = F.array_sort(F.collect_list(F.struct("rank", "distance", "chunk")))
    hits = found.groupBy(question).agg(ranked.alias("_hits"))
    return hits.select(
        question,
        F.col("_hits.chunk").alias("sources"),
        confidence(F.col("_hits")[0]["distance"]).alias("confidence_score"),
    )


def answer_questions(
    questions: DataFrame, chunks: DataFrame, k: int = TOP_K, embedder: Embedder = embed, question: str = "question"
) -> DataFrame:
    """One row per question: answer, confidence and the sources joined with `` | ``."""
    return retrieve(questions, chunks, k, embedder, question).select(
        question,
        compose_answer(question, "sources").alias("answer"),
        "confidence_score",
        F.array_join("sources", " | ").alias("source_policies"),
    )


def log_queries(answers: DataFrame, target: str, run_id: str | None = None) -> None:
    """Append answered questions to the query history.

    Rows of a run lie in a folder named after ``run_id``, so a run that is repeated replaces its own rows.
    """
    answers.write.mode("overwrite").parquet(f"{target}/{RUN}={run_id or uuid.uuid4().hex}")


def query_history(spark: SparkSession, target: str) -> DataFrame:
    """All answered questions, with the run that answered them."""
    return spark.read.parquet(target).withColumn(RUN, F.col(RUN).cast("string"))
