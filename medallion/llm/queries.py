"""The operators as queries over whole tables, and reference SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import decontaminate, jaccard, lm, merkle, neardup, packing, pii, quality, rules, toxicity, urls, vectorcodes, warc
from medallion.llm.oracles import ORACLES as _MORE
from medallion.llm.tables import held_out, load

Query = Callable[[SparkSession, str], DataFrame]

#: A key of a real run comes from the caller's secret store.
PSEUDONYM_KEY = "test tables only"

# Rules of the query contract (host, path, verdict).
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def _predicted(scored: DataFrame, threshold: float, *more: str) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out("doc_id", 5, 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
        *more,
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = quality.fit(docs, load(spark, sf_dir, "labels"))
    return _predicted(quality.score_quality(docs, model), 0.3, "n_chunks")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.mask_text(load(spark, sf_dir, "documents"), PSEUDONYM_KEY).select("doc_id", "text", "n_replaced")


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return lm.score_documents(docs, lm.learn(docs))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(load(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return _predicted(scored.withColumn("n_offending", F.size("offending")), 0.5, "n_sentences", "n_offending")


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(load(spark, sf_dir, "embeddings"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(load(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(load(spark, sf_dir, "pages"), URL_RULES).drop("template", "purity")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents"))


#: Order in which a document's columns enter its leaf.
_LEAF = ["doc_id", "source", "lang", "n_chars", "text"]
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    lowered = {"text": F.translate(docs["text"], _CAPITALS, _SMALL)}
    touched = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0
    tampered = F.when(touched, F.unhex(merkle.row_digest(docs, _LEAF, lowered)))
    proofs = merkle.manifest(docs, _LEAF, keep={"tampered": tampered})
    now = F.coalesce(F.lower(F.hex("tampered")), F.col("leaf"))
    folded = proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("siblings")).alias("proof_sha256"),
        merkle.folded(now, F.col("siblings")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.keep_good(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(F.col("id").alias("doc_id"), *counts, "base_failed", "kept")


def op13_vectorcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = vectorcodes.compress(load(spark, sf_dir, "embeddings"))
    return codes.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality, op2_pii, op3_lm, op4_jaccard, op5_decontaminate, op6_toxicity, op7_neardup, op8_warc, op9_urls, op10_packing,
        op11_merkle, op12_rules, op13_vectorcodes,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op4_jaccard": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id
FROM sets s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.s
""",
    "op7_neardup": """
WITH RECURSIVE parts AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), unit AS (
  SELECT vec_id, label, x, sqrt(list_dot_product(x, x)) AS n FROM parts WHERE list_dot_product(x, x) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.98
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a), least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(l.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN least_of l ON l.a = e.vec_id
""",
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex FROM p),
b AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST(((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS BIGINT), 1)), '')
    AS payload_digest, max(page_id) OVER (PARTITION BY hex) AS whole
  FROM d
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = whole THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = whole THEN NULL ELSE whole END AS refers_to
FROM b
""",
    **_MORE,
}
