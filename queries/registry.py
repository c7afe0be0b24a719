"""All registered queries: name -> function of (session, data folder)."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.embedding import embed
from medallion.functions.text import chunk_text, parse_text_blocks
from medallion.operators.dedupe import streaming_exact_distinct
from medallion.operators.joins import union_all
from medallion.operators.knn import knn_l2
from medallion.operators.quality import expect_or_drop, expectation_metrics, observe_expectations, quarantine
from medallion.plans import anomaly, dq_log, entities, explain, kpi, retrieval, star, views
from medallion.plans.catalogue import issue_catalogue
from medallion.plans.rulebook import ENTITIES, EXPECTATIONS, QUARANTINE
from medallion.session import fresh_dir
from medallion.sources.files import evolve, read_csv_by_header
from medallion.sources.lookups import region_mapper
from medallion.sources.schemas import RESCUED, SchemaHistory
from medallion.sources.tables import read_table, refresh_view, stream_table, write_overwrite
from medallion.streaming import metrics
from medallion.streaming.jobs import ingest_feed, read_snapshot, read_split, run_append, run_complete, run_split
from medallion.streaming.upserts import CHANGED, read_upserts, run_upserts
from queries.bronze import base_table, bronze

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-09-01"
WALL_CLOCK = ("ingestion_timestamp", "md_created_datetime", "_dq_detected_at", "last_detected_at", "generated_at")

# Rows of a raw file: compressed files cannot be split, so a delivery comes as many of them.
FILE_ROWS = 500_000

# Asked of the policy documents about every state that the policies name.
STATE_QUESTIONS = (
    "Which state is {} and who is insured there?",
    "How high is the deductible in {}?",
    "Who has umbrella protection in {}?",
    "Please compare what is covered in {}",
    "Tell me about {}",
)
# Five forms of question, asked about one policy.
POLICY_QUESTIONS = (
    "What is the deductible for policy {}?",
    "Does policy {} have umbrella coverage?",
    "Compare the coverage of policy {} with others",
    "In which state was policy {} written?",
    "What do we know about policy {}?",
)


def portable(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Column types that any engine prints alike; columns that hold the wall clock are left out."""

    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            number = column.cast("double")
            return number if digits is None else F.round(number, digits) + F.lit(0.0)
        if isinstance(field.dataType, T.IntegerType):
            return column.cast("bigint")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return column.cast("string")
        return column

    return df.select(*[plain(f).alias(f.name) for f in df.schema.fields if f.name not in WALL_CLOCK])


# -- layers -----------------------------------------------------------------------------------


def parsed(spark: SparkSession, sf: str, entity: str, stream: bool = False) -> DataFrame:
    """Cleaned frame that the quarantine rules look at."""
    raw = bronze(spark, sf, entity, stream)
    if entity == "customers":
        return entities.clean_customers(raw, region_mapper(spark))
    if entity == "sales":
        return entities.parse_sales(raw)
    return {"cars": entities.clean_cars, "claims": entities.clean_claims, "policy": entities.clean_policy}[entity](raw)


def clean(spark: SparkSession, sf: str, entity: str, stream: bool = False) -> DataFrame:
    df = parsed(spark, sf, entity, stream)
    return entities.expand_sales_region(df, region_mapper(spark)) if entity == "sales" else df


def gated(spark: SparkSession, sf: str, entity: str, stream: bool = False) -> DataFrame:
    """Clean (silver) table: cleaned rows that pass every DROP rule."""
    return expect_or_drop(clean(spark, sf, entity, stream), EXPECTATIONS[entity])


def rejected(spark: SparkSession, sf: str, entity: str, stream: bool = False) -> DataFrame:
    return quarantine(parsed(spark, sf, entity, stream), entity, QUARANTINE[entity])


def unified_customers(spark: SparkSession, sf: str) -> DataFrame:
    return entities.unify_customers(bronze(spark, sf, "customers"), region_mapper(spark))


def parsed_all(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {entity: parsed(spark, sf, entity) for entity in ENTITIES}


def log_of(frames: dict[str, DataFrame]) -> DataFrame:
    return dq_log.quality_log({e: quarantine(df, e, QUARANTINE[e]) for e, df in frames.items()})


def counts_of(frames: dict[str, DataFrame]) -> DataFrame:
    return dq_log.entity_counts({e: expect_or_drop(df, EXPECTATIONS[e]) for e, df in frames.items()})


def log(spark: SparkSession, sf: str) -> DataFrame:
    return log_of(parsed_all(spark, sf))


def counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts_of(parsed_all(spark, sf))


def stats(spark: SparkSession, sf: str) -> DataFrame:
    frames = parsed_all(spark, sf)
    return dq_log.issue_stats(log_of(frames), dq_log.rule_bridge(spark), counts_of(frames), issue_catalogue(spark))


def issues(spark: SparkSession, sf: str) -> DataFrame:
    return dq_log.describe_issues(stats(spark, sf), issue_catalogue(spark))


def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_customer(gated(spark, sf, "customers"))


def dim_car(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_car(gated(spark, sf, "cars"))


def dim_policy(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_policy(gated(spark, sf, "policy"))


def fact_claims(spark: SparkSession, sf: str) -> DataFrame:
    return star.fact_claims(gated(spark, sf, "claims"), gated(spark, sf, "policy"))


def fact_sales(spark: SparkSession, sf: str) -> DataFrame:
    return star.fact_sales(gated(spark, sf, "sales"))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly.score_claims(gated(spark, sf, "claims"))


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder."""
    target = fresh_dir(spark, label)
    write_overwrite(df, target)
    return read_table(spark, target)


def rejection_rate(spark: SparkSession, sf: str) -> DataFrame:
    """The facts are a stored table, as for any report. Counted straight after their join they would keep the
    join's partitioning, and a policy with very many claims would stay in one task."""
    facts = stored(spark, fact_claims(spark, sf).select("claim_id", "policy_id", "claim_rejected"), "facts")
    return views.claim_rejection_rate(dim_policy(spark, sf), facts, dim_customer(spark, sf))


def domains(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "policy": kpi.policy_kpis(dim_policy(spark, sf)),
        "claims": kpi.claims_kpis(fact_claims(spark, sf)),
        "customer": kpi.customer_kpis(dim_customer(spark, sf)),
    }


def offline_writer() -> Callable[[str], str]:
    """Stand-in for a served text model: repeats the facts of the prompt as a response document."""

    def answer(prompt: str) -> str:
        facts = prompt.split("\n\n")[1]
        return json.dumps([{"type": "reasoning", "text": "facts repeated"}, {"type": "text", "text": facts}])

    return answer


# -- queries ------------------------------------------------------------------------------------


def claim_scores(spark: SparkSession, sf: str) -> DataFrame:
    flags = [r.column for r in anomaly.RISK_RULES]
    df = scored(spark, sf).select(
        "claim_id", "policy_id", "total_amount", "processing_delay", "z_score", "claim_count", *flags,
        "anomaly_score", "priority", "triggered_rules",
    )
    return portable(df, 4)


def claim_priority_counts(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).groupBy("priority").agg(F.count("*").alias("claims"))


def anomaly_report(spark: SparkSession, sf: str) -> DataFrame:
    return portable(anomaly.anomaly_report(scored(spark, sf)))


def investigation_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly.investigation_prompts(scored(spark, sf))


def kpi_json(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.summary_prompts(domains(spark, sf)).select("domain", "kpi_data")


def summary_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.summary_prompts(domains(spark, sf)).select("domain", "summary_title", "prompt")


def domain_summaries(spark: SparkSession, sf: str) -> DataFrame:
    return portable(kpi.domain_summaries(domains(spark, sf), offline_writer, "offline"))


def dq_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return explain.dq_prompts(issues(spark, sf)).select("issue_id", "prompt")


def dq_explanations(spark: SparkSession, sf: str) -> DataFrame:
    return portable(explain.dq_explanations(issues(spark, sf), offline_writer, "offline"))


def enrich_issues(spark: SparkSession, sf: str) -> DataFrame:
    """The log is stored first: statistics and events then read it instead of cleaning everything twice."""
    frames = parsed_all(spark, sf)
    events = stored(spark, log_of(frames), "log")
    bridge, catalogue = dq_log.rule_bridge(spark), issue_catalogue(spark)
    numbers = dq_log.issue_stats(events, bridge, counts_of(frames), catalogue)
    return portable(dq_log.enrich_issues(events, bridge, numbers, catalogue))


def policy_documents(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.policy_documents(dim_policy(spark, sf))


def policy_fields(spark: SparkSession, sf: str) -> DataFrame:
    fields = retrieval.policy_fields(F.col("policy_doc")).alias("found")
    return policy_documents(spark, sf).select("policy_number", fields).select("policy_number", "found.*")


def route_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Five questions about every policy, the form each asks for and the answer from that policy's text."""
    asked = F.array(*[F.format_string(q.replace("{}", "%d"), "policy_number") for q in POLICY_QUESTIONS])
    per_policy = policy_documents(spark, sf).select("policy_number", "policy_doc", F.explode(asked).alias("question"))
    return per_policy.select(
        "policy_number",
        "question",
        retrieval.route_question("question").alias("route"),
        retrieval.compose_answer("question", F.array("policy_doc")).alias("answer"),
    )


def policy_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.document_chunks(policy_documents(spark, sf), "policy_number", "policy_doc")


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """Five questions about every state."""
    states = dim_policy(spark, sf).select("policy_state").filter("policy_state is not null").distinct()
    asked = F.array(*[F.format_string(q.replace("{}", "%s"), "policy_state") for q in STATE_QUESTIONS])
    return states.select(F.explode(asked).alias("question"))


def retrieve_answers(spark: SparkSession, sf: str) -> DataFrame:
    return portable(retrieval.answer_questions(questions(spark, sf), policy_chunks(spark, sf)), 6)


def query_history(spark: SparkSession, sf: str) -> DataFrame:
    """Answers appended to the stored history, the run repeated, then read back."""
    target, answers = fresh_dir(spark, "query-history"), stored(spark, retrieve_answers(spark, sf), "answers")
    for _ in range(2):
        retrieval.log_queries(answers, target, run_id="first")
    return retrieval.query_history(spark, target).drop(retrieval.RUN)


def chunk_documents(spark: SparkSession, sf: str) -> DataFrame:
    texts = base_table(spark, sf, "documents").select("doc_id", "text")
    return portable(chunk_text(texts, "text"))


def embed_documents(spark: SparkSession, sf: str) -> DataFrame:
    texts = base_table(spark, sf, "documents").select("doc_id", "text")
    return embed(texts, "text").select("doc_id", "embedding")


def class_centres(spark: SparkSession, sf: str) -> DataFrame:
    """Mean vector per label over the whole table: as many search queries as there are labels."""
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    means = base_table(spark, sf, "embeddings").groupBy("label").agg(Summarizer.mean(vector).alias("mean"))
    # Rounded, so that the order of summation cannot change a neighbour.
    return means.select("label", F.transform(vector_to_array("mean"), lambda x: F.round(x, 4)).alias("centre"))


def nearest_to_centres(spark: SparkSession, sf: str) -> DataFrame:
    corpus = base_table(spark, sf, "embeddings").select("vec_id", "embedding")
    return knn_l2(class_centres(spark, sf), corpus, 5, "label", "centre", "vec_id", "embedding")


def knn_exact(spark: SparkSession, sf: str) -> DataFrame:
    return portable(nearest_to_centres(spark, sf), 6)


def retrieval_confidence(spark: SparkSession, sf: str) -> DataFrame:
    best = nearest_to_centres(spark, sf).filter("rank = 1")
    return portable(best.select("label", retrieval.confidence(F.col("distance")).alias("confidence_score")), 6)


def response_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Responses of four kinds made from conversation turns: plain text, one block, two blocks, no text block."""

    def block(kind: str, text: str):
        return F.struct(F.lit(kind).alias("type"), F.col(text).alias("text"))

    kind = F.col("turn") % 4
    content = (
        F.when(kind == 0, F.col("text"))
        .when(kind == 1, F.to_json(F.array(block("reasoning", "role"), block("text", "text"))))
        .when(kind == 2, F.to_json(F.array(block("text", "role"), block("text", "text"))))
        .otherwise(F.to_json(F.array(block("reasoning", "role"))))
    )
    return base_table(spark, sf, "conversations").select("conv_id", "turn", content.alias("content"))


def text_blocks(spark: SparkSession, sf: str) -> DataFrame:
    answers = response_documents(spark, sf)
    return portable(answers.select("conv_id", "turn", parse_text_blocks("content").alias("answer")))


def evolved_union(spark: SparkSession, sf: str) -> DataFrame:
    """Events of two feeds: the older one had no ``props`` column yet."""
    events = base_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    is_old = F.col("event_type").isin("click", "view")
    return evolve(events.filter(is_old).drop("props"), events.filter(~is_old))


def csv_by_header(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written as CSV files with three different headers, read back by name and unified."""
    raw = bronze(spark, sf, "customers").drop("ingestion_timestamp")
    folder = fresh_dir(spark, "customer-files")
    number = F.regexp_extract("source_file", "([0-9])", 1).cast("int")
    common = ["State", "DefaultFlag", "Balance", "HHInsurance", "CarLoan", "Job"]
    own = ["CustomerID", "Reg", "City", "Marital_status", "Education"]
    headers = {
        "plain": (~number.isin(2, 4, 7), [*own, *common]),
        "wide": (number.isin(4, 7), [*common, "Region", *own]),
        "other": (number == 2, ["Customer_ID", "cust_id", "Region", "City_in_state", "Marital", "Edu", *common]),
    }
    for name, (rows, columns) in headers.items():
        out = raw.filter(rows).select(*columns).write.option("header", "true")
        out.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(f"{folder}/{name}")
    read = read_csv_by_header(spark, folder, "part-*.csv")
    return portable(entities.unify_customers(read, region_mapper(spark)).drop("source_file"))


def refresh_rejection_rate(spark: SparkSession, sf: str) -> DataFrame:
    """The view stored as a table and read from there."""
    return refresh_view(spark, fresh_dir(spark, "rejection-rate"), lambda s: rejection_rate(s, sf))


# -- streams: run to the end of the input, then return the sink as a static frame ----------------

STATELESS = ("cars", "claims", "policy", "sales")


def cores(spark: SparkSession) -> int:
    """State partitions of a stream: one per core."""
    return spark.sparkContext.defaultParallelism


def snapshot(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Run an aggregating stream in complete mode and return its last snapshot."""
    target = fresh_dir(spark, label)
    run_complete(df, target, fresh_dir(spark, f"{label}-checkpoint"), cores(spark))
    return read_snapshot(spark, target)


def appended(spark: SparkSession, df: DataFrame, label: str, stateful: bool = True) -> str:
    """Run a stream into a table of its own and return the table's path. Without state the session says how many shuffle partitions."""
    target = fresh_dir(spark, label)
    run_append(df, target, fresh_dir(spark, f"{label}-checkpoint"), state_partitions=cores(spark) if stateful else None)
    return target


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return portable(read_table(spark, appended(spark, gated(spark, sf, "policy", stream=True), "policy")))


def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Which row of a customer survives depends on arrival, so only the keys are returned."""
    target = appended(spark, gated(spark, sf, "customers", stream=True), "customers")
    return read_table(spark, target).select("customer_id")


def stream_exact_distinct(spark: SparkSession, sf: str) -> DataFrame:
    claims = gated(spark, sf, "claims", stream=True)
    return snapshot(spark, streaming_exact_distinct(claims, ["incident_severity"], "policy_id", "policies"), "distinct")


def stream_fact_claims(spark: SparkSession, sf: str) -> DataFrame:
    facts = star.fact_claims(gated(spark, sf, "claims", stream=True), gated(spark, sf, "policy"))
    return portable(read_table(spark, appended(spark, facts, "facts", stateful=False)))


def streamed_log(spark: SparkSession, sf: str) -> str:
    """Event log of the entities whose cleaning does not depend on arrival order."""
    events = dq_log.quality_log({e: rejected(spark, sf, e, stream=True) for e in STATELESS})
    return appended(spark, events, "log")


def stream_quality_log(spark: SparkSession, sf: str) -> DataFrame:
    return portable(read_table(spark, streamed_log(spark, sf)))


def stream_issue_stats(spark: SparkSession, sf: str) -> DataFrame:
    events = stream_table(spark, streamed_log(spark, sf))
    totals = counts_of({e: parsed(spark, sf, e) for e in STATELESS})
    live = dq_log.issue_stats(events, dq_log.rule_bridge(spark), totals, issue_catalogue(spark))
    return portable(snapshot(spark, live, "stats"))


def stream_enrich_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Event stream joined to the statistics of the log it comes from."""
    path = streamed_log(spark, sf)
    bridge, catalogue = dq_log.rule_bridge(spark), issue_catalogue(spark)
    totals = counts_of({e: parsed(spark, sf, e) for e in STATELESS})
    numbers = dq_log.issue_stats(read_table(spark, path), bridge, totals, catalogue)
    enriched = dq_log.enrich_issues(stream_table(spark, path), bridge, numbers, catalogue)
    return portable(read_table(spark, appended(spark, enriched, "issues")))


def survivors(spark: SparkSession, sf: str) -> DataFrame:
    """Stream of the customers kept, in complete mode."""
    return entities.first_customers(bronze(spark, sf, "customers", stream=True), region_mapper(spark))


def stream_survivors(spark: SparkSession, sf: str) -> DataFrame:
    """Customers kept on a stream, all columns: the same rows as in batch."""
    return portable(snapshot(spark, survivors(spark, sf), "survivors"))


def streamed_logs(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Event logs of all entities: one that grows, and that of customers, whose survivors may still change."""
    rejects = quarantine(survivors(spark, sf), "customers", QUARANTINE["customers"])
    path = fresh_dir(spark, "customer-log")
    snapshot(spark, dq_log.quality_log({"customers": rejects}), "customer-events").write.parquet(path)
    return streamed_log(spark, sf), path


def stream_quality_log_all(spark: SparkSession, sf: str) -> DataFrame:
    return portable(union_all([read_table(spark, p) for p in streamed_logs(spark, sf)]))


def stream_issue_stats_all(spark: SparkSession, sf: str) -> DataFrame:
    events = union_all([stream_table(spark, p) for p in streamed_logs(spark, sf)])
    totals = counts_of(parsed_all(spark, sf))
    live = dq_log.issue_stats(events, dq_log.rule_bridge(spark), totals, issue_catalogue(spark))
    return portable(snapshot(spark, live, "stats"))


def stream_enrich_issues_all(spark: SparkSession, sf: str) -> DataFrame:
    paths = streamed_logs(spark, sf)
    bridge, catalogue = dq_log.rule_bridge(spark), issue_catalogue(spark)
    numbers = dq_log.issue_stats(union_all([read_table(spark, p) for p in paths]), bridge, counts_of(parsed_all(spark, sf)), catalogue)
    enriched = dq_log.enrich_issues(union_all([stream_table(spark, p) for p in paths]), bridge, numbers, catalogue)
    return portable(read_table(spark, appended(spark, enriched, "issues")))


def stream_split_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Clean and quarantined claims written from one pass over the stream."""
    target = fresh_dir(spark, "claims")
    claims = parsed(spark, sf, "claims", stream=True)
    run_split(
        claims, "claims", EXPECTATIONS["claims"], QUARANTINE["claims"], target, fresh_dir(spark, "claims-checkpoint")
    )
    good, bad = read_split(spark, target)
    kept = good.select(F.lit("clean").alias("kind"), "claim_id", F.lit("").alias("_dq_rule"))
    return union_all([kept, bad.select(F.lit("quarantine").alias("kind"), "claim_id", "_dq_rule")])


def drifting_claims(spark: SparkSession, sf: str) -> tuple[str, SchemaHistory]:
    """Raw table of claims that came as compressed JSON lines in three deliveries: amounts as numbers, as text, and with a new column."""
    raw = bronze(spark, sf, "claims").drop("source_file", "ingestion_timestamp")
    folder, target = fresh_dir(spark, "claim-files"), fresh_dir(spark, "claims-raw")
    history, checkpoint = SchemaHistory(spark, fresh_dir(spark, "claims-schema")), fresh_dir(spark, "claims-ingest")
    delivery = F.coalesce(F.col("ClaimID") % 3, F.lit(0))
    numbers = {c: F.col(c).try_cast("bigint" if c == "injury" else "double") for c in ("injury", "property", "vehicle")}
    forms = (numbers, {}, {"adjuster": F.concat(F.lit("desk "), F.col("witnesses"))})
    for n, form in enumerate(forms):
        out = raw.filter(delivery == n).withColumns(form).write.option("maxRecordsPerFile", FILE_ROWS)
        out.json(f"{folder}/{n}", compression="gzip")
        ingest_feed(spark, folder, "part-*.json.gz", target, checkpoint, history, multi_line=False)
    return target, history


def raw_to_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Clean claims of feeds whose types drifted: the same as of the feed that did not."""
    path, history = drifting_claims(spark, sf)
    stream = stream_table(spark, path, schema=history.table_schema())
    target, checkpoint = fresh_dir(spark, "claims"), fresh_dir(spark, "claims-checkpoint")
    run_split(entities.clean_claims(stream), "claims", EXPECTATIONS["claims"], QUARANTINE["claims"], target, checkpoint)
    return portable(read_split(spark, target)[0].drop("source_file"))


def rescued_values(spark: SparkSession, sf: str) -> DataFrame:
    """Values of the claims that did not fit their column's type, one row each."""
    path, history = drifting_claims(spark, sf)
    rows = spark.read.schema(history.table_schema()).parquet(path).filter(F.col(RESCUED).isNotNull())
    values = F.from_json(RESCUED, "map<string,string>")
    return rows.select("ClaimID", F.explode(values).alias("column_name", "raw_value")).filter("column_name <> '_file_path'").select(
        F.col("ClaimID").cast("bigint").alias("claim_id"), "column_name", "raw_value"
    )


def late_survivors(spark: SparkSession, sf: str) -> str:
    """Table of the customers kept, whose files came in three deliveries, the first ones last."""
    raw = bronze(spark, sf, "customers")
    folder, target, checkpoint = (fresh_dir(spark, f"late-{k}") for k in ("files", "customers", "checkpoint"))
    number = F.regexp_extract("source_file", "([0-9])", 1).cast("int")
    for wanted in ((5, 6, 7), (3, 4), (1, 2)):
        raw.filter(number.isin(*wanted)).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(raw.schema).parquet(folder)
        run_upserts(entities.first_customers(stream, region_mapper(spark)), target, checkpoint, ["customer_id"], cores(spark), fold_after=1)
    return target


def late_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers after late deliveries: the rows that batch cleaning keeps."""
    return portable(read_upserts(spark, late_survivors(spark, sf), ["customer_id"]).drop(CHANGED))


def late_customer_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events of the customers after late deliveries; those of replaced rows are gone."""
    rows = read_upserts(spark, late_survivors(spark, sf), ["customer_id"])
    return portable(dq_log.quality_log({"customers": quarantine(rows, "customers", QUARANTINE["customers"])}))


def stream_expectations(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of the expectations, taken from the streams that feed the clean and quarantine tables."""
    numbers = fresh_dir(spark, "expectation-metrics")
    for entity in STATELESS:
        rules, target = EXPECTATIONS[entity], fresh_dir(spark, entity)
        with metrics.observing(spark, rules, numbers, entity) as store:
            observed = observe_expectations(clean(spark, sf, entity, stream=True), rules, metrics.OBSERVED)
            store(run_split(observed, entity, rules, QUARANTINE[entity], target, fresh_dir(spark, f"{entity}-checkpoint")))
    kept = snapshot(spark, survivors(spark, sf), "survivors")
    now = expectation_metrics(kept, EXPECTATIONS["customers"]).select(F.lit("customers").alias("entity"), "*")
    return union_all([metrics.totals(spark, numbers), now])


def _per_entity() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for entity in ENTITIES:
        found[f"clean_{entity}"] = lambda s, d, e=entity: portable(clean(s, d, e))
        found[f"gate_{entity}"] = lambda s, d, e=entity: portable(gated(s, d, e))
        found[f"expectations_{entity}"] = lambda s, d, e=entity: expectation_metrics(clean(s, d, e), EXPECTATIONS[e])
        found[f"quarantine_{entity}"] = lambda s, d, e=entity: portable(rejected(s, d, e))
    return found


QUERIES: dict[str, Query] = {
    **_per_entity(),
    "quality_log": lambda s, d: portable(log(s, d)),
    "entity_counts": counts,
    "issue_stats": lambda s, d: portable(stats(s, d)),
    "enrich_issues": enrich_issues,
    "dim_customer": lambda s, d: portable(dim_customer(s, d)),
    "dim_car": lambda s, d: portable(dim_car(s, d)),
    "dim_policy": lambda s, d: portable(dim_policy(s, d)),
    "fact_claims": lambda s, d: portable(fact_claims(s, d)),
    "fact_sales": lambda s, d: portable(fact_sales(s, d)),
    "multi_region_customers": lambda s, d: views.multi_region_customers(unified_customers(s, d)),
    "claim_rejection_rate": rejection_rate,
    "refresh_rejection_rate": refresh_rejection_rate,
    "unsold_by_model_region": lambda s, d: views.unsold_by_model_region(fact_sales(s, d), dim_car(s, d)),
    "aging_buckets": lambda s, d: views.aging_buckets(fact_sales(s, d), AS_OF),
    "claim_scores": claim_scores,
    "claim_priority_counts": claim_priority_counts,
    "anomaly_report": anomaly_report,
    "investigation_prompts": investigation_prompts,
    "kpis_policy": lambda s, d: portable(kpi.policy_kpis(dim_policy(s, d)), 4),
    "kpis_claims": lambda s, d: portable(kpi.claims_kpis(fact_claims(s, d)), 4),
    "kpis_customer": lambda s, d: kpi.customer_kpis(dim_customer(s, d)),
    "kpi_json": kpi_json,
    "summary_prompts": summary_prompts,
    "domain_summaries": domain_summaries,
    "dq_prompts": dq_prompts,
    "dq_explanations": dq_explanations,
    "policy_documents": policy_documents,
    "policy_fields": policy_fields,
    "route_questions": route_questions,
    "retrieve_answers": retrieve_answers,
    "query_history": query_history,
    "chunk_documents": chunk_documents,
    "embed_documents": embed_documents,
    "knn_exact": knn_exact,
    "retrieval_confidence": retrieval_confidence,
    "parse_text_blocks": text_blocks,
    "evolved_union": evolved_union,
    "csv_by_header": csv_by_header,
    "stream_ingest": stream_ingest,
    "stream_dedupe": stream_dedupe,
    "stream_exact_distinct": stream_exact_distinct,
    "stream_fact_claims": stream_fact_claims,
    "stream_quality_log": stream_quality_log,
    "stream_issue_stats": stream_issue_stats,
    "stream_enrich_issues": stream_enrich_issues,
    "stream_split_quality": stream_split_quality,
    "stream_survivors": stream_survivors,
    "stream_quality_log_all": stream_quality_log_all,
    "stream_issue_stats_all": stream_issue_stats_all,
    "stream_enrich_issues_all": stream_enrich_issues_all,
    "raw_to_silver": raw_to_silver,
    "rescued_values": rescued_values,
    "late_customers": late_customers,
    "late_customer_events": late_customer_events,
    "stream_expectations": stream_expectations,
}
