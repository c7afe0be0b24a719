"""The whole chain from raw files to reports, as jobs that take what is new and stop.

Every job is an ordinary function; run them in the order of ``run_all``, as often as files arrive.
Streams remember in their checkpoint what they have taken, so a run that fails is simply repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.enrich import MakeFunction
from medallion.operators.joins import union_all
from medallion.operators.quality import CLEAN, expect_or_drop, expectation_metrics, observe_expectations, quarantine
from medallion.operators.quality import QUARANTINE as QUARANTINE_TABLE
from medallion.plans import anomaly, dq_log, entities, explain, kpi, star, views
from medallion.plans.catalogue import ISSUE_SCHEMA, issue_catalogue
from medallion.plans.rulebook import ENTITIES, EXPECTATIONS, QUARANTINE
from medallion.sources.files import ENTITY_GLOBS, any_file
from medallion.sources.lookups import REGION_SCHEMA, region_mapper, store_lookup, stored_lookup
from medallion.sources.schemas import SchemaHistory
from medallion.sources.tables import read_table, refresh_view, stream_table, table_exists, write_overwrite
from medallion.streaming import metrics
from medallion.streaming.jobs import ingest_feed, read_snapshot, read_split, run_append, run_complete, run_split
from medallion.streaming.upserts import CHANGED, read_upserts, run_upserts

# Entities of which a late file may replace a row that has been taken already, and their keys.
RETRACTING = {"customers": ["customer_id"]}
# Lookups that analysts may change: rows to begin with, declared columns, keys.
LOOKUPS: dict[str, tuple[Callable[[SparkSession], DataFrame], T.StructType, list[str]]] = {
    "region_mapper": (region_mapper, REGION_SCHEMA, ["reg_coded"]),
    "dq_rule_mapping": (dq_log.rule_bridge, dq_log.BRIDGE_SCHEMA, ["entity", "_dq_rule"]),
    "dq_issue_catalogue": (issue_catalogue, ISSUE_SCHEMA, ["issue_id"]),
}
# Tables that are an append log for the other entities, and for these a table of what holds now.
_LOGS = ("quality_issues_log", "dq_issues")


@dataclass(frozen=True)
class Lake:
    """Where tables and checkpoints live: folders under one root that all executors can reach."""

    spark: SparkSession
    root: str

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def has(self, layer: str, *names: str) -> bool:
        return all(table_exists(self.spark, self.table(layer, n)) for n in names)

    def entities(self, layer: str) -> list[str]:
        """Entities whose feed has brought something so far."""
        return [e for e in ENTITIES if self.has(layer, e)]

    def lookup(self, name: str) -> DataFrame:
        """A stored lookup, filled with the rows written in code when it is first asked for."""
        first_rows, schema, keys = LOOKUPS[name]
        if not self.has("lookups", name):
            store_lookup(first_rows(self.spark), self.table("lookups", name), schema, keys)
        return stored_lookup(self.spark, self.table("lookups", name), keys)

    def set_lookup(self, name: str, rows: DataFrame) -> None:
        """Replace a lookup's rows; refused if a declared column is missing or NULL or a key stands twice."""
        store_lookup(rows, self.table("lookups", name), *LOOKUPS[name][1:])

    def schemas(self, entity: str) -> SchemaHistory:
        """Schema versions of a raw feed."""
        return SchemaHistory(self.spark, self.table("schemas", entity))

    def bronze_schema(self, entity: str) -> T.StructType | None:
        """Schema of a raw table; none for one that was written without a history."""
        history = self.schemas(entity)
        return history.table_schema() if history.rows() else None

    def read(self, layer: str, name: str) -> DataFrame:
        known = self.bronze_schema(name) if layer == "bronze" else None
        if known:
            return self.spark.read.schema(known).parquet(self.table(layer, name))
        if layer == "silver" and name in _LOGS:
            parts = [t for t in (name, f"{name}_current") if self.has("silver", t)]
            return union_all([read_table(self.spark, self.table("silver", t)) for t in parts])
        return read_table(self.spark, self.table(layer, name), evolving=layer == "bronze")

    def stream(self, entity: str, kind: str) -> DataFrame:
        """New rows of the clean or the quarantine table. The sink's root is read, so its commit log decides
        which files count; a batch that failed and was repeated is taken once."""
        return stream_table(self.spark, self.table("silver", entity)).filter(F.col("_table") == kind).drop("_table")

    def present(self, entity: str) -> DataFrame:
        """Rows of a retracting entity as they are now, clean or not, with the time of their last change."""
        return read_upserts(self.spark, self.table("silver", entity), RETRACTING[entity])

    def silver(self, entity: str) -> DataFrame:
        if entity in RETRACTING:
            return expect_or_drop(self.present(entity).drop(CHANGED), EXPECTATIONS[entity])
        return read_split(self.spark, self.table("silver", entity))[0]

    def quarantine(self, entity: str) -> DataFrame:
        if entity in RETRACTING:
            bad = quarantine(self.present(entity), entity, QUARANTINE[entity])
            return bad.withColumn("_dq_detected_at", F.col(CHANGED)).drop(CHANGED)
        return read_split(self.spark, self.table("silver", entity))[1]

    def retracting(self) -> list[str]:
        return [e for e in RETRACTING if self.has("silver", e)]

    def stats(self) -> DataFrame:
        """Issue counters, of the latest snapshot and of what holds now, against the row counts of the latest run."""
        counters = []
        if self.has("silver", "live_issue_counters"):
            counters.append(read_snapshot(self.spark, self.table("silver", "live_issue_counters")))
        if self.has("silver", "quality_issues_log_current"):
            events = read_table(self.spark, self.table("silver", "quality_issues_log_current"))
            counters.append(dq_log.issue_counters(events, self.lookup("dq_rule_mapping")))
        counts = self.read("silver", "silver_entity_counts")
        return dq_log.with_totals(union_all(counters), counts, self.lookup("dq_issue_catalogue"))

    def expectations(self) -> DataFrame:
        """Per entity and rule, how many rows met it and how many did not, over all that has come."""
        parts = []
        if self.has("silver", "expectation_metrics"):
            parts.append(metrics.totals(self.spark, self.table("silver", "expectation_metrics")))
        if self.has("silver", "expectation_metrics_current"):
            parts.append(self.read("silver", "expectation_metrics_current"))
        return union_all(parts)


def ingest_bronze(lake: Lake, raw: str, max_files: int = 1000) -> None:
    """New raw files of every entity into bronze tables, with provenance; feeds without a file are left out."""
    for entity, glob in ENTITY_GLOBS.items():
        if not any_file(lake.spark, raw, glob):
            continue
        target, checkpoint = lake.table("bronze", entity), lake.checkpoint(f"bronze-{entity}")
        ingest_feed(lake.spark, raw, glob, target, checkpoint, lake.schemas(entity), max_files=max_files)


def clean_entity(spark: SparkSession, entity: str, bronze: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """The cleaning plan of an entity, on a batch frame or a stream.

    A stream of customers is to be run in update mode: the first by file name is kept, whenever its file comes.
    """
    customers = entities.first_customers if bronze.isStreaming else entities.clean_customers
    with_regions: dict[str, Callable] = {"customers": customers, "sales": entities.clean_sales}
    alone: dict[str, Callable] = {
        "cars": entities.clean_cars,
        "claims": entities.clean_claims,
        "policy": entities.clean_policy,
    }
    if entity in with_regions:
        return with_regions[entity](bronze, region_mapper(spark) if regions is None else regions)
    return alone[entity](bronze)


def build_silver(lake: Lake) -> None:
    """New bronze rows into the clean and quarantine tables, one pass per entity, and counts of the expectations.

    Customers go to a table of the rows that are kept now, from which clean and quarantined ones are read.
    """
    numbers = lake.table("silver", "expectation_metrics")
    for entity in lake.entities("bronze"):
        known = lake.bronze_schema(entity)
        bronze = stream_table(lake.spark, lake.table("bronze", entity), evolving=True, schema=known)
        cleaned, rules = clean_entity(lake.spark, entity, bronze, lake.lookup("region_mapper")), EXPECTATIONS[entity]
        target, checkpoint = lake.table("silver", entity), lake.checkpoint(f"silver-{entity}")
        if entity in RETRACTING:
            run_upserts(cleaned, target, checkpoint, RETRACTING[entity])
            continue
        with metrics.observing(lake.spark, rules, numbers, entity) as store:
            observed = observe_expectations(cleaned, rules, metrics.OBSERVED)
            store(run_split(observed, entity, rules, QUARANTINE[entity], target, checkpoint))
    now = [
        expectation_metrics(lake.present(e), EXPECTATIONS[e]).select(F.lit(e).alias("entity"), "*") for e in lake.retracting()
    ]
    if now:
        write_overwrite(union_all(now), lake.table("silver", "expectation_metrics_current"))


def log_issues(lake: Lake) -> None:
    """New quarantined rows into the event log, live statistics per issue, enriched events.

    Events of retracting entities are not appended but stored as they are now, so an event whose row was replaced goes.
    """
    spark = lake.spark
    known = lake.entities("silver")
    bad = {e: lake.stream(e, QUARANTINE_TABLE) for e in known if e not in RETRACTING}
    log_path = lake.table("silver", "quality_issues_log")
    if bad:
        run_append(dq_log.quality_log(bad), log_path, lake.checkpoint("quality-log"))
    if lake.retracting():
        events = dq_log.quality_log({e: lake.quarantine(e) for e in lake.retracting()})
        write_overwrite(events, lake.table("silver", "quality_issues_log_current"))

    counts_path = lake.table("silver", "silver_entity_counts")
    write_overwrite(dq_log.entity_counts({e: lake.silver(e) for e in known}), counts_path)

    # Only counters live in the stream: totals and statuses change with clean rows too, so they are joined on reading.
    bridge, catalogue = lake.lookup("dq_rule_mapping"), lake.lookup("dq_issue_catalogue")
    if bad:
        counters = dq_log.issue_counters(stream_table(spark, log_path), bridge)
        run_complete(counters, lake.table("silver", "live_issue_counters"), lake.checkpoint("issue-counters"))
        enriched = dq_log.enrich_issues(stream_table(spark, log_path), bridge, lake.stats(), catalogue)
        run_append(enriched, lake.table("silver", "dq_issues"), lake.checkpoint("dq-issues"))
    if lake.retracting():
        events = read_table(spark, lake.table("silver", "quality_issues_log_current"))
        enriched = dq_log.enrich_issues(events, bridge, lake.stats(), catalogue)
        write_overwrite(enriched, lake.table("silver", "dq_issues_current"))


def build_gold(lake: Lake) -> None:
    """New clean rows into dimensions and facts, as far as their feeds have come.

    A dimension over a retracting entity is replaced by what holds now.
    """

    def owners() -> DataFrame:
        if lake.has("silver", "policy"):
            return lake.silver("policy")
        return lake.spark.createDataFrame([], "policy_number bigint, customer_id bigint")

    tables: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
        "dim_customer": ("customers", star.dim_customer),
        "dim_car": ("cars", star.dim_car),
        "dim_policy": ("policy", star.dim_policy),
        "fact_claims": ("claims", lambda claims: star.fact_claims(claims, owners())),
        "fact_sales": ("sales", star.fact_sales),
    }
    for name, (entity, build) in tables.items():
        if entity in RETRACTING and lake.has("silver", entity):
            write_overwrite(build(lake.silver(entity)), lake.table("gold", name))
        elif lake.has("silver", entity):
            run_append(build(lake.stream(entity, CLEAN)), lake.table("gold", name), lake.checkpoint(name))


def refresh_reports(lake: Lake, as_of: str) -> None:
    """Views and claim risk report, recomputed as a whole where their tables exist."""

    def bronze_customers(spark: SparkSession) -> DataFrame:
        return entities.unify_customers(lake.read("bronze", "customers"), lake.lookup("region_mapper"))

    def gold(name: str) -> DataFrame:
        return lake.read("gold", name)

    reports: dict[str, tuple[list[tuple[str, str]], Callable[[SparkSession], DataFrame]]] = {
        "multi_region_customers": ([("bronze", "customers")], lambda s: views.multi_region_customers(bronze_customers(s))),
        "claim_rejection_rate": (
            [("gold", "dim_policy"), ("gold", "fact_claims"), ("gold", "dim_customer")],
            lambda s: views.claim_rejection_rate(gold("dim_policy"), gold("fact_claims"), gold("dim_customer")),
        ),
        "unsold_by_model_region": (
            [("gold", "fact_sales"), ("gold", "dim_car")],
            lambda s: views.unsold_by_model_region(gold("fact_sales"), gold("dim_car")),
        ),
        "aging_buckets": ([("gold", "fact_sales")], lambda s: views.aging_buckets(gold("fact_sales"), as_of)),
        "claim_anomaly_explanations": (
            [("silver", "claims")],
            lambda s: anomaly.anomaly_report(anomaly.score_claims(lake.silver("claims"))),
        ),
    }
    for name, (sources, build) in reports.items():
        if all(lake.has(*source) for source in sources):
            refresh_view(lake.spark, lake.table("gold", name), build)


def explain_all(lake: Lake, make_function: MakeFunction, model_name: str, partitions: int = 8) -> None:
    """Generated texts: one explanation per issue, one summary per business domain."""
    issues = explain.dq_explanations(lake.read("silver", "dq_issues"), make_function, model_name, partitions)
    write_overwrite(issues, lake.table("gold", "dq_explanation_report"))
    domains = {
        "policy": kpi.policy_kpis(lake.read("gold", "dim_policy")),
        "claims": kpi.claims_kpis(lake.read("gold", "fact_claims")),
        "customer": kpi.customer_kpis(lake.read("gold", "dim_customer")),
    }
    summaries = kpi.domain_summaries(domains, make_function, model_name, partitions)
    write_overwrite(summaries, lake.table("gold", "ai_business_insights"))


def run_all(lake: Lake, raw: str, as_of: str) -> None:
    ingest_bronze(lake, raw)
    build_silver(lake)
    log_issues(lake)
    build_gold(lake)
    refresh_reports(lake, as_of)
