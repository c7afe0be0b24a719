"""Issue bookkeeping: event log, denominators, live statistics per issue, enriched events."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.cleaning import safe_pct
from medallion.operators.dedupe import streaming_exact_distinct
from medallion.operators.joins import union_all
from medallion.plans.rulebook import RECORD_ID, RULE_BRIDGE
from medallion.sources.lookups import seed_rows

BRIDGE_SCHEMA = T.StructType([T.StructField(n, T.StringType(), False) for n in ("entity", "_dq_rule", "issue_id")])

# Statuses set by a person that a run must never clear.
STICKY_STATUS = ("UNRESOLVABLE", "PARTIAL", "FLAGGED")


def rule_bridge(spark: SparkSession) -> DataFrame:
    return seed_rows(spark, RULE_BRIDGE, BRIDGE_SCHEMA)


def quality_log(quarantines: Mapping[str, DataFrame], ids: Mapping[str, str] = RECORD_ID) -> DataFrame:
    """All quarantined rows as events of one shape; the id becomes text."""
    return union_all(
        [
            df.select(
                F.lit(entity).alias("entity"),
                "_dq_rule",
                F.col(ids[entity]).cast("string").alias("record_id"),
                "source_file",
                "_dq_detected_at",
            )
            for entity, df in quarantines.items()
        ]
    )


def entity_counts(clean: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every clean table."""
    return union_all(
        [df.agg(F.count("*").alias("total_rows")).select(F.lit(e).alias("entity"), "total_rows") for e, df in clean.items()]
    )


def resolve_issue(events: DataFrame, bridge: DataFrame) -> DataFrame:
    """Attach the issue id of (entity, rule); unknown rules go to ``UNMAPPED-<entity>``.

    The bridge holds one row per rule written in the rule book, hence the broadcast: a shuffle on
    these few keys would put the events of a frequent rule into one task.
    """
    rules = bridge.select(
        F.col("entity").alias("_rule_entity"), F.col("_dq_rule").alias("_rule"), F.col("issue_id").alias("_issue")
    )
    same = (F.col("entity") == F.col("_rule_entity")) & (F.col("_dq_rule") == F.col("_rule"))
    return (
        events.join(F.broadcast(rules), same, "left")
        .withColumn("issue_id", F.coalesce("_issue", F.concat(F.lit("UNMAPPED-"), F.col("entity"))))
        .drop("_rule_entity", "_rule", "_issue")
    )


def recompute_status(baseline: Column, affected: Column) -> Column:
    """Sticky statuses stay; otherwise nothing affected means resolved."""
    return F.when((affected == 0) & ~F.coalesce(baseline.isin(*STICKY_STATUS), F.lit(False)), "RESOLVED").otherwise(
        baseline
    )


def issue_counters(log: DataFrame, bridge: DataFrame) -> DataFrame:
    """Per issue: distinct affected records and last detection.

    On a stream run it in complete mode: the counters cover all history and no state expires.
    """
    events = resolve_issue(log, bridge)
    group = ["issue_id", "entity"]
    last = F.max("_dq_detected_at").alias("last_detected_at")
    if log.isStreaming:
        return streaming_exact_distinct(events, group, "record_id", "affected_records", last)
    return events.groupBy(*group).agg(F.count_distinct("record_id").alias("affected_records"), last)


def with_totals(counted: DataFrame, counts: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Counters with the share of clean rows and the status that follow from the present row counts."""
    totals = counts.select(F.col("entity").alias("_of"), F.col("total_rows").alias("silver_total_rows"))
    baseline = catalogue.select(F.col("issue_id").alias("_known"), F.col("fix_status").alias("_baseline"))
    return (
        counted.join(totals, F.col("entity") == F.col("_of"), "left")
        .join(baseline, F.col("issue_id") == F.col("_known"), "left")
        .select(
            "issue_id",
            "entity",
            "affected_records",
            safe_pct("affected_records", "silver_total_rows").alias("affected_pct"),
            recompute_status(F.col("_baseline"), F.col("affected_records")).alias("fix_status"),
            "last_detected_at",
            "silver_total_rows",
        )
    )


def issue_stats(log: DataFrame, bridge: DataFrame, counts: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Per issue: distinct affected records, share of clean rows, status, last detection."""
    return with_totals(issue_counters(log, bridge), counts, catalogue)


def describe_issues(stats: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per issue with live numbers and the analyst's notes."""
    notes = catalogue.select(
        F.col("issue_id").alias("_known"),
        "column_name",
        "issue_type",
        "issue_description",
        "silver_fix_applied",
        "prevention_note",
        "severity",
    )
    return stats.join(notes, F.col("issue_id") == F.col("_known"), "left").drop("_known")


def enrich_issues(log: DataFrame, bridge: DataFrame, stats: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Every event with the live numbers and notes of its issue.

    Numbers and notes are joined to each other first, at one row per issue, so the event side meets
    a single small frame: at most one row per rule-book issue plus one UNMAPPED row per entity.
    """
    issues = describe_issues(stats, catalogue).drop("entity", "last_detected_at")
    issues = issues.withColumnRenamed("issue_id", "_id")
    events = resolve_issue(log, bridge)
    return events.join(F.broadcast(issues), F.col("issue_id") == F.col("_id"), "left").select(
        "issue_id",
        "entity",
        "_dq_rule",
        "column_name",
        "issue_type",
        "issue_description",
        "severity",
        "affected_records",
        "affected_pct",
        "silver_total_rows",
        "fix_status",
        "silver_fix_applied",
        "prevention_note",
        "record_id",
        "source_file",
        "_dq_detected_at",
        F.concat_ws("", F.lit("silver_"), F.col("entity")).alias("_dq_table"),
    )
