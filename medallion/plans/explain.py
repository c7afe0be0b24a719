"""Plain-language explanations of data issues through a plugged-in text generator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.text import parse_text_blocks, render
from medallion.operators.enrich import SUCCESS, MakeFunction, enrich_rows

ISSUE_COLUMNS = ("issue_id", "entity", "column_name", "issue_type", "severity", "affected_records", "issue_description")
ISSUE_PROMPT = """Explain the following data quality issue to a business reader.

Table: {entity}
Column: {column_name}
Rule: {issue_type}
Severity: {severity}
Affected records: {affected_records}
Description: {issue_description}

Cover in this order: what was found, why it matters, what caused it, how to fix it, how to prevent it."""


def one_row_per_issue(issues: DataFrame) -> DataFrame:
    """Event rows reduced to their issues, so that each issue is explained once.

    Events of different runs carry the count of their time; counts only grow, so the largest is current.
    """
    facts = F.struct("affected_records", *[c for c in ISSUE_COLUMNS if c not in ("issue_id", "affected_records")])
    return issues.groupBy("issue_id").agg(F.max(facts).alias("_facts")).select("issue_id", "_facts.*")


def dq_prompts(issues: DataFrame) -> DataFrame:
    return one_row_per_issue(issues).withColumn("prompt", render(ISSUE_PROMPT))


def dq_explanations(
    issues: DataFrame, make_function: MakeFunction, model_name: str, partitions: int = 8
) -> DataFrame:
    """One explanation per issue, with the status of its generation."""
    answered = enrich_rows(dq_prompts(issues), make_function, "prompt", model_name, partitions)
    text = F.when(F.col("generation_status") == SUCCESS, parse_text_blocks("response")).otherwise(F.col("response"))
    return answered.select(
        "issue_id",
        F.col("entity").alias("table_name"),
        "column_name",
        "severity",
        "affected_records",
        text.alias("ai_explanation"),
        "model_name",
        "generation_status",
        F.current_timestamp().alias("generated_at"),
    )
