"""Business KPIs per domain and their generated summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.text import parse_text_blocks, render, row_json
from medallion.operators.aggregates import kpis
from medallion.operators.enrich import SUCCESS, MakeFunction, enrich_rows
from medallion.operators.joins import union_all

SUMMARY_PROMPT = """You are a business analyst at an insurer and write for its executives.

Domain: {domain}
KPIs: {kpi_data}

Summarise in a few sentences: the key insight, whether the figures look healthy, risks or opportunities,
and one recommended action."""


def policy_kpis(policy: DataFrame) -> DataFrame:
    premium = F.col("policy_annual_premium")
    return kpis(
        policy,
        {
            "total_policies": F.count("*"),
            "avg_premium": F.avg(premium),
            "total_premium": F.sum(premium),
            "policy_types": F.count_distinct("policy_state"),
        },
    )


def claims_kpis(claims: DataFrame) -> DataFrame:
    amount = F.col("vehicle") + F.col("property") + F.col("injury")
    return kpis(
        claims,
        {
            "total_claims": F.count("*"),
            "avg_claim_amount": F.avg(amount),
            "total_claim_amount": F.sum(amount),
        },
    )


def customer_kpis(customers: DataFrame) -> DataFrame:
    return kpis(customers, {"total_customers": F.count("*"), "geographic_spread": F.count_distinct("state")})


def kpi_json(measures: DataFrame, out: str = "kpi_data") -> DataFrame:
    """The KPI row as one JSON object, decimals written as doubles."""
    plain = measures.select(
        *[
            F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in measures.schema.fields
        ]
    )
    return plain.select(row_json(*plain.columns).alias(out))


def summary_prompts(domains: Mapping[str, DataFrame]) -> DataFrame:
    """One row per domain: title, KPI JSON, prompt."""
    rows = [kpi_json(measures).select(F.lit(name).alias("domain"), "kpi_data") for name, measures in domains.items()]
    return union_all(rows).select(
        "domain",
        F.concat("domain", F.lit(" Executive Summary")).alias("summary_title"),
        "kpi_data",
        render(SUMMARY_PROMPT).alias("prompt"),
    )


def domain_summaries(
    domains: Mapping[str, DataFrame], make_function: MakeFunction, model_name: str, partitions: int = 8
) -> DataFrame:
    """One generated summary per domain. A failed call leaves its error text and status FAILED."""
    answered = enrich_rows(summary_prompts(domains), make_function, "prompt", model_name, partitions)
    summary = F.when(F.col("generation_status") == SUCCESS, parse_text_blocks("response")).otherwise(F.col("response"))
    return answered.select(
        "domain",
        "summary_title",
        summary.alias("ai_summary"),
        "kpi_data",
        "model_name",
        "generation_status",
        F.current_timestamp().alias("generated_at"),
    )
