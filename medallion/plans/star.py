"""Star schema (gold): three dimensions and two facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.operators.dedupe import dedupe

DIM_CUSTOMER = "customer_id region state city default_flag balance hh_insurance car_loan job".split()
DIM_CAR = (
    "car_id model name km_driven fuel transmission mileage_value mileage_unit engine_cc max_power_bhp torque seats"
).split()
DIM_POLICY = (
    "policy_number policy_bind_date policy_state policy_csl policy_deductable policy_annual_premium umbrella_limit "
    "car_id customer_id"
).split()
FACT_SALES = (
    "sales_id ad_placed_on car_id owner sold_on original_selling_price region state city seller_type"
).split()
CLAIM_DETAILS = (
    "claim_rejected incident_city authorities_contacted bodily_injuries incident_location incident_severity "
    "incident_state incident_type injury number_of_vehicles_involved police_report_available property "
    "property_damage vehicle witnesses"
).split()
INGESTED = "ingestion_timestamp"


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("md_created_datetime", F.current_timestamp())


def _dimension(silver: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per first column; ties between duplicates go to the smallest row."""
    return _stamped(dedupe(silver.select(*columns, INGESTED), columns[:1], [*columns[1:], INGESTED]))


def dim_customer(silver: DataFrame) -> DataFrame:
    return _dimension(silver, DIM_CUSTOMER)


def dim_car(silver: DataFrame) -> DataFrame:
    return _dimension(silver, DIM_CAR)


def dim_policy(silver: DataFrame) -> DataFrame:
    return _dimension(silver, DIM_POLICY)


def fact_claims(claims: DataFrame, policy: DataFrame) -> DataFrame:
    """Claim grain; the customer comes from the policy and stays NULL for an unknown policy.

    ``claims`` may be a stream, ``policy`` is static. Both sides are narrowed before the join. A policy that was
    delivered several times counts once, with its smallest customer id, so a claim never becomes two facts. The claims are
    not sorted for the join: each task holds its share of the policies in a hash table, a row per policy however many claims.
    """
    owner = policy.groupBy(F.col("policy_number").alias("_policy")).agg(F.min("customer_id").alias("customer_id"))
    return _stamped(
        claims.join(owner.hint("shuffle_hash"), F.col("policy_id") == F.col("_policy"), "left").select(
            "claim_id", "customer_id", "policy_id", *CLAIM_DETAILS, INGESTED
        )
    )


def fact_sales(silver: DataFrame) -> DataFrame:
    return _stamped(silver.select(*FACT_SALES, INGESTED))
