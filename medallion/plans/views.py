"""Reporting views over the star schema.

Facts are counted per join key before they meet a dimension: the shuffle then carries one row per
key and map task, whatever share of the fact rows a single key holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.cleaning import bucketize
from medallion.operators.aggregates import inconsistent_keys

AGING_BOUNDS = ((30, "0-30"), (60, "30-60"))
AGING_REST = "60+"


def multi_region_customers(unified: DataFrame) -> DataFrame:
    """Customers seen with more than one region, looked for before duplicates are removed."""
    known = unified.filter(F.col("customer_id").isNotNull())
    return inconsistent_keys(known, "customer_id", "region", "region_count")


def claim_rejection_rate(dim_policy: DataFrame, fact_claims: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Rejected share of claims per customer region and coverage limit."""
    per_policy = fact_claims.groupBy("policy_id").agg(
        F.count("*").alias("_claims"), F.count_if(F.col("claim_rejected") == "Y").alias("_rejected")
    )
    policy = dim_policy.select("policy_number", "policy_csl", F.col("customer_id").alias("_owner"))
    customer = dim_customer.select("customer_id", "region")
    return (
        per_policy.join(policy, F.col("policy_id") == F.col("policy_number"))
        .groupBy("_owner", "policy_csl")
        .agg(F.sum("_claims").alias("_claims"), F.sum("_rejected").alias("_rejected"))
        .join(customer, F.col("_owner") == F.col("customer_id"))
        .groupBy("region", "policy_csl")
        .agg((F.sum("_rejected") / F.sum("_claims")).alias("rejection_rate"))
    )


def unsold_by_model_region(fact_sales: DataFrame, dim_car: DataFrame) -> DataFrame:
    """Listings without a sale per car model and region."""
    per_car = (
        fact_sales.filter(F.col("sold_on").isNull())
        .groupBy(F.col("car_id").alias("_car"), "region")
        .agg(F.count("*").alias("_listings"))
    )
    models = dim_car.select("car_id", "model")
    return (
        per_car.join(models, F.col("_car") == F.col("car_id"))
        .groupBy("model", "region")
        .agg(F.sum("_listings").alias("unsold_count"))
    )


def aging_buckets(fact_sales: DataFrame, as_of: Column | str) -> DataFrame:
    """Unsold listings per region and days since the ad was placed, as of a given day."""
    day = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    age = F.datediff(day, F.col("ad_placed_on"))
    return (
        fact_sales.filter(F.col("sold_on").isNull())
        .groupBy("region", bucketize(age, AGING_BOUNDS, AGING_REST, at_least=False).alias("aging_bucket"))
        .agg(F.count("*").alias("listing_count"))
    )
