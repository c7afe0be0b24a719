"""Cleaning plans: raw (bronze-shaped) frame in, typed and unified frame out, for each entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.cleaning import (
    coalesce_ids,
    coalesce_variants,
    extract_number,
    extract_unit,
    is_sentinel,
    matches_corrupt,
    norm_trim,
    norm_upper,
    normalise_enum,
    null_if_sentinel,
    outlier_flag,
    safe_cast,
    safe_date,
    safe_timestamp,
    violates_order,
)
from medallion.operators.dedupe import dedupe, dedupe_first_stream
from medallion.operators.joins import lookup_expand
from medallion.plans.rulebook import INJURY_LIMIT, KM_LIMIT

PROVENANCE = ("source_file", "ingestion_timestamp")
LISTING_TIME = "dd-MM-yyyy HH:mm"

CUSTOMER_COLUMNS = (
    "customer_id region state city marital_status education default_flag balance hh_insurance car_loan job"
).split()
SALES_COLUMNS = (
    "sales_id ad_placed_on sold_on original_selling_price region state city seller_type owner car_id "
    "sold_before_listed"
).split()


def conform(df: DataFrame, spec: dict[str, Column | str], carry: Sequence[str] = PROVENANCE) -> DataFrame:
    """Pin the schema: exactly these columns in this order, then whatever provenance is present."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in spec.items()],
        *_present(df, *carry),
    )


def _present(df: DataFrame, *names: str) -> list[str]:
    """Those header variants that some file of this feed has brought in."""
    known = {c.lower() for c in df.columns}
    return [n for n in names if n.lower() in known]


def unify_customers(bronze: DataFrame, region_mapper: DataFrame) -> DataFrame:
    """Customers with header variants merged and regions expanded, before duplicates are removed."""

    def variants(*names: str) -> Column:
        return coalesce_variants(*_present(bronze, *names))

    unified = conform(
        bronze,
        {
            "customer_id": coalesce_ids(*_present(bronze, "CustomerID", "Customer_ID", "cust_id")),
            "region": variants("Reg", "Region"),
            "state": null_if_sentinel("State"),
            "city": variants("City", "City_in_state"),
            "marital_status": variants("Marital", "Marital_status"),
            "education": variants("Edu", "Education"),
            "default_flag": safe_cast(variants("Default", "DefaultFlag"), "int"),
            "balance": safe_cast("Balance", "decimal(14,2)"),
            "hh_insurance": safe_cast("HHInsurance", "int"),
            "car_loan": safe_cast("CarLoan", "int"),
            "job": null_if_sentinel("Job"),
        },
    )
    expanded = lookup_expand(unified, region_mapper, "region", "reg_coded", "reg_mapped", "region")
    return expanded.select(*unified.columns)


def clean_customers(bronze: DataFrame, region_mapper: DataFrame) -> DataFrame:
    """One row per customer: the one from the first source file (first seen, on a stream)."""
    order = ["source_file", *CUSTOMER_COLUMNS[1:]]
    return dedupe(unify_customers(bronze, region_mapper), ["customer_id"], order)


def first_customers(bronze: DataFrame, region_mapper: DataFrame) -> DataFrame:
    """On a stream in complete mode, the customers that ``clean_customers`` keeps in batch."""
    order = ["source_file", *CUSTOMER_COLUMNS[1:]]
    return dedupe_first_stream(unify_customers(bronze, region_mapper), ["customer_id"], order)


def clean_cars(bronze: DataFrame) -> DataFrame:
    km = safe_cast("km_driven", "bigint")
    return conform(
        bronze,
        {
            "car_id": safe_cast("car_id", "bigint"),
            "name": norm_trim("name"),
            "model": norm_trim("model"),
            "km_driven": km,
            "km_driven_extreme": outlier_flag(km, KM_LIMIT),
            "fuel": norm_upper("fuel"),
            "transmission": norm_upper("transmission"),
            "mileage_value": extract_number("mileage", "decimal(6,2)"),
            "mileage_unit": extract_unit("mileage", ["km/kg", "kmpl"]),
            "engine_cc": extract_number("engine", "int", "([0-9]+)"),
            "max_power_bhp": extract_number("max_power", "decimal(7,2)"),
            "torque": norm_trim("torque"),
            "seats": safe_cast("seats", "int"),
        },
    )


def clean_claims(bronze: DataFrame) -> DataFrame:
    """Claims with typed amounts. Raw date texts stay beside the parsed dates for audit.

    A date that the export corrupted or left out is NULL; only ISO days are read.
    """
    raw = (
        bronze.withColumnRenamed("Claim_Logged_On", "_raw_logged_on")
        .withColumnRenamed("Claim_Processed_On", "_raw_processed_on")
        .withColumnRenamed("incident_date", "_raw_incident_date")
    )
    injury = safe_cast("injury", "decimal(12,2)")
    no_processing_date = is_sentinel("_raw_processed_on")
    return conform(
        raw,
        {
            "claim_id": safe_cast("ClaimID", "bigint"),
            "claim_logged_on": safe_date("_raw_logged_on").cast("timestamp"),
            "_raw_logged_on": "_raw_logged_on",
            "claim_logged_on_corrupted": matches_corrupt("_raw_logged_on"),
            "claim_processed_on": safe_date("_raw_processed_on").cast("timestamp"),
            "_raw_processed_on": "_raw_processed_on",
            "claim_processed_on_null_string": no_processing_date,
            "claim_processed_on_corrupted": ~no_processing_date & matches_corrupt("_raw_processed_on"),
            "claim_rejected": normalise_enum("Claim_Rejected", ["Y", "N"]),
            "policy_id": safe_cast("PolicyID", "bigint"),
            "authorities_contacted": "authorities_contacted",
            "bodily_injuries": safe_cast("bodily_injuries", "int"),
            "collision_type": null_if_sentinel("collision_type"),
            "incident_city": "incident_city",
            "incident_date": safe_date("_raw_incident_date"),
            "_raw_incident_date": "_raw_incident_date",
            "incident_date_corrupted": matches_corrupt("_raw_incident_date"),
            "incident_location": "incident_location",
            "incident_severity": "incident_severity",
            "incident_state": "incident_state",
            "incident_type": "incident_type",
            "injury": injury,
            "injury_extreme_outlier": outlier_flag(injury, INJURY_LIMIT, null_is=False),
            "number_of_vehicles_involved": safe_cast("number_of_vehicles_involved", "int"),
            "police_report_available": null_if_sentinel("police_report_available"),
            "property": safe_cast("property", "decimal(12,2)"),
            "property_damage": null_if_sentinel("property_damage"),
            "vehicle": safe_cast("vehicle", "decimal(12,2)"),
            "witnesses": safe_cast("witnesses", "int"),
        },
    )


def clean_policy(bronze: DataFrame) -> DataFrame:
    return conform(
        bronze,
        {
            "policy_number": safe_cast("policy_number", "bigint"),
            "policy_bind_date": safe_date("policy_bind_date"),
            "policy_state": norm_upper("policy_state"),
            "policy_csl": norm_trim("policy_csl"),
            "policy_deductable": safe_cast("policy_deductable", "int"),
            "policy_annual_premium": safe_cast("policy_annual_premium", "decimal(10,2)"),
            "umbrella_limit": safe_cast("umbrella_limit", "bigint"),
            "car_id": safe_cast("car_id", "bigint"),
            "customer_id": safe_cast("customer_id", "bigint"),
        },
    )


def drop_ghost_rows(df: DataFrame, key: str) -> DataFrame:
    """Remove rows that a broken export filled with nothing but NULL."""
    return df.filter(F.col(key).isNotNull())


def parse_sales(bronze: DataFrame) -> DataFrame:
    """Typed listings before region expansion; this is what the quarantine rules look at."""
    listed = safe_timestamp("ad_placed_on", LISTING_TIME, sentinels=())
    sold = safe_timestamp("sold_on", LISTING_TIME)
    return conform(
        drop_ghost_rows(bronze, "sales_id"),
        {
            "sales_id": safe_cast("sales_id", "bigint"),
            "ad_placed_on": listed,
            "sold_on": sold,
            "sold_before_listed": violates_order(listed, sold),
            "original_selling_price": safe_cast("original_selling_price", "decimal(15,2)"),
            "region_raw": norm_upper("Region"),
            "state": "State",
            "city": "City",
            "seller_type": null_if_sentinel("seller_type"),
            "owner": null_if_sentinel("owner"),
            "car_id": safe_cast("car_id", "bigint"),
        },
    )


def expand_sales_region(parsed: DataFrame, region_mapper: DataFrame) -> DataFrame:
    expanded = lookup_expand(parsed, region_mapper, "region_raw", "reg_coded", "reg_mapped", "region")
    return expanded.select(*SALES_COLUMNS, *_present(parsed, *PROVENANCE))


def clean_sales(bronze: DataFrame, region_mapper: DataFrame) -> DataFrame:
    return expand_sales_region(parse_sales(bronze), region_mapper)
