"""Quality rules of the five entities.

Fixed values: rule names, thresholds, value lists, issue ids and their order are a contract with
every consumer of the issue log. A quarantined row carries the first rule that is TRUE, and a
predicate over a NULL is not TRUE, so "only if known" needs no extra test.
"""

from __future__ import annotations

from medallion.operators.quality import DROP, Expectation, QuarantineRule

ENTITIES = ("customers", "cars", "claims", "policy", "sales")
RECORD_ID = {
    "customers": "customer_id",
    "cars": "car_id",
    "claims": "claim_id",
    "policy": "policy_number",
    "sales": "sales_id",
}

KM_LIMIT = 500_000
INJURY_LIMIT = 80_000

QUARANTINE = {
    "customers": (
        QuarantineRule("customer_id_not_null", "customer_id IS NULL", "DQ-CUST-010"),
        QuarantineRule("customer_id_non_positive", "customer_id <= 0", "DQ-CUST-010"),
        QuarantineRule("region_invalid", "region NOT IN ('West', 'Central', 'East', 'South', 'North')", "DQ-CUST-003"),
        QuarantineRule("education_missing", "education IS NULL", "DQ-CUST-005"),
        QuarantineRule("marital_status_missing", "marital_status IS NULL", "DQ-CUST-007"),
        QuarantineRule("default_flag_invalid", "default_flag NOT IN (0, 1)", "DQ-CUST-010"),
    ),
    "cars": (
        QuarantineRule("car_id_not_null", "car_id IS NULL", "DQ-CARS-001"),
        QuarantineRule("car_id_non_positive", "car_id <= 0", "DQ-CARS-001"),
        QuarantineRule("km_driven_negative", "km_driven < 0", "DQ-CARS-005"),
        QuarantineRule("km_driven_extreme_outlier", "km_driven_extreme", "DQ-CARS-005"),
        QuarantineRule("engine_cc_non_positive", "engine_cc <= 0", "DQ-CARS-002"),
        QuarantineRule("max_power_non_positive", "max_power_bhp <= 0", "DQ-CARS-003"),
        QuarantineRule("seats_out_of_range", "seats NOT BETWEEN 2 AND 9", "DQ-CARS-006"),
        QuarantineRule(
            "fuel_unknown_type",
            "fuel NOT IN ('PETROL', 'DIESEL', 'CNG', 'LPG', 'ELECTRIC', 'HYBRID')",
            "DQ-CARS-007",
        ),
    ),
    "claims": (
        QuarantineRule("claim_id_not_null", "claim_id IS NULL", "DQ-CLMS-010"),
        QuarantineRule("policy_id_not_null", "policy_id IS NULL", "DQ-CLMS-010"),
        QuarantineRule("claim_logged_on_corrupted", "claim_logged_on_corrupted", "DQ-CLMS-002"),
        QuarantineRule("incident_date_corrupted", "incident_date_corrupted", "DQ-CLMS-001"),
        QuarantineRule("claim_processed_on_corrupted", "claim_processed_on_corrupted", "DQ-CLMS-004"),
        QuarantineRule("injury_extreme_outlier", "injury_extreme_outlier", "DQ-CLMS-009"),
        QuarantineRule("claim_rejected_invalid_value", "claim_rejected NOT IN ('Y', 'N')", "DQ-CLMS-010"),
        QuarantineRule("injury_negative", "injury < 0", "DQ-CLMS-010"),
        QuarantineRule("collision_type_unknown", "collision_type IS NULL", "DQ-CLMS-007"),
        QuarantineRule("police_report_unknown", "police_report_available IS NULL", "DQ-CLMS-005"),
        QuarantineRule("property_damage_unknown", "property_damage IS NULL", "DQ-CLMS-006"),
    ),
    "policy": (
        QuarantineRule("policy_number_not_null", "policy_number IS NULL", "DQ-POL-003"),
        QuarantineRule("customer_id_not_null", "customer_id IS NULL", "DQ-POL-003"),
        QuarantineRule("car_id_not_null", "car_id IS NULL", "DQ-POL-003"),
        QuarantineRule("policy_bind_date_unparseable", "policy_bind_date IS NULL", "DQ-POL-001"),
        QuarantineRule("premium_non_positive", "policy_annual_premium <= 0", "DQ-POL-004"),
        QuarantineRule("deductable_negative", "policy_deductable < 0", "DQ-POL-004"),
    ),
    "sales": (
        QuarantineRule("sales_id_not_null", "sales_id IS NULL", "DQ-SALE-001"),
        QuarantineRule("car_id_not_null", "car_id IS NULL", "DQ-SALE-001"),
        QuarantineRule("ad_placed_on_unparseable", "ad_placed_on IS NULL", "DQ-SALE-002"),
        QuarantineRule("price_non_positive", "original_selling_price <= 0", "DQ-SALE-005"),
        QuarantineRule("sold_before_listed", "sold_before_listed", "DQ-SALE-002"),
    ),
}

EXPECTATIONS = {
    "customers": (
        Expectation("customer_id_not_null", "customer_id IS NOT NULL", DROP),
        Expectation("customer_id_positive", "customer_id > 0", DROP),
        Expectation("region_valid", "region IN ('West', 'Central', 'East', 'South')"),
        Expectation("balance_not_null", "balance IS NOT NULL"),
        Expectation("default_flag_valid", "default_flag IS NULL OR default_flag IN (0, 1)"),
    ),
    "cars": (
        Expectation("car_id_not_null", "car_id IS NOT NULL", DROP),
        Expectation("car_id_positive", "car_id > 0", DROP),
        Expectation("km_driven_non_negative", "km_driven IS NULL OR km_driven >= 0"),
        Expectation("engine_cc_positive", "engine_cc IS NULL OR engine_cc > 0"),
        Expectation("max_power_positive", "max_power_bhp IS NULL OR max_power_bhp > 0"),
        Expectation("mileage_positive", "mileage_value IS NULL OR mileage_value > 0"),
        Expectation("seats_in_range", "seats IS NULL OR seats BETWEEN 2 AND 9"),
        Expectation(
            "fuel_known", "fuel IS NULL OR fuel IN ('PETROL', 'DIESEL', 'CNG', 'LPG', 'ELECTRIC', 'HYBRID')"
        ),
    ),
    "claims": (
        Expectation("claim_id_not_null", "claim_id IS NOT NULL", DROP),
        Expectation("claim_id_positive", "claim_id > 0", DROP),
        Expectation("policy_id_not_null", "policy_id IS NOT NULL", DROP),
        Expectation("dates_corrupted_warn", "NOT incident_date_corrupted"),
        Expectation("injury_non_negative", "injury IS NULL OR injury >= 0"),
        Expectation("vehicle_non_negative", "vehicle IS NULL OR vehicle >= 0"),
        Expectation("property_non_negative", "property IS NULL OR property >= 0"),
        Expectation("claim_rejected_valid", "claim_rejected IS NULL OR claim_rejected IN ('Y', 'N')"),
    ),
    "policy": (
        Expectation("policy_number_not_null", "policy_number IS NOT NULL", DROP),
        Expectation("policy_number_positive", "policy_number > 0", DROP),
        Expectation("customer_id_not_null", "customer_id IS NOT NULL", DROP),
        Expectation("car_id_not_null", "car_id IS NOT NULL", DROP),
        Expectation("policy_bind_date_valid", "policy_bind_date IS NOT NULL"),
        Expectation("premium_positive", "policy_annual_premium > 0"),
        Expectation("deductable_non_negative", "policy_deductable >= 0"),
    ),
    "sales": (
        Expectation("sales_id_not_null", "sales_id IS NOT NULL", DROP),
        Expectation("car_id_not_null", "car_id IS NOT NULL", DROP),
        Expectation("ad_placed_on_valid", "ad_placed_on IS NOT NULL"),
        Expectation("price_positive", "original_selling_price > 0"),
        Expectation("sold_not_before_listed", "NOT sold_before_listed OR sold_on IS NULL"),
    ),
}

# One row per rule that can fire: (entity, rule, issue id).
RULE_BRIDGE = tuple((entity, r.label, r.issue_id) for entity in ENTITIES for r in QUARANTINE[entity])
