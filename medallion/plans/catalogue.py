"""The analyst's catalogue of known data issues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sources.lookups import seed_rows

ISSUE_SCHEMA = T.StructType(
    [
        T.StructField("issue_id", T.StringType(), False),
        T.StructField("entity", T.StringType(), False),
        T.StructField("column_name", T.StringType()),
        T.StructField("issue_type", T.StringType(), False),
        T.StructField("issue_description", T.StringType(), False),
        T.StructField("silver_fix_applied", T.StringType(), False),
        T.StructField("fix_status", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("affected_records", T.LongType()),
        T.StructField("affected_pct", T.DoubleType()),
        T.StructField("prevention_note", T.StringType()),
    ]
)

# Ids, columns, types, statuses, severities and the counts first found by analysts.
ISSUE_ROWS = (
    ("DQ-CUST-001", "customers", "CustomerID", "DUPLICATE",
     "The same customer arrives in several files because a full extract was loaded next to the partial ones.",
     "One row per customer_id is kept.",
     "RESOLVED", "CRITICAL", 1602, 44.4,
     "Check which extracts overlap before loading them."),
    ("DQ-CUST-002", "customers", "CustomerID, Customer_ID, cust_id", "SCHEMA_VARIANT",
     "The customer key has three different header spellings, depending on the file.",
     "The first readable of the three columns becomes customer_id (64-bit).",
     "RESOLVED", "HIGH", 399, 11.1,
     "Agree on a single header for the customer key."),
    ("DQ-CUST-003", "customers", "Region", "NORMALISATION",
     "One file writes regions as single letters, the others write full names.",
     "Letters are expanded through the region lookup table.",
     "RESOLVED", "MEDIUM", 200, 5.5,
     "Export full region names and check them against the allowed list."),
    ("DQ-CUST-004", "customers", "Reg, Region", "SCHEMA_VARIANT",
     "The region sits under two header names; some files fill both, some only one.",
     "The first usable of the two is taken and mapped to its canonical name.",
     "RESOLVED", "MEDIUM", 3605, 100.0,
     "Use the header region everywhere."),
    ("DQ-CUST-005", "customers", "Education, Edu", "MISSING_DATA",
     "One file delivers no education under either header.",
     "Left NULL and quarantined as education_missing.",
     "FLAGGED", "HIGH", 1005, 27.9,
     "Ask for education when a customer is registered."),
    ("DQ-CUST-006", "customers", "Education, Marital_status", "SCHEMA_VARIANT",
     "One file uses its own headers, in swapped order, for education and marital status.",
     "Values are matched by header and the alternate headers take precedence.",
     "RESOLVED", "HIGH", 200, 5.5,
     "Fix the column order of the export template and validate headers on arrival."),
    ("DQ-CUST-007", "customers", "Marital_status, Marital", "SCHEMA_VARIANT",
     "Marital status sits under two header names.",
     "The first usable of Marital and Marital_status becomes marital_status.",
     "RESOLVED", "MEDIUM", 200, 5.5,
     "Use the header marital_status everywhere."),
    ("DQ-CUST-008", "customers", "City, City_in_state", "SCHEMA_VARIANT",
     "One file calls the city column City_in_state.",
     "The first usable of both columns becomes city.",
     "RESOLVED", "LOW", 200, 5.5,
     "Use the header city everywhere."),
    ("DQ-CUST-009", "customers", "region", "COVERAGE_GAP",
     "No customer belongs to the North region: either a gap in the business or a feed that is missing.",
     "Nothing is changed; the gap is documented.",
     "FLAGGED", "LOW", 0, 0.0,
     "Ask the business whether a North feed should exist."),
    ("DQ-CUST-010", "customers", "CustomerID", "NULL_VALUE",
     "The main key column is empty where the key came under another header.",
     "The alternate key columns fill the gap; all keys could be recovered.",
     "RESOLVED", "CRITICAL", 399, 11.1,
     "Never export a row without its key."),
    ("DQ-CUST-011", "customers", "source_file", "DUPLICATE",
     "The seventh file is a snapshot that repeats customers of earlier files.",
     "The row of the first file in name order is kept.",
     "RESOLVED", "CRITICAL", 1602, 44.4,
     "Do not mix snapshots with incremental files."),
    ("DQ-CARS-001", "cars", "mileage", "FORMAT_ISSUE",
     "Mileage is text made of a number and one of two units.",
     "Number and unit are stored in two columns; the number is decimal(6,2).",
     "RESOLVED", "HIGH", 2500, 100.0,
     "Export number and unit separately."),
    ("DQ-CARS-002", "cars", "engine", "FORMAT_ISSUE",
     "Engine size is text that ends in CC.",
     "The number is stored as integer engine_cc.",
     "RESOLVED", "HIGH", 2500, 100.0,
     "Store engine size as an integer."),
    ("DQ-CARS-003", "cars", "max_power", "FORMAT_ISSUE",
     "Power is text that ends in bhp.",
     "The number is stored as max_power_bhp, decimal(7,2).",
     "RESOLVED", "HIGH", 2500, 100.0,
     "Store power as a number and name the unit in the header."),
    ("DQ-CARS-004", "cars", "torque", "FORMAT_ISSUE",
     "Torque comes in four notations with two units and mixed case.",
     "Only trimmed; the notations are left for later parsing.",
     "PARTIAL", "MEDIUM", 2500, 100.0,
     "Agree on one notation and one unit."),
    ("DQ-CARS-005", "cars", "km_driven", "OUTLIER",
     "A car reports 1,500,000 km, far beyond all others; a typing error is likely.",
     "Kept with a flag and quarantined as km_driven_extreme_outlier.",
     "FLAGGED", "HIGH", 1, 0.04,
     "Have readings above 500,000 km reviewed before export."),
    ("DQ-CARS-006", "cars", "seats", "OUTLIER",
     "A few cars report ten seats, outside the passenger-car range 2 to 9.",
     "Quarantined as seats_out_of_range until reviewed.",
     "FLAGGED", "LOW", 4, 0.16,
     "Define the allowed seat range at the source."),
    ("DQ-CARS-007", "cars", "fuel", "NORMALISATION",
     "Fuel names come in mixed case.",
     "Trimmed and upper-cased.",
     "RESOLVED", "LOW", 2500, 100.0,
     "Use a fixed upper-case vocabulary."),
    ("DQ-CARS-008", "cars", "transmission", "NORMALISATION",
     "Transmission names come in mixed case.",
     "Trimmed and upper-cased.",
     "RESOLVED", "LOW", 2500, 100.0,
     "Use a fixed upper-case vocabulary."),
    ("DQ-CLMS-001", "claims", "incident_date", "CORRUPT_DATA",
     "Incident dates were reduced to minutes and seconds by an export and cannot be restored.",
     "Raw text kept, date NULL, flag set, row quarantined.",
     "UNRESOLVABLE", "CRITICAL", 1000, 100.0,
     "Repair the export and deliver the dates again as yyyy-MM-dd."),
    ("DQ-CLMS-002", "claims", "Claim_Logged_On", "CORRUPT_DATA",
     "Logging dates were reduced to minutes and seconds; a few are empty.",
     "Raw text kept, date NULL, flag set, row quarantined.",
     "UNRESOLVABLE", "CRITICAL", 989, 98.9,
     "Repair the export and deliver full timestamps."),
    ("DQ-CLMS-003", "claims", "Claim_Processed_On", "NULL_VALUE",
     "Rejected claims carry the word NULL as processing date.",
     "The word becomes a real NULL and is flagged.",
     "RESOLVED", "HIGH", 526, 52.6,
     "Leave the field empty for rejected claims."),
    ("DQ-CLMS-004", "claims", "Claim_Processed_On", "CORRUPT_DATA",
     "Processing dates of approved claims were reduced to minutes and seconds.",
     "Raw text kept, date NULL, flag set.",
     "UNRESOLVABLE", "CRITICAL", 474, 47.4,
     "Repair the export, as for the other claim dates."),
    ("DQ-CLMS-005", "claims", "police_report_available", "MISSING_DATA",
     "A question mark stands for an unknown police report.",
     "Becomes NULL and is quarantined.",
     "RESOLVED", "HIGH", 343, 34.3,
     "Make the field mandatory at intake."),
    ("DQ-CLMS-006", "claims", "property_damage", "MISSING_DATA",
     "A question mark stands for unknown property damage.",
     "Becomes NULL and is quarantined.",
     "RESOLVED", "HIGH", 360, 36.0,
     "Make the field mandatory, with a choice for unknown."),
    ("DQ-CLMS-007", "claims", "collision_type", "MISSING_DATA",
     "A question mark stands for an unknown collision type.",
     "Becomes NULL and is quarantined.",
     "RESOLVED", "MEDIUM", 178, 17.8,
     "Offer a fixed choice of collision types at intake."),
    ("DQ-CLMS-008", "claims", "vehicle", "NULL_VALUE",
     "Some vehicle amounts hold the word NULL.",
     "The word becomes a real NULL.",
     "RESOLVED", "MEDIUM", 29, 2.9,
     "Leave missing amounts empty."),
    ("DQ-CLMS-009", "claims", "injury", "OUTLIER",
     "One injury amount of 100,000 is many times the average and well above the next highest.",
     "Kept with a flag and quarantined as injury_extreme_outlier.",
     "FLAGGED", "MEDIUM", 1, 0.1,
     "Have amounts far above the mean reviewed at intake."),
    ("DQ-CLMS-010", "claims", "injury, property, vehicle", "TYPE_MISMATCH",
     "The three amounts arrive as text.",
     "Converted to decimal(12,2) after missing-value words are removed.",
     "RESOLVED", "HIGH", 1000, 100.0,
     "Declare decimal types when loading."),
    ("DQ-POL-001", "policy", "policy_state", "NORMALISATION",
     "State codes differ in case and surrounding blanks.",
     "Trimmed and upper-cased.",
     "RESOLVED", "LOW", None, None,
     "Enforce trimmed upper-case state codes."),
    ("DQ-POL-002", "policy", "policy_csl", "FORMAT_ISSUE",
     "Some split limits have surrounding blanks.",
     "Trimmed.",
     "RESOLVED", "LOW", None, None,
     "Trim on export and check against the allowed codes."),
    ("DQ-POL-003", "policy", "policy_number, car_id, customer_id, umbrella_limit", "TYPE_MISMATCH",
     "Ids and limits were inferred as 32-bit integers and may overflow.",
     "Converted to 64-bit integers.",
     "RESOLVED", "MEDIUM", 1000, 100.0,
     "Declare 64-bit types when loading."),
    ("DQ-POL-004", "policy", "policy_annual_premium", "TYPE_MISMATCH",
     "Premiums were inferred as floating point.",
     "Converted to decimal(10,2).",
     "RESOLVED", "MEDIUM", 1000, 100.0,
     "Declare decimal types for money."),
    ("DQ-SALE-001", "sales", "sales_id", "CORRUPT_DATA",
     "The files contain rows in which every column is empty.",
     "Rows without sales_id are removed before anything else.",
     "RESOLVED", "CRITICAL", 1878, 60.5,
     "Check row counts and the key on arrival."),
    ("DQ-SALE-002", "sales", "ad_placed_on, sold_on", "FORMAT_ISSUE",
     "Dates are written day first, which invites swaps of day and month.",
     "Parsed with the explicit format dd-MM-yyyy HH:mm.",
     "RESOLVED", "HIGH", 1225, 100.0,
     "Export ISO timestamps."),
    ("DQ-SALE-003", "sales", "sold_on", "MISSING_DATA",
     "Some listings have no sale date because they are still unsold.",
     "Kept as NULL on purpose.",
     "RESOLVED", "LOW", 116, 9.5,
     "Nothing to fix; consumers must expect NULL."),
    ("DQ-SALE-004", "sales", "Region, State, City", "NORMALISATION",
     "Three headers are capitalised unlike those of the other feeds.",
     "Renamed to lower case.",
     "RESOLVED", "LOW", 1225, 100.0,
     "Use lower-case headers."),
    ("DQ-SALE-005", "sales", "sales_id, car_id, original_selling_price", "TYPE_MISMATCH",
     "Ids were inferred as 32-bit integers and prices as whole numbers.",
     "Ids become 64-bit integers and prices decimal(15,2).",
     "RESOLVED", "MEDIUM", 1225, 100.0,
     "Declare 64-bit and decimal types when loading."),
)


def issue_catalogue(spark: SparkSession) -> DataFrame:
    return seed_rows(spark, ISSUE_ROWS, ISSUE_SCHEMA).withColumn("md_created_datetime", F.current_timestamp())
