"""Reference SQL (DuckDB) for the registered queries, written independently of the library.

A query is a SELECT over named steps; ``_compose`` puts the steps it needs in front as CTEs.
"""

from __future__ import annotations

import re

from medallion.operators.enrich import SUCCESS
from medallion.plans.anomaly import BRIEF, INVESTIGATION_PROMPT
from medallion.plans.catalogue import ISSUE_ROWS
from medallion.plans.explain import ISSUE_PROMPT
from medallion.plans.kpi import SUMMARY_PROMPT
from medallion.plans.rulebook import RULE_BRIDGE
from queries.bronze import BRONZE_SQL
from queries.registry import AS_OF, POLICY_QUESTIONS, STATE_QUESTIONS

# -- small SQL builders ---------------------------------------------------------------------------


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _value(value) -> str:
    return "NULL" if value is None else _text(value) if isinstance(value, str) else str(value)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_value(v) for v in row) + ")" for row in rows)


def _known(column: str) -> str:
    return f"CASE WHEN upper(trim({column})) IN ('NULL','NA','?','NONE','') THEN NULL ELSE {column} END"


def _usable(column: str) -> str:
    return f"CASE WHEN upper(trim({column})) IN ('NULL','NA','') THEN NULL ELSE trim({column}) END"


def _fill(template: str, **slots: str) -> str:
    """Template with {name} slots as a SQL concatenation; NULL prints as None."""
    parts = re.split(r"\{(\w+)\}", template)
    out = [
        _text(p) if i % 2 == 0 else f"coalesce(CAST({slots.get(p, p)} AS VARCHAR), 'None')" for i, p in enumerate(parts)
    ]
    return "(" + " || ".join(out) + ")"


def _stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _json_number(x: str) -> str:
    """A double the way the JVM prints it: scientific from 1e7 on."""
    digits = f"rtrim(replace(CAST({x} AS VARCHAR), '.', ''), '0')"
    exponent = f"(length(split_part(CAST({x} AS VARCHAR), '.', 1)) - 1)"
    rest = f"CASE WHEN length({digits}) > 1 THEN substr({digits}, 2) ELSE '0' END"
    scientific = f"left({digits}, 1) || '.' || {rest} || 'E' || CAST({exponent} AS VARCHAR)"
    return f"CASE WHEN {x} >= 1e7 THEN {scientific} ELSE CAST({x} AS VARCHAR) END"


# -- steps ------------------------------------------------------------------------------------------

STEPS: dict[str, str] = {name: sql.strip() for name, sql in BRONZE_SQL.items()}

STEPS["region_map"] = (
    "SELECT * FROM (VALUES ('W','West'),('C','Central'),('E','East'),('S','South'),('WEST','West'),"
    "('CENTRAL','Central'),('EAST','East'),('SOUTH','South')) t(code, full_name)"
)
STEPS["unified"] = f"""
SELECT coalesce(try_cast(CustomerID AS BIGINT), try_cast(Customer_ID AS BIGINT), try_cast(cust_id AS BIGINT)) AS customer_id,
  coalesce(full_name, raw_region) AS region, {_known("State")} AS state,
  coalesce({_usable("City")}, {_usable("City_in_state")}) AS city,
  coalesce({_usable("Marital")}, {_usable("Marital_status")}) AS marital_status,
  coalesce({_usable("Edu")}, {_usable("Education")}) AS education,
  try_cast(DefaultFlag AS INTEGER) AS default_flag, try_cast(Balance AS DECIMAL(14,2)) AS balance,
  try_cast(HHInsurance AS INTEGER) AS hh_insurance, try_cast(CarLoan AS INTEGER) AS car_loan,
  {_known("Job")} AS job, source_file
FROM (SELECT *, upper(coalesce({_usable("Reg")}, {_usable("b.Region")})) AS raw_region FROM bronze_customers b) x
LEFT JOIN region_map ON raw_region = code"""
STEPS["customers"] = """
SELECT * FROM unified QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY source_file NULLS FIRST,
  region NULLS FIRST, state NULLS FIRST, city NULLS FIRST, marital_status NULLS FIRST, education NULLS FIRST,
  default_flag NULLS FIRST, balance NULLS FIRST, hh_insurance NULLS FIRST, car_loan NULLS FIRST, job NULLS FIRST) = 1"""
STEPS["cars"] = """
SELECT try_cast(car_id AS BIGINT) AS car_id, trim(name) AS name, trim(model) AS model,
  try_cast(km_driven AS BIGINT) AS km_driven, try_cast(km_driven AS BIGINT) > 500000 AS km_driven_extreme,
  upper(trim(fuel)) AS fuel, upper(trim(transmission)) AS transmission,
  try_cast(regexp_extract(mileage, '([0-9.]+)', 1) AS DECIMAL(6,2)) AS mileage_value,
  CASE WHEN contains(mileage, 'km/kg') THEN 'km/kg' WHEN contains(mileage, 'kmpl') THEN 'kmpl' END AS mileage_unit,
  try_cast(regexp_extract(engine, '([0-9]+)', 1) AS INTEGER) AS engine_cc,
  try_cast(regexp_extract(max_power, '([0-9.]+)', 1) AS DECIMAL(7,2)) AS max_power_bhp,
  trim(torque) AS torque, try_cast(seats AS INTEGER) AS seats, source_file
FROM bronze_cars"""
_BAD = "regexp_matches({0}, '^[0-9]{{2}}:[0-9]{{2}}[.][0-9]+$')"
STEPS["claims"] = f"""
SELECT try_cast(ClaimID AS BIGINT) AS claim_id,
  CAST(try_strptime(Claim_Logged_On, '%Y-%m-%d') AS TIMESTAMP) AS claim_logged_on, Claim_Logged_On AS _raw_logged_on,
  {_BAD.format("Claim_Logged_On")} AS claim_logged_on_corrupted,
  CAST(try_strptime(Claim_Processed_On, '%Y-%m-%d') AS TIMESTAMP) AS claim_processed_on,
  Claim_Processed_On AS _raw_processed_on,
  upper(trim(Claim_Processed_On)) IN ('NULL','NA','') AS claim_processed_on_null_string,
  upper(trim(Claim_Processed_On)) NOT IN ('NULL','NA','') AND {_BAD.format("Claim_Processed_On")} AS claim_processed_on_corrupted,
  CASE upper(trim(Claim_Rejected)) WHEN 'Y' THEN 'Y' WHEN 'N' THEN 'N' END AS claim_rejected,
  try_cast(PolicyID AS BIGINT) AS policy_id, authorities_contacted,
  try_cast(bodily_injuries AS INTEGER) AS bodily_injuries, {_known("collision_type")} AS collision_type, incident_city,
  CAST(try_strptime(incident_date, '%Y-%m-%d') AS DATE) AS incident_date, incident_date AS _raw_incident_date,
  {_BAD.format("incident_date")} AS incident_date_corrupted, incident_location, incident_severity, incident_state,
  incident_type, try_cast(injury AS DECIMAL(12,2)) AS injury,
  coalesce(try_cast(injury AS DECIMAL(12,2)) > 80000, false) AS injury_extreme_outlier,
  try_cast(number_of_vehicles_involved AS INTEGER) AS number_of_vehicles_involved,
  {_known("police_report_available")} AS police_report_available, try_cast(property AS DECIMAL(12,2)) AS property,
  {_known("property_damage")} AS property_damage, try_cast({_known("vehicle")} AS DECIMAL(12,2)) AS vehicle,
  try_cast(witnesses AS INTEGER) AS witnesses, source_file
FROM (SELECT * FROM bronze_claims) c"""
STEPS["policy"] = """
SELECT try_cast(policy_number AS BIGINT) AS policy_number,
  CAST(try_strptime(policy_bind_date, '%Y-%m-%d') AS DATE) AS policy_bind_date,
  upper(trim(policy_state)) AS policy_state, trim(policy_csl) AS policy_csl,
  try_cast(policy_deductable AS INTEGER) AS policy_deductable,
  try_cast(policy_annual_premium AS DECIMAL(10,2)) AS policy_annual_premium,
  try_cast(umbrella_limit AS BIGINT) AS umbrella_limit, try_cast(car_id AS BIGINT) AS car_id,
  try_cast(customer_id AS BIGINT) AS customer_id, source_file
FROM bronze_policy"""
STEPS["sales_parsed"] = f"""
SELECT *, coalesce(sold_on < ad_placed_on, false) AS sold_before_listed FROM (
  SELECT try_cast(sales_id AS BIGINT) AS sales_id, try_strptime(ad_placed_on, '%d-%m-%Y %H:%M') AS ad_placed_on,
    try_strptime(sold_on, '%d-%m-%Y %H:%M') AS sold_on,
    try_cast(original_selling_price AS DECIMAL(15,2)) AS original_selling_price, upper(trim(Region)) AS region_raw,
    State AS state, City AS city, {_known("seller_type")} AS seller_type, {_known("owner")} AS owner,
    try_cast(car_id AS BIGINT) AS car_id, source_file
  FROM bronze_sales WHERE sales_id IS NOT NULL)"""
STEPS["sales"] = """
SELECT s.*, coalesce(full_name, region_raw) AS region FROM sales_parsed s LEFT JOIN region_map ON region_raw = code"""

# Output columns of the clean tables, in types any engine prints alike.
_OUT = {
    "customers": "customer_id, region, state, city, marital_status, education, CAST(default_flag AS BIGINT) AS default_flag, "
    "CAST(balance AS DOUBLE) AS balance, CAST(hh_insurance AS BIGINT) AS hh_insurance, CAST(car_loan AS BIGINT) AS car_loan, "
    "job, source_file",
    "cars": "car_id, name, model, km_driven, km_driven_extreme, fuel, transmission, CAST(mileage_value AS DOUBLE) AS mileage_value, "
    "mileage_unit, CAST(engine_cc AS BIGINT) AS engine_cc, CAST(max_power_bhp AS DOUBLE) AS max_power_bhp, torque, "
    "CAST(seats AS BIGINT) AS seats, source_file",
    "claims": f"claim_id, {_stamp('claim_logged_on')} AS claim_logged_on, _raw_logged_on, claim_logged_on_corrupted, "
    f"{_stamp('claim_processed_on')} AS claim_processed_on, _raw_processed_on, claim_processed_on_null_string, "
    "claim_processed_on_corrupted, claim_rejected, policy_id, authorities_contacted, "
    "CAST(bodily_injuries AS BIGINT) AS bodily_injuries, collision_type, incident_city, "
    "CAST(incident_date AS VARCHAR) AS incident_date, _raw_incident_date, incident_date_corrupted, incident_location, "
    "incident_severity, incident_state, incident_type, CAST(injury AS DOUBLE) AS injury, injury_extreme_outlier, "
    "CAST(number_of_vehicles_involved AS BIGINT) AS number_of_vehicles_involved, police_report_available, "
    "CAST(property AS DOUBLE) AS property, property_damage, CAST(vehicle AS DOUBLE) AS vehicle, "
    "CAST(witnesses AS BIGINT) AS witnesses, source_file",
    "policy": "policy_number, CAST(policy_bind_date AS VARCHAR) AS policy_bind_date, policy_state, policy_csl, "
    "CAST(policy_deductable AS BIGINT) AS policy_deductable, CAST(policy_annual_premium AS DOUBLE) AS policy_annual_premium, "
    "umbrella_limit, car_id, customer_id, source_file",
    "sales": f"sales_id, {_stamp('ad_placed_on')} AS ad_placed_on, {_stamp('sold_on')} AS sold_on, "
    "CAST(original_selling_price AS DOUBLE) AS original_selling_price, region, state, city, seller_type, owner, car_id, "
    "sold_before_listed, source_file",
}
_OUT["sales_parsed"] = _OUT["sales"].replace(" region,", " region_raw,")

_GATE = {
    "customers": "customer_id IS NOT NULL AND customer_id > 0",
    "cars": "car_id IS NOT NULL AND car_id > 0",
    "claims": "claim_id IS NOT NULL AND claim_id > 0 AND policy_id IS NOT NULL",
    "policy": "policy_number IS NOT NULL AND policy_number > 0 AND customer_id IS NOT NULL AND car_id IS NOT NULL",
    "sales": "sales_id IS NOT NULL AND car_id IS NOT NULL",
}
for _entity, _test in _GATE.items():
    STEPS[f"silver_{_entity}"] = f"SELECT * FROM {_entity} WHERE {_test}"

_CHECKS = {
    "customers": (
        ("customer_id_not_null", "drop", "customer_id IS NOT NULL"),
        ("customer_id_positive", "drop", "customer_id > 0"),
        ("region_valid", "warn", "region IN ('West','Central','East','South')"),
        ("balance_not_null", "warn", "balance IS NOT NULL"),
        ("default_flag_valid", "warn", "default_flag IS NULL OR default_flag IN (0,1)"),
    ),
    "cars": (
        ("car_id_not_null", "drop", "car_id IS NOT NULL"),
        ("car_id_positive", "drop", "car_id > 0"),
        ("km_driven_non_negative", "warn", "km_driven IS NULL OR km_driven >= 0"),
        ("engine_cc_positive", "warn", "engine_cc IS NULL OR engine_cc > 0"),
        ("max_power_positive", "warn", "max_power_bhp IS NULL OR max_power_bhp > 0"),
        ("mileage_positive", "warn", "mileage_value IS NULL OR mileage_value > 0"),
        ("seats_in_range", "warn", "seats IS NULL OR (seats >= 2 AND seats <= 9)"),
        ("fuel_known", "warn", "fuel IS NULL OR fuel IN ('PETROL','DIESEL','CNG','LPG','ELECTRIC','HYBRID')"),
    ),
    "claims": (
        ("claim_id_not_null", "drop", "claim_id IS NOT NULL"),
        ("claim_id_positive", "drop", "claim_id > 0"),
        ("policy_id_not_null", "drop", "policy_id IS NOT NULL"),
        ("dates_corrupted_warn", "warn", "incident_date_corrupted = false"),
        ("injury_non_negative", "warn", "injury IS NULL OR injury >= 0"),
        ("vehicle_non_negative", "warn", "vehicle IS NULL OR vehicle >= 0"),
        ("property_non_negative", "warn", "property IS NULL OR property >= 0"),
        ("claim_rejected_valid", "warn", "claim_rejected IS NULL OR claim_rejected IN ('Y','N')"),
    ),
    "policy": (
        ("policy_number_not_null", "drop", "policy_number IS NOT NULL"),
        ("policy_number_positive", "drop", "policy_number > 0"),
        ("customer_id_not_null", "drop", "customer_id IS NOT NULL"),
        ("car_id_not_null", "drop", "car_id IS NOT NULL"),
        ("policy_bind_date_valid", "warn", "policy_bind_date IS NOT NULL"),
        ("premium_positive", "warn", "policy_annual_premium > 0"),
        ("deductable_non_negative", "warn", "policy_deductable >= 0"),
    ),
    "sales": (
        ("sales_id_not_null", "drop", "sales_id IS NOT NULL"),
        ("car_id_not_null", "drop", "car_id IS NOT NULL"),
        ("ad_placed_on_valid", "warn", "ad_placed_on IS NOT NULL"),
        ("price_positive", "warn", "original_selling_price > 0"),
        ("sold_not_before_listed", "warn", "sold_before_listed = false OR sold_on IS NULL"),
    ),
}


def _expectations(entity: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{action}' AS action, count(*) FILTER (WHERE coalesce({test}, false)) AS passed, "
        f"count(*) FILTER (WHERE NOT coalesce({test}, false)) AS failed FROM {entity}"
        for rule, action, test in _CHECKS[entity]
    )


_LABELS = {
    "customers": (
        ("customer_id_not_null", "customer_id IS NULL"),
        ("customer_id_non_positive", "customer_id <= 0"),
        ("region_invalid", "region IS NOT NULL AND region NOT IN ('West','Central','East','South','North')"),
        ("education_missing", "education IS NULL"),
        ("marital_status_missing", "marital_status IS NULL"),
        ("default_flag_invalid", "default_flag IS NOT NULL AND default_flag NOT IN (0,1)"),
    ),
    "cars": (
        ("car_id_not_null", "car_id IS NULL"),
        ("car_id_non_positive", "car_id <= 0"),
        ("km_driven_negative", "km_driven IS NOT NULL AND km_driven < 0"),
        ("km_driven_extreme_outlier", "km_driven_extreme = true"),
        ("engine_cc_non_positive", "engine_cc IS NOT NULL AND engine_cc <= 0"),
        ("max_power_non_positive", "max_power_bhp IS NOT NULL AND max_power_bhp <= 0"),
        ("seats_out_of_range", "seats IS NOT NULL AND (seats < 2 OR seats > 9)"),
        ("fuel_unknown_type", "fuel NOT IN ('PETROL','DIESEL','CNG','LPG','ELECTRIC','HYBRID')"),
    ),
    "claims": (
        ("claim_id_not_null", "claim_id IS NULL"),
        ("policy_id_not_null", "policy_id IS NULL"),
        ("claim_logged_on_corrupted", "claim_logged_on_corrupted = true"),
        ("incident_date_corrupted", "incident_date_corrupted = true"),
        ("claim_processed_on_corrupted", "claim_processed_on_corrupted = true"),
        ("injury_extreme_outlier", "injury > 80000"),
        ("claim_rejected_invalid_value", "claim_rejected IS NOT NULL AND claim_rejected NOT IN ('Y','N')"),
        ("injury_negative", "injury < 0"),
        ("collision_type_unknown", "collision_type IS NULL"),
        ("police_report_unknown", "police_report_available IS NULL"),
        ("property_damage_unknown", "property_damage IS NULL"),
    ),
    "policy": (
        ("policy_number_not_null", "policy_number IS NULL"),
        ("customer_id_not_null", "customer_id IS NULL"),
        ("car_id_not_null", "car_id IS NULL"),
        ("policy_bind_date_unparseable", "policy_bind_date IS NULL"),
        ("premium_non_positive", "policy_annual_premium <= 0"),
        ("deductable_negative", "policy_deductable < 0"),
    ),
    "sales": (
        ("sales_id_not_null", "sales_id IS NULL"),
        ("car_id_not_null", "car_id IS NULL"),
        ("ad_placed_on_unparseable", "ad_placed_on IS NULL"),
        ("price_non_positive", "original_selling_price <= 0"),
        ("sold_before_listed", "sold_before_listed = true"),
    ),
}
_ID = {"customers": "customer_id", "cars": "car_id", "claims": "claim_id", "policy": "policy_number", "sales": "sales_id"}

for _entity, _rules in _LABELS.items():
    _source = "sales_parsed" if _entity == "sales" else _entity
    _case = " ".join(f"WHEN {test} THEN '{label}'" for label, test in _rules)
    STEPS[f"bad_{_entity}"] = (
        f"SELECT *, '{_entity}' AS _entity FROM (SELECT *, CASE {_case} END AS _dq_rule FROM {_source}) "
        "WHERE _dq_rule IS NOT NULL"
    )


def _log(entities) -> str:
    return " UNION ALL ".join(
        f"SELECT '{e}' AS entity, _dq_rule, CAST({_ID[e]} AS VARCHAR) AS record_id, source_file FROM bad_{e}"
        for e in entities
    )


def _counts(entities) -> str:
    return " UNION ALL ".join(f"SELECT '{e}' AS entity, count(*) AS total_rows FROM silver_{e}" for e in entities)


ALL = ("customers", "cars", "claims", "policy", "sales")
STREAMED = ("cars", "claims", "policy", "sales")
STEPS["bridge"] = f"SELECT * FROM (VALUES {_values(RULE_BRIDGE)}) t(entity, _dq_rule, issue_id)"
STEPS["notes"] = (
    f"SELECT * FROM (VALUES {_values(ISSUE_ROWS)}) t(issue_id, entity, column_name, issue_type, issue_description, "
    "silver_fix_applied, baseline, severity, known_records, known_pct, prevention_note)"
)


def _stats(events: str, totals: str) -> str:
    return f"""
SELECT issue_id, e.entity, n AS affected_records,
  round(n * CAST(100.0 AS DOUBLE) / nullif(total_rows, 0), 2) + CAST(0.0 AS DOUBLE) AS affected_pct,
  CASE WHEN baseline IN ('UNRESOLVABLE','PARTIAL','FLAGGED') THEN baseline WHEN n = 0 THEN 'RESOLVED' ELSE baseline END
    AS fix_status, total_rows AS silver_total_rows
FROM (SELECT issue_id, entity, count(DISTINCT record_id) AS n FROM {events} GROUP BY ALL) e
LEFT JOIN {totals} USING (entity) LEFT JOIN (SELECT issue_id, baseline FROM notes) USING (issue_id)"""


def _resolved(log: str) -> str:
    return (
        f"SELECT l.*, coalesce(b.issue_id, 'UNMAPPED-' || l.entity) AS issue_id FROM {log} l "
        "LEFT JOIN bridge b ON l.entity = b.entity AND l._dq_rule = b._dq_rule"
    )


for _tag, _group in (("", ALL), ("_streamed", STREAMED)):
    STEPS[f"log{_tag}"] = _log(_group)
    STEPS[f"totals{_tag}"] = _counts(_group)
    STEPS[f"resolved{_tag}"] = _resolved(f"log{_tag}")
    STEPS[f"stats{_tag}"] = _stats(f"resolved{_tag}", f"totals{_tag}")

STEPS["dim_customer"] = (
    "SELECT customer_id, region, state, city, default_flag, balance, hh_insurance, car_loan, job FROM silver_customers"
)
_CAR = "car_id model name km_driven fuel transmission mileage_value mileage_unit engine_cc max_power_bhp torque seats".split()
_POLICY = (
    "policy_number policy_bind_date policy_state policy_csl policy_deductable policy_annual_premium umbrella_limit "
    "car_id customer_id"
).split()


def _first(columns, source: str) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in columns[1:])
    return (
        f"SELECT {', '.join(columns)} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {columns[0]} ORDER BY {order}) = 1"
    )


STEPS["dim_car"] = _first(_CAR, "silver_cars")
STEPS["dim_policy"] = _first(_POLICY, "silver_policy")
STEPS["fact_claims"] = """
SELECT claim_id, p.customer_id, policy_id, claim_rejected, incident_city, authorities_contacted, bodily_injuries,
  incident_location, incident_severity, incident_state, incident_type, injury, number_of_vehicles_involved,
  police_report_available, property, property_damage, vehicle, witnesses
FROM silver_claims c LEFT JOIN silver_policy p ON c.policy_id = p.policy_number"""
STEPS["fact_sales"] = """
SELECT sales_id, ad_placed_on, car_id, owner, sold_on, original_selling_price, region, state, city, seller_type
FROM silver_sales"""

STEPS["amounts"] = """
SELECT *, injury + property + vehicle AS total_amount,
  date_diff('day', CAST(claim_logged_on AS DATE), CAST(claim_processed_on AS DATE)) AS processing_delay,
  count(*) OVER (PARTITION BY policy_id) AS claim_count
FROM silver_claims"""
STEPS["spread"] = (
    "SELECT avg(CAST(total_amount AS DOUBLE)) AS mean, stddev_samp(CAST(total_amount AS DOUBLE)) AS std FROM amounts"
)
STEPS["flagged"] = """
SELECT *, CASE WHEN z_score > 2.5 THEN 1 ELSE 0 END AS rule_high_amount,
  CASE WHEN incident_severity IN ('Minor Damage','Trivial Damage') AND total_amount > mean THEN 1 ELSE 0 END
    AS rule_severity_mismatch,
  CASE WHEN police_report_available IN ('NO','?') OR property_damage = '?' THEN 1 ELSE 0 END AS rule_missing_docs,
  CASE WHEN claim_count > 2 THEN 1 ELSE 0 END AS rule_repeat_claimant,
  CASE WHEN processing_delay > 30 OR claim_processed_on IS NULL THEN 1 ELSE 0 END AS rule_delay
FROM (SELECT *, (CAST(total_amount AS DOUBLE) - mean) / std AS z_score FROM amounts, spread)"""
STEPS["scored"] = """
SELECT *, CASE WHEN anomaly_score >= 80 THEN 'HIGH' WHEN anomaly_score >= 60 THEN 'MEDIUM' ELSE 'LOW' END AS priority
FROM (SELECT *,
  CAST(30*rule_high_amount + 20*rule_severity_mismatch + 15*rule_missing_docs + 15*rule_repeat_claimant + 20*rule_delay
    AS BIGINT) AS anomaly_score,
  concat_ws(', ', CASE WHEN rule_high_amount = 1 THEN 'High Amount' END,
    CASE WHEN rule_severity_mismatch = 1 THEN 'Severity Mismatch' END,
    CASE WHEN rule_missing_docs = 1 THEN 'Missing Docs' END,
    CASE WHEN rule_repeat_claimant = 1 THEN 'Repeat Claimant' END,
    CASE WHEN rule_delay = 1 THEN 'Processing Delay' END) AS triggered_rules
  FROM flagged)"""

STEPS["kpi_policy"] = """
SELECT count(*) AS total_policies, round(CAST(sum(policy_annual_premium) AS DOUBLE) / count(policy_annual_premium), 6) AS avg_premium,
  CAST(sum(policy_annual_premium) AS DOUBLE) AS total_premium, count(DISTINCT policy_state) AS policy_types FROM dim_policy"""
STEPS["kpi_claims"] = """
SELECT count(*) AS total_claims, round(CAST(sum(t) AS DOUBLE) / count(t), 6) AS avg_claim_amount,
  CAST(sum(t) AS DOUBLE) AS total_claim_amount FROM (SELECT vehicle + property + injury AS t FROM fact_claims)"""
STEPS["kpi_customer"] = (
    "SELECT count(*) AS total_customers, count(DISTINCT state) AS geographic_spread FROM dim_customer"
)


def _json(measures: dict[str, bool]) -> str:
    """JSON object text of a KPI row; True marks doubles."""
    parts = [f"'\"{m}\":' || " + (_json_number(m) if real else f"CAST({m} AS VARCHAR)") for m, real in measures.items()]
    return "'{' || " + " || ',' || ".join(f"({p})" for p in parts) + " || '}'"


_POLICY_JSON = _json({"total_policies": False, "avg_premium": True, "total_premium": True, "policy_types": False})
_CLAIMS_JSON = _json({"total_claims": False, "avg_claim_amount": True, "total_claim_amount": True})
_CUSTOMER_JSON = _json({"total_customers": False, "geographic_spread": False})
STEPS["kpi_text"] = (
    f"SELECT 'policy' AS domain, {_POLICY_JSON} AS kpi_data FROM kpi_policy UNION ALL "
    f"SELECT 'claims', {_CLAIMS_JSON} FROM kpi_claims UNION ALL SELECT 'customer', {_CUSTOMER_JSON} FROM kpi_customer"
)
STEPS["issue_prompts"] = (
    f"SELECT issue_id, entity, column_name, severity, affected_records, {_fill(ISSUE_PROMPT, entity='s.entity')} AS prompt "
    "FROM stats s LEFT JOIN (SELECT * EXCLUDE (entity) FROM notes) USING (issue_id)"
)
STEPS["docs"] = (
    "SELECT *, "
    + _fill(
        "\nPolicy Number: {policy_number}\nDeductible: {policy_deductable}\nUmbrella Coverage: {umbrella_limit}\n"
        "Policy State: {policy_state}\n"
    )
    + " AS policy_doc FROM dim_policy"
)
STEPS["asked"] = " UNION ALL ".join(
    f"SELECT *, {_fill(q.replace('{}', '{policy_number}'))} AS question, {i} AS form FROM docs"
    for i, q in enumerate(POLICY_QUESTIONS)
)
STEPS["routed"] = """
SELECT *, CASE WHEN contains(lower(question), 'umbrella') THEN 'umbrella'
  WHEN contains(lower(question), 'deductible') THEN 'deductible' WHEN contains(lower(question), 'compare') THEN 'compare'
  WHEN contains(lower(question), 'california') OR contains(lower(question), 'state') THEN 'state' ELSE 'default' END AS route
FROM asked"""
STEPS["centre_parts"] = """
SELECT label, pos, round(avg(CAST(x AS DOUBLE)), 4) AS c
FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL"""
STEPS["centres"] = "SELECT label, list(c ORDER BY pos) AS centre FROM centre_parts GROUP BY label"
STEPS["neighbours"] = """
SELECT *, row_number() OVER (PARTITION BY label ORDER BY distance, vec_id) AS rank FROM (
  SELECT c.label, vec_id, pow(list_distance(CAST(embedding AS DOUBLE[]), centre), 2) AS distance
  FROM centres c CROSS JOIN (SELECT vec_id, embedding FROM embeddings) e) QUALIFY rank <= 5"""
def _embedded(name: str, source: str, key: str, text: str) -> None:
    """Steps that end in ``<name>_vectors``: a key and 256 floats, counts of its terms by md5, at unit length."""
    terms = f"regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}]+')"
    STEPS[f"{name}_terms"] = (
        f"SELECT key, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % 256 AS place FROM "
        f"(SELECT {key} AS key, unnest({terms}) AS t FROM {source})"
    )
    STEPS[f"{name}_counts"] = f"SELECT key, place, count(*) AS c FROM {name}_terms GROUP BY ALL"
    STEPS[f"{name}_lengths"] = f"SELECT key, sqrt(CAST(sum(c * c) AS DOUBLE)) AS n FROM {name}_counts GROUP BY key"
    STEPS[f"{name}_vectors"] = (
        f"SELECT g.key, list(CAST(coalesce(c / n, 0) AS FLOAT) ORDER BY g.place) AS vec "
        f"FROM (SELECT {key} AS key, unnest(range(256)) AS place FROM {source}) g "
        f"LEFT JOIN {name}_counts c ON c.key = g.key AND c.place = g.place LEFT JOIN {name}_lengths l ON l.key = g.key GROUP BY g.key"
    )


STEPS["policy_chunks"] = """
SELECT policy_number || '-' || CAST(start_at / 150 AS BIGINT) AS chunk_id, substring(policy_doc, CAST(start_at + 1 AS BIGINT), 200) AS chunk
FROM (SELECT policy_number, policy_doc, unnest(range(0, length(policy_doc), 150)) AS start_at FROM docs)"""
STEPS["state_questions"] = " UNION ALL ".join(
    f"SELECT {_fill(q.replace('{}', '{policy_state}'))} AS question, '{form}' AS form "
    "FROM (SELECT DISTINCT policy_state FROM dim_policy WHERE policy_state IS NOT NULL)"
    for q, form in zip(STATE_QUESTIONS, ("state", "deductible", "umbrella", "compare", "default"), strict=True)
)
_embedded("document", "documents", "doc_id", "text")
_embedded("chunk", "policy_chunks", "chunk_id", "chunk")
_embedded("question", "state_questions", "question", "question")
STEPS["hits"] = """
SELECT *, row_number() OVER (PARTITION BY question ORDER BY distance, chunk_id) AS rank FROM (
  SELECT q.key AS question, c.key AS chunk_id, round(pow(list_distance(CAST(q.vec AS DOUBLE[]), CAST(c.vec AS DOUBLE[])), 2), 10) AS distance
  FROM question_vectors q CROSS JOIN (SELECT key, vec FROM chunk_vectors) c) QUALIFY rank <= 5"""
_FIELDS = {
    "policy": "Policy Number",
    "umbrella": "Umbrella Coverage",
    "deductible": "Deductible",
    "coverage": "Coverage Tier",
    "state": "Policy State",
}
STEPS["sources"] = (
    "SELECT h.*, q.form, chunk, "
    + ", ".join(f"nullif(regexp_extract(chunk, '{label}:\\s*(\\S+)', 1), '') AS {name}" for name, label in _FIELDS.items())
    + " FROM hits h JOIN policy_chunks p ON p.chunk_id = h.chunk_id JOIN state_questions q ON q.question = h.question"
)


def _each(text: str, kept: str, between: str) -> str:
    return f"coalesce(string_agg({text}, {between} ORDER BY rank) FILTER (WHERE {kept}), '')"


_QUOTED = "chr(39) || coalesce(policy, 'None') || chr(39)"
_COVERS = "umbrella = 'Yes' OR try_cast(umbrella AS DOUBLE) > 0"
_PER_POLICY = {
    "deductible": "' has deductible ' || coalesce(deductible, 'None')",
    "compare": "' has ' || coalesce(coverage, 'None') || ' coverage'",
    "default": "''",
}
_LINES = {form: _each(f"'Policy ' || policy || {text}", "policy IS NOT NULL", "chr(10)") for form, text in _PER_POLICY.items()}
STEPS["state_answers"] = f"""
SELECT question, CASE form WHEN 'umbrella' THEN 'Policies with umbrella coverage: [' || {_each(_QUOTED, _COVERS, "', '")} || ']'
    WHEN 'deductible' THEN {_LINES["deductible"]} WHEN 'compare' THEN {_LINES["compare"]}
    WHEN 'state' THEN 'Policies found: [' || {_each(_QUOTED, "state IS NOT NULL", "', '")} || ']'
    ELSE 'Relevant policies:' || chr(10) || {_LINES["default"]} END AS answer,
  round(1 / (1 + min(distance)), 6) + 0.0::DOUBLE AS confidence_score, string_agg(chunk, ' | ' ORDER BY rank) AS source_policies
FROM sources GROUP BY question, form"""
STEPS["responses"] = """
SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN text
  WHEN 1 THEN CAST(to_json([{'type': 'reasoning', 'text': role}, {'type': 'text', 'text': text}]) AS VARCHAR)
  WHEN 2 THEN CAST(to_json([{'type': 'text', 'text': role}, {'type': 'text', 'text': text}]) AS VARCHAR)
  ELSE CAST(to_json([{'type': 'reasoning', 'text': role}]) AS VARCHAR) END AS content FROM conversations"""
STEPS["blocks"] = """
SELECT *, CASE WHEN json_valid(content) AND json_type(CASE WHEN json_valid(content) THEN content END) = 'ARRAY'
  THEN list_filter(from_json(CASE WHEN json_valid(content) THEN content END, '["JSON"]'),
    lambda b: (b ->> '$.type') = 'text')[-1] ->> '$.text' END AS last_text FROM responses"""


def _compose(query: str) -> str:
    """Put the steps a query refers to, and the steps those refer to, in front of it."""
    needed: list[str] = []

    def visit(sql: str, seen: frozenset[str]) -> None:
        for name in STEPS:
            if name not in seen and re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", sql):
                visit(STEPS[name], seen | {name})
                if name not in needed:
                    needed.append(name)

    visit(query, frozenset())
    head = ", ".join(f"{name} AS ({STEPS[name].strip()})" for name in needed)
    return f"WITH {head} {query}" if needed else query


def _plain(columns: str, source: str) -> str:
    return f"SELECT {columns} FROM {source}"


_FACT_CLAIMS = (
    "claim_id, customer_id, policy_id, claim_rejected, incident_city, authorities_contacted, "
    "CAST(bodily_injuries AS BIGINT) AS bodily_injuries, incident_location, incident_severity, incident_state, incident_type, "
    "CAST(injury AS DOUBLE) AS injury, CAST(number_of_vehicles_involved AS BIGINT) AS number_of_vehicles_involved, "
    "police_report_available, CAST(property AS DOUBLE) AS property, property_damage, CAST(vehicle AS DOUBLE) AS vehicle, "
    "CAST(witnesses AS BIGINT) AS witnesses"
)
_RATE = (
    "SELECT region, policy_csl, count(*) FILTER (WHERE claim_rejected = 'Y') / CAST(count(*) AS DOUBLE) AS rejection_rate "
    "FROM dim_policy fp JOIN fact_claims fc ON fc.policy_id = fp.policy_number "
    "JOIN dim_customer dc ON dc.customer_id = fp.customer_id GROUP BY region, policy_csl"
)
_ISSUE_EVENTS = (
    "SELECT e.issue_id, e.entity, _dq_rule, column_name, issue_type, issue_description, severity, affected_records, "
    "affected_pct, silver_total_rows, fix_status, silver_fix_applied, prevention_note, record_id, source_file, "
    "'silver_' || e.entity AS _dq_table FROM {events} e LEFT JOIN {stats} s ON e.issue_id = s.issue_id "
    "LEFT JOIN notes n ON e.issue_id = n.issue_id"
)

_QUERIES: dict[str, str] = {}
for _entity in ALL:
    _parsed = "sales_parsed" if _entity == "sales" else _entity
    _QUERIES[f"clean_{_entity}"] = _plain(_OUT[_entity], _entity)
    _QUERIES[f"gate_{_entity}"] = _plain(_OUT[_entity], f"silver_{_entity}")
    _QUERIES[f"expectations_{_entity}"] = _expectations(_entity)
    _QUERIES[f"quarantine_{_entity}"] = _plain(f"{_OUT[_parsed]}, _dq_rule, _entity", f"bad_{_entity}")
_QUERIES |= {
    "quality_log": "SELECT * FROM log",
    "entity_counts": "SELECT * FROM totals",
    "issue_stats": "SELECT * FROM stats",
    "enrich_issues": _ISSUE_EVENTS.format(events="resolved", stats="stats"),
    "dim_customer": "SELECT customer_id, region, state, city, CAST(default_flag AS BIGINT) AS default_flag, "
    "CAST(balance AS DOUBLE) AS balance, CAST(hh_insurance AS BIGINT) AS hh_insurance, CAST(car_loan AS BIGINT) AS car_loan, "
    "job FROM dim_customer",
    "dim_car": "SELECT car_id, model, name, km_driven, fuel, transmission, CAST(mileage_value AS DOUBLE) AS mileage_value, "
    "mileage_unit, CAST(engine_cc AS BIGINT) AS engine_cc, CAST(max_power_bhp AS DOUBLE) AS max_power_bhp, torque, "
    "CAST(seats AS BIGINT) AS seats FROM dim_car",
    "dim_policy": "SELECT policy_number, CAST(policy_bind_date AS VARCHAR) AS policy_bind_date, policy_state, policy_csl, "
    "CAST(policy_deductable AS BIGINT) AS policy_deductable, CAST(policy_annual_premium AS DOUBLE) AS policy_annual_premium, "
    "umbrella_limit, car_id, customer_id FROM dim_policy",
    "fact_claims": _plain(_FACT_CLAIMS, "fact_claims"),
    "fact_sales": f"SELECT sales_id, {_stamp('ad_placed_on')} AS ad_placed_on, car_id, owner, {_stamp('sold_on')} AS sold_on, "
    "CAST(original_selling_price AS DOUBLE) AS original_selling_price, region, state, city, seller_type FROM fact_sales",
    "multi_region_customers": "SELECT customer_id, count(DISTINCT region) AS region_count FROM unified "
    "WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(DISTINCT region) > 1",
    "claim_rejection_rate": _RATE,
    "refresh_rejection_rate": _RATE,
    "unsold_by_model_region": "SELECT model, fs.region, count(*) AS unsold_count FROM fact_sales fs "
    "JOIN dim_car dc ON fs.car_id = dc.car_id WHERE sold_on IS NULL GROUP BY model, fs.region",
    "aging_buckets": "SELECT region, aging_bucket, count(*) AS listing_count FROM (SELECT region, "
    f"CASE WHEN d <= 30 THEN '0-30' WHEN d <= 60 THEN '30-60' ELSE '60+' END AS aging_bucket FROM (SELECT region, "
    f"date_diff('day', CAST(ad_placed_on AS DATE), DATE '{AS_OF}') AS d FROM fact_sales WHERE sold_on IS NULL)) "
    "GROUP BY region, aging_bucket",
    "claim_scores": "SELECT claim_id, policy_id, round(CAST(total_amount AS DOUBLE), 4) + 0.0::DOUBLE AS total_amount, "
    "CAST(processing_delay AS BIGINT) AS processing_delay, round(z_score, 4) + 0.0::DOUBLE AS z_score, claim_count, "
    "CAST(rule_high_amount AS BIGINT) AS rule_high_amount, CAST(rule_severity_mismatch AS BIGINT) AS rule_severity_mismatch, "
    "CAST(rule_missing_docs AS BIGINT) AS rule_missing_docs, CAST(rule_repeat_claimant AS BIGINT) AS rule_repeat_claimant, "
    "CAST(rule_delay AS BIGINT) AS rule_delay, anomaly_score, priority, triggered_rules FROM scored",
    "claim_priority_counts": "SELECT priority, count(*) AS claims FROM scored GROUP BY priority",
    "anomaly_report": "SELECT claim_id AS Claim_ID, policy_id AS Policy_ID, CAST(total_amount AS DOUBLE) AS total_amount, "
    f"incident_severity, incident_type, anomaly_score, priority, triggered_rules, {_fill(BRIEF)} AS investigation_brief "
    "FROM scored WHERE anomaly_score >= 60",
    "investigation_prompts": f"SELECT claim_id, policy_id, {_fill(INVESTIGATION_PROMPT)} AS prompt FROM scored "
    "WHERE anomaly_score >= 60",
    "kpis_policy": "SELECT total_policies, round(avg_premium, 4) + 0.0::DOUBLE AS avg_premium, "
    "round(total_premium, 4) + 0.0::DOUBLE AS total_premium, policy_types FROM kpi_policy",
    "kpis_claims": "SELECT total_claims, round(avg_claim_amount, 4) + 0.0::DOUBLE AS avg_claim_amount, "
    "round(total_claim_amount, 4) + 0.0::DOUBLE AS total_claim_amount FROM kpi_claims",
    "kpis_customer": "SELECT * FROM kpi_customer",
    "kpi_json": "SELECT * FROM kpi_text",
    "summary_prompts": f"SELECT domain, domain || ' Executive Summary' AS summary_title, {_fill(SUMMARY_PROMPT)} AS prompt "
    "FROM kpi_text",
    "domain_summaries": "SELECT domain, domain || ' Executive Summary' AS summary_title, "
    "'Domain: ' || domain || chr(10) || 'KPIs: ' || kpi_data AS ai_summary, kpi_data, 'offline' AS model_name, "
    f"'{SUCCESS}' AS generation_status FROM kpi_text",
    "dq_prompts": "SELECT issue_id, prompt FROM issue_prompts",
    "dq_explanations": "SELECT issue_id, entity AS table_name, column_name, severity, affected_records, "
    f"split_part(prompt, chr(10) || chr(10), 2) AS ai_explanation, 'offline' AS model_name, '{SUCCESS}' AS generation_status "
    "FROM issue_prompts",
    "policy_documents": "SELECT policy_number, policy_doc FROM docs",
    "policy_fields": "SELECT policy_number, CAST(policy_number AS VARCHAR) AS policy, CAST(umbrella_limit AS VARCHAR) AS umbrella, "
    "CAST(policy_deductable AS VARCHAR) AS deductible, CAST(NULL AS VARCHAR) AS coverage, policy_state AS state FROM docs",
    "route_questions": "SELECT policy_number, question, route, CASE route "
    "WHEN 'umbrella' THEN 'Policies with umbrella coverage: [' || "
    "CASE WHEN umbrella_limit > 0 THEN '''' || policy_number || '''' ELSE '' END || ']' "
    "WHEN 'deductible' THEN 'Policy ' || policy_number || ' has deductible ' || policy_deductable "
    "WHEN 'compare' THEN 'Policy ' || policy_number || ' has None coverage' "
    "WHEN 'state' THEN 'Policies found: [''' || policy_number || ''']' "
    "ELSE 'Relevant policies:' || chr(10) || 'Policy ' || policy_number END AS answer FROM routed",
    "chunk_documents": "SELECT doc_id, CAST(start_at / 150 AS BIGINT) AS chunk_pos, substring(text, CAST(start_at + 1 AS BIGINT), 200) AS chunk "
    "FROM (SELECT doc_id, text, unnest(range(0, length(text), 150)) AS start_at FROM documents)",
    "knn_exact": "SELECT label::BIGINT AS label, vec_id, round(distance, 6) + 0.0::DOUBLE AS distance, rank FROM neighbours",
    "retrieval_confidence": "SELECT label::BIGINT AS label, round(1 / (1 + distance), 6) + 0.0::DOUBLE AS confidence_score "
    "FROM neighbours WHERE rank = 1",
    "parse_text_blocks": "SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(nullif(last_text, ''), content) AS answer FROM blocks",
    "evolved_union": "SELECT event_id, user_id, event_type, value, "
    "CASE WHEN event_type NOT IN ('click','view') THEN props END AS props FROM events",
    "csv_by_header": _plain(_OUT["customers"].removesuffix(", source_file"), "unified"),
    "stream_ingest": _plain(_OUT["policy"], "silver_policy"),
    "stream_dedupe": "SELECT DISTINCT customer_id FROM silver_customers",
    "stream_exact_distinct": "SELECT incident_severity, count(DISTINCT policy_id) AS policies FROM silver_claims GROUP BY 1",
    "stream_fact_claims": _plain(_FACT_CLAIMS, "fact_claims"),
    "stream_quality_log": "SELECT * FROM log_streamed",
    "stream_issue_stats": "SELECT * FROM stats_streamed",
    "stream_enrich_issues": _ISSUE_EVENTS.format(events="resolved_streamed", stats="stats_streamed"),
    "stream_split_quality": "SELECT 'clean' AS kind, claim_id, '' AS _dq_rule FROM silver_claims UNION ALL "
    "SELECT 'quarantine' AS kind, claim_id, _dq_rule FROM bad_claims",
}

# Streams over all five entities give what the batch gives.
_QUERIES |= {
    "stream_survivors": _QUERIES["clean_customers"],
    "stream_quality_log_all": _QUERIES["quality_log"],
    "stream_issue_stats_all": _QUERIES["issue_stats"],
    "stream_enrich_issues_all": _QUERIES["enrich_issues"],
}

_QUERIES |= {
    "embed_documents": "SELECT key AS doc_id, vec AS embedding FROM document_vectors",
    "retrieve_answers": "SELECT * FROM state_answers",
    "query_history": "SELECT * FROM state_answers",
}

# Feeds that drift, files that come late and counts taken on the way give what the batch over all rows gives.
_QUERIES |= {
    "raw_to_silver": _plain(_OUT["claims"].removesuffix(", source_file"), "silver_claims"),
    "rescued_values": "SELECT ClaimID AS claim_id, 'vehicle' AS column_name, vehicle AS raw_value FROM bronze_claims "
    "WHERE ClaimID % 3 <> 0 AND vehicle = 'NULL'",
    "late_customers": _QUERIES["clean_customers"],
    "late_customer_events": "SELECT * FROM log WHERE entity = 'customers'",
    "stream_expectations": " UNION ALL ".join(
        f"SELECT '{e}' AS entity, rule, action, passed, failed FROM ({_QUERIES[f'expectations_{e}']})" for e in ALL
    ),
}

ORACLES: dict[str, str] = {name: _compose(sql) for name, sql in _QUERIES.items()}
