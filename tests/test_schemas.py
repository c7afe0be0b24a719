"""Column names, order and types of the tables are a contract."""

import pytest

from queries import registry as r

SILVER = {
    "customers": "customer_id:bigint,region:string,state:string,city:string,marital_status:string,education:string,"
    "default_flag:int,balance:decimal(14,2),hh_insurance:int,car_loan:int,job:string",
    "cars": "car_id:bigint,name:string,model:string,km_driven:bigint,km_driven_extreme:boolean,fuel:string,"
    "transmission:string,mileage_value:decimal(6,2),mileage_unit:string,engine_cc:int,max_power_bhp:decimal(7,2),"
    "torque:string,seats:int",
    "claims": "claim_id:bigint,claim_logged_on:timestamp,_raw_logged_on:string,claim_logged_on_corrupted:boolean,"
    "claim_processed_on:timestamp,_raw_processed_on:string,claim_processed_on_null_string:boolean,"
    "claim_processed_on_corrupted:boolean,claim_rejected:string,policy_id:bigint,authorities_contacted:string,"
    "bodily_injuries:int,collision_type:string,incident_city:string,incident_date:date,_raw_incident_date:string,"
    "incident_date_corrupted:boolean,incident_location:string,incident_severity:string,incident_state:string,"
    "incident_type:string,injury:decimal(12,2),injury_extreme_outlier:boolean,number_of_vehicles_involved:int,"
    "police_report_available:string,property:decimal(12,2),property_damage:string,vehicle:decimal(12,2),witnesses:int",
    "policy": "policy_number:bigint,policy_bind_date:date,policy_state:string,policy_csl:string,policy_deductable:int,"
    "policy_annual_premium:decimal(10,2),umbrella_limit:bigint,car_id:bigint,customer_id:bigint",
    "sales": "sales_id:bigint,ad_placed_on:timestamp,sold_on:timestamp,original_selling_price:decimal(15,2),"
    "region:string,state:string,city:string,seller_type:string,owner:string,car_id:bigint,sold_before_listed:boolean",
}
LOADED = ",source_file:string,ingestion_timestamp:timestamp"
GOLD = {
    "dim_customer": "customer_id region state city default_flag balance hh_insurance car_loan job",
    "dim_car": "car_id model name km_driven fuel transmission mileage_value mileage_unit engine_cc max_power_bhp torque "
    "seats",
    "dim_policy": "policy_number policy_bind_date policy_state policy_csl policy_deductable policy_annual_premium "
    "umbrella_limit car_id customer_id",
    "fact_claims": "claim_id customer_id policy_id claim_rejected incident_city authorities_contacted bodily_injuries "
    "incident_location incident_severity incident_state incident_type injury number_of_vehicles_involved "
    "police_report_available property property_damage vehicle witnesses",
    "fact_sales": "sales_id ad_placed_on car_id owner sold_on original_selling_price region state city seller_type",
}


@pytest.mark.parametrize("entity", SILVER)
def test_silver(spark, sf_dir, entity):
    assert r.gated(spark, sf_dir, entity).schema.simpleString() == f"struct<{SILVER[entity]}{LOADED}>"


@pytest.mark.parametrize("name", GOLD)
def test_gold(spark, sf_dir, name):
    assert getattr(r, name)(spark, sf_dir).columns == [*GOLD[name].split(), "ingestion_timestamp", "md_created_datetime"]


def test_event_log_and_statistics(spark, sf_dir):
    assert r.log(spark, sf_dir).columns == ["entity", "_dq_rule", "record_id", "source_file", "_dq_detected_at"]
    assert r.counts(spark, sf_dir).columns == ["entity", "total_rows"]
    assert r.stats(spark, sf_dir).columns == [
        "issue_id", "entity", "affected_records", "affected_pct", "fix_status", "last_detected_at", "silver_total_rows",
    ]


@pytest.mark.parametrize("entity", SILVER)
def test_quarantine_keeps_the_parsed_columns(spark, sf_dir, entity):
    extra = ["_dq_rule", "_dq_detected_at", "_entity"]
    assert r.rejected(spark, sf_dir, entity).columns == [*r.parsed(spark, sf_dir, entity).columns, *extra]
