import datetime
import json
from decimal import Decimal

from pyspark.sql import functions as F

from medallion.operators.enrich import enrich_partitions, enrich_rows
from medallion.plans import anomaly, explain, kpi, views
from queries.registry import clean, scored

CLAIM = (
    "claim_id bigint, policy_id bigint, injury decimal(12,2), property decimal(12,2), vehicle decimal(12,2), "
    "incident_severity string, incident_type string, police_report_available string, property_damage string, "
    "claim_logged_on timestamp, claim_processed_on timestamp"
)
DAY = datetime.datetime(2024, 1, 1)


def claim(i, policy=1, injury="10", severity="Major Damage", police="YES", damage="YES", delay=5, vehicle="1"):
    done = None if delay is None else DAY + datetime.timedelta(days=delay)
    amounts = [None if a is None else Decimal(a) for a in (injury, "1", vehicle)]
    return (i, policy, *amounts, severity, "Collision", police, damage, DAY, done)


def flags(rows, claims, **more):
    names = [r.column for r in anomaly.RISK_RULES]
    got = anomaly.score_claims(rows(claims, CLAIM), **more).collect()
    return {r.claim_id: (tuple(r[n] for n in names), r.anomaly_score, r.priority, r.triggered_rules) for r in got}


def test_rules_and_score(rows):
    claims = [claim(i, policy=i) for i in range(20)]
    claims += [claim(100, policy=100, injury="900", severity="Minor Damage", police="NO", delay=31)]
    got = flags(rows, claims)
    assert got[0] == ((0, 0, 0, 0, 0), 0, "LOW", "")
    assert got[100] == ((1, 1, 1, 0, 1), 85, "HIGH", "High Amount, Severity Mismatch, Missing Docs, Processing Delay")


def test_repeat_claimants_need_three_claims(rows):
    got = flags(rows, [claim(1, 1), claim(2, 1), claim(3, 2), claim(4, 2), claim(5, 2)])
    assert [got[i][0][3] for i in range(1, 6)] == [0, 0, 1, 1, 1]


def test_unprocessed_claims_and_unknown_amounts(rows):
    got = flags(rows, [claim(1, delay=None), claim(2, delay=30, vehicle=None), claim(3, damage="?")])
    assert got[1][0] == (0, 0, 0, 1, 1) and got[2][0] == (0, 0, 0, 1, 0) and got[3][0][2] == 1


def test_missing_documents_option(rows):
    claims = [claim(1, police=None), claim(2, damage=None), claim(3)]
    assert [flags(rows, claims)[i][0][2] for i in (1, 2, 3)] == [0, 0, 0]
    assert [flags(rows, claims, null_is_missing=True)[i][0][2] for i in (1, 2, 3)] == [1, 1, 0]


def test_zero_fill_option(rows):
    df = rows([claim(1, vehicle=None)], CLAIM)
    assert anomaly.with_total(df).first()["total_amount"] is None
    assert anomaly.with_total(df, fill_zero=True).first()["total_amount"] == Decimal("11.00")


def test_report_columns_and_known_counts(spark, sf_dir):
    report = anomaly.anomaly_report(scored(spark, sf_dir))
    assert report.columns == [
        "Claim_ID", "Policy_ID", "total_amount", "incident_severity", "incident_type", "anomaly_score", "priority",
        "triggered_rules", "investigation_brief",
    ]
    if sf_dir.endswith("sf0.001"):
        assert {r.priority: r["count"] for r in report.groupBy("priority").count().collect()} == {"HIGH": 1, "MEDIUM": 188}


def test_customers_are_unique_after_cleaning(spark, sf_dir):
    df = clean(spark, sf_dir, "customers")
    assert df.count() == df.select("customer_id").distinct().count()


def test_rejection_rate_counts_unknown_decisions(rows):
    policy = rows([(1, "100/300", 7), (2, "100/300", 7), (3, "x", 8)], "policy_number bigint, policy_csl string, customer_id bigint")
    claims = rows([(1, "Y"), (1, "N"), (2, None), (2, "Y"), (9, "Y")], "policy_id bigint, claim_rejected string")
    customer = rows([(7, "West"), (8, "East")], "customer_id bigint, region string")
    assert [tuple(r) for r in views.claim_rejection_rate(policy, claims, customer).collect()] == [("West", "100/300", 0.5)]


def test_aging_uses_the_given_day(rows):
    stamps = [(r, datetime.datetime(2024, 1, 31) - datetime.timedelta(days=d), s) for r, d, s in
              [("W", 30, None), ("W", 31, None), ("W", 61, None), ("W", 5, DAY)]]
    df = rows(stamps, "region string, ad_placed_on timestamp, sold_on timestamp")
    got = {r.aging_bucket: r.listing_count for r in views.aging_buckets(df, "2024-01-31").collect()}
    assert got == {"0-30": 1, "30-60": 1, "60+": 1}


def test_enrichment_marks_only_the_failing_row(rows):
    def make():
        def call(prompt):
            if prompt == "bad":
                raise RuntimeError("no answer")
            return prompt.upper()

        return call

    df = rows([(2**60, "good", None), (2, "bad", Decimal("1.50"))], "id bigint, prompt string, amount decimal(5,2)")
    got = {r.id: r for r in enrich_rows(df, make, "prompt", "m", partitions=2).collect()}
    assert (got[2**60].response, got[2**60].generation_status, got[2**60].amount) == ("GOOD", "SUCCESS", None)
    assert (got[2].response, got[2].generation_status, got[2].amount) == ("no answer", "FAILED", Decimal("1.50"))


def test_partition_function_and_parallelism(spark):
    def double(batches):
        for pdf in batches:
            yield pdf.assign(x=pdf["x"] * 2)

    df = enrich_partitions(spark.range(10).withColumnRenamed("id", "x"), double, "x bigint", partitions=3)
    assert df.rdd.getNumPartitions() == 3 and df.agg(F.sum("x")).first()[0] == 90


def test_explanations_once_per_issue(rows):
    schema = "issue_id string, entity string, column_name string, issue_type string, severity string, affected_records bigint, issue_description string"
    events = rows([("I-1", "cars", "fuel", "T", "LOW", 3, "d")] * 4 + [("I-2", "cars", None, "T", "LOW", 1, "d")], schema)

    def make():
        def call(prompt):
            if "Column: None" in prompt:
                raise ValueError("no column")
            return json.dumps([{"type": "text", "text": "because"}])

        return call

    got = {r.issue_id: r for r in explain.dq_explanations(events, make, "m").collect()}
    assert len(got) == 2
    assert (got["I-1"].ai_explanation, got["I-1"].generation_status) == ("because", "SUCCESS")
    assert (got["I-2"].ai_explanation, got["I-2"].generation_status) == ("no column", "FAILED")
    assert got["I-1"].generated_at is not None


def test_summaries(rows):
    policy = rows([(Decimal("10.50"), "OH"), (Decimal("20.00"), "IN")], "policy_annual_premium decimal(10,2), policy_state string")
    got = kpi.domain_summaries({"policy": kpi.policy_kpis(policy)}, lambda: (lambda p: "plain answer"), "m").first()
    assert json.loads(got.kpi_data) == {"total_policies": 2, "avg_premium": 15.25, "total_premium": 30.5, "policy_types": 2}
    assert (got.summary_title, got.ai_summary) == ("policy Executive Summary", "plain answer")


def test_kpis_of_empty_tables(rows):
    empty = rows([], "policy_annual_premium decimal(10,2), policy_state string")
    assert json.loads(kpi.kpi_json(kpi.policy_kpis(empty)).first()[0]) == {
        "total_policies": 0, "avg_premium": None, "total_premium": None, "policy_types": 0,
    }
