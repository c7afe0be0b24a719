"""Raw files to reports, in two instalments, against the batch plans over the same rows."""

import json
from collections import Counter

from pyspark.sql import functions as F

from medallion import jobs
from medallion.plans import anomaly, entities, star, views
from medallion.operators.quality import expect_or_drop, quarantine
from medallion.plans.rulebook import EXPECTATIONS, QUARANTINE
from queries.bronze import bronze
from queries.registry import offline_writer

AS_OF = "2001-09-01"
HEADERS = {
    2: ["Customer_ID", "cust_id", "Region", "City_in_state", "Marital", "Edu", "State", "Default", "Balance"],
    4: ["State", "Default", "Balance", "Region", "CustomerID", "Reg", "City", "Marital_status"],
    0: ["CustomerID", "Reg", "Region", "City", "Marital_status", "Education", "State", "Default", "Balance"],
}
ALWAYS = ["HHInsurance", "CarLoan", "Job"]


def bag(df, *columns):
    return Counter(map(str, df.select(*columns).collect()))


def write_csv(df, path, columns):
    rows = df.select(*columns).toPandas()
    rows.to_csv(path, index=False)


def write_raw(spark, sf_dir, raw):
    """The test inputs as raw files; returns what must be held back for the second instalment."""
    customers = bronze(spark, sf_dir, "customers").withColumnRenamed("DefaultFlag", "Default")
    for n in range(1, 8):
        rows = customers.filter(F.col("source_file") == f"customers_{n}.csv")
        write_csv(rows, raw / f"customers_{n}.csv", [*HEADERS.get(n, HEADERS[0]), *ALWAYS])
    for entity in ("cars", "policy", "sales"):
        df = bronze(spark, sf_dir, entity).drop("source_file", "ingestion_timestamp")
        write_csv(df.select([F.col(c).cast("string") for c in df.columns]), raw / f"{entity}_1.csv", df.columns)
    claims = bronze(spark, sf_dir, "claims").drop("source_file", "ingestion_timestamp")
    records = [r.asDict() for r in claims.collect()]
    half = len(records) // 2
    (raw / "claims_1.json").write_text(json.dumps(records[:half], indent=1))
    late = {"claims_2.json": json.dumps(records[half:], indent=1)}
    for name in ("customers_7.csv", "customers_2.csv"):
        late[name] = (raw / name).read_text()
        (raw / name).unlink()
    return late


def test_two_instalments(spark, sf_dir, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    late = write_raw(spark, sf_dir, raw)
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    jobs.run_all(lake, str(raw), AS_OF)
    first = lake.silver("claims").count()
    for name, text in late.items():
        (raw / name).write_text(text)
    jobs.run_all(lake, str(raw), AS_OF)
    assert 0 < first < lake.silver("claims").count()

    def silver(entity):
        cleaned = jobs.clean_entity(spark, entity, bronze(spark, sf_dir, entity))
        return expect_or_drop(cleaned, EXPECTATIONS[entity])

    policy, claims = silver("policy"), silver("claims")
    assert bag(lake.silver("customers"), "customer_id") == bag(silver("customers"), "customer_id")
    for entity in ("cars", "policy", "sales", "claims"):
        columns = [c for c in silver(entity).columns if c not in ("source_file", "ingestion_timestamp")]
        assert bag(lake.silver(entity), *columns) == bag(silver(entity), *columns), entity
    assert bag(lake.read("gold", "fact_claims"), "claim_id", "customer_id") == bag(
        star.fact_claims(claims, policy), "claim_id", "customer_id"
    )
    assert bag(lake.read("gold", "dim_car"), "car_id", "model") == bag(silver("cars"), "car_id", "model")
    assert bag(lake.read("gold", "aging_buckets"), "*") == bag(
        views.aging_buckets(star.fact_sales(silver("sales")), AS_OF), "*"
    )
    report = ["Claim_ID", "anomaly_score", "priority", "triggered_rules"]
    expected = anomaly.anomaly_report(anomaly.score_claims(claims))
    assert bag(lake.read("gold", "claim_anomaly_explanations"), *report) == bag(expected, *report)
    unified = entities.unify_customers(bronze(spark, sf_dir, "customers"), jobs.region_mapper(spark))
    assert bag(lake.read("gold", "multi_region_customers"), "*") == bag(views.multi_region_customers(unified), "*")

    events = lake.read("silver", "quality_issues_log")
    assert events.count() == sum(lake.quarantine(e).count() for e in jobs.ENTITIES)
    assert lake.read("silver", "dq_issues").count() == events.count()
    live = {r.issue_id: r for r in lake.stats().collect()}
    distinct = lake.quarantine("policy").filter("_dq_rule = 'premium_non_positive'").count()
    assert live["DQ-POL-004"].affected_records >= distinct > 0
    assert live["DQ-CLMS-002"].fix_status == "UNRESOLVABLE"
    assert live["DQ-CLMS-002"].silver_total_rows == lake.silver("claims").count()

    jobs.explain_all(lake, offline_writer, "offline")
    texts = {r.issue_id: r for r in lake.read("gold", "dq_explanation_report").collect()}
    assert lake.read("gold", "dq_explanation_report").count() == len(texts) == len(live)
    assert all(texts[i].affected_records == live[i].affected_records for i in live)
    assert lake.read("gold", "ai_business_insights").count() == 3


def test_one_feed_alone(spark, sf_dir, tmp_path):
    """Only cars have arrived; statistics and reports do without the rest."""
    raw = tmp_path / "raw"
    raw.mkdir()
    cars = bronze(spark, sf_dir, "cars").drop("source_file", "ingestion_timestamp")
    text = cars.select([F.col(c).cast("string") for c in cars.columns])
    write_csv(text.limit(40), raw / "cars_1.csv", cars.columns)
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    jobs.run_all(lake, str(raw), AS_OF)
    assert lake.read("gold", "dim_car").count() > 0 and not lake.has("gold", "fact_sales")
    assert 0 < lake.silver("cars").count() <= 40


def test_stray_files_and_fresh_totals(spark, sf_dir, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    policy = bronze(spark, sf_dir, "policy").drop("source_file", "ingestion_timestamp")
    text = policy.select([F.col(c).cast("string") for c in policy.columns])
    good = clean_ids(spark, sf_dir, "policy")
    write_csv(text, raw / "policy_1.csv", policy.columns)
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    jobs.run_all(lake, str(raw), AS_OF)
    before, rows = {r.issue_id: r for r in lake.stats().collect()}, lake.silver("policy").count()
    # A file that no batch has committed is not there for anyone.
    sink = tmp_path / "lake" / "silver" / "policy" / "_table=clean"
    stray = next(p for p in sink.iterdir() if p.suffix == ".parquet")
    (sink / "part-99999-stray.snappy.parquet").write_bytes(stray.read_bytes())
    # Clean rows only in the second instalment: no event, yet the totals move.
    write_csv(text.join(good, "policy_number", "left_semi").limit(30), raw / "policy_2.csv", policy.columns)
    jobs.run_all(lake, str(raw), AS_OF)
    after, now = {r.issue_id: r for r in lake.stats().collect()}, lake.silver("policy").count()
    assert now > rows and lake.read("gold", "dim_policy").count() <= now
    for issue, row in after.items():
        assert row.silver_total_rows == now and row.affected_records >= before[issue].affected_records


def clean_ids(spark, sf_dir, entity):
    """Keys of rows that no rule complains about."""
    cleaned = jobs.clean_entity(spark, entity, bronze(spark, sf_dir, entity))
    kept = expect_or_drop(cleaned, EXPECTATIONS[entity])
    return kept.join(quarantine(cleaned, entity, QUARANTINE[entity]).select("policy_number"), "policy_number", "left_anti").select("policy_number")


def test_policy_delivered_twice_makes_one_fact(spark, sf_dir):
    claims = expect_or_drop(jobs.clean_entity(spark, "claims", bronze(spark, sf_dir, "claims")), EXPECTATIONS["claims"])
    policy = jobs.clean_entity(spark, "policy", bronze(spark, sf_dir, "policy"))
    twice = star.fact_claims(claims, policy.unionByName(policy))
    assert bag(twice, "claim_id", "customer_id") == bag(star.fact_claims(claims, policy), "claim_id", "customer_id")
    assert twice.count() == claims.count()


def test_both_flag_headers(spark, sf_dir):
    raw = bronze(spark, sf_dir, "customers")
    both = raw.withColumn("Default", F.lit(None).cast("string"))
    region = jobs.region_mapper(spark)
    assert bag(entities.unify_customers(both, region), "default_flag") == bag(entities.unify_customers(raw, region), "default_flag")
    neither = entities.unify_customers(raw.drop("DefaultFlag"), region)
    assert neither.filter("default_flag is not null").count() == 0
