from pyspark.sql import Observation
from pyspark.sql import functions as F

from medallion.operators.quality import (
    DROP,
    Expectation,
    QuarantineRule,
    expect_or_drop,
    expectation_metrics,
    observe_expectations,
    quarantine,
    split_quality,
    tag_quality,
)
from medallion.plans.rulebook import ENTITIES, EXPECTATIONS, QUARANTINE, RULE_BRIDGE
from queries.registry import parsed

RULES = (Expectation("known", "x IS NOT NULL", DROP), Expectation("positive", "x > 0", DROP), Expectation("small", "x < 5"))


def test_rule_counts():
    assert [len(QUARANTINE[e]) for e in ENTITIES] == [6, 8, 11, 6, 5]
    assert len(RULE_BRIDGE) == 36
    every = [r for e in ENTITIES for r in EXPECTATIONS[e]]
    assert sum(r.action == DROP for r in every) == 13 and len(every) == 33


def test_drop_rules_need_true(rows):
    df = rows([(None,), (-1,), (3,), (9,)], "x int")
    assert sorted(r.x for r in expect_or_drop(df, RULES).collect()) == [3, 9]


def test_null_predicate_counts_as_failed(rows):
    df = rows([(None,), (-1,), (3,), (9,)], "x int")
    got = {r.rule: (r.action, r.passed, r.failed) for r in expectation_metrics(df, RULES).collect()}
    assert got == {"known": ("drop", 3, 1), "positive": ("drop", 2, 2), "small": ("warn", 2, 2)}


def test_metrics_observed_on_the_way(rows):
    seen = Observation()
    observe_expectations(rows([(None,), (3,)], "x int"), RULES, seen).count()
    assert seen.get == {"rows": 2, "known": 1, "positive": 1, "small": 1}


def test_label_that_no_clean_sales_row_can_reach(rows):
    df = rows([(None, 1, 10)], "sales_id bigint, car_id bigint, original_selling_price int")
    df = df.withColumn("ad_placed_on", F.lit(None)).withColumn("sold_before_listed", F.lit(True))
    assert quarantine(df, "sales", QUARANTINE["sales"]).first()["_dq_rule"] == "sales_id_not_null"


def test_label_that_no_clean_claim_can_reach(rows):
    schema = "claim_id bigint, policy_id bigint, claim_rejected string, injury int, collision_type string"
    df = rows([(1, 1, "maybe", 5, "x", "YES", "YES")], schema + ", police_report_available string, property_damage string")
    for flag in ("claim_logged_on_corrupted", "incident_date_corrupted", "claim_processed_on_corrupted", "injury_extreme_outlier"):
        df = df.withColumn(flag, F.lit(None).cast("boolean"))
    got = quarantine(df, "claims", QUARANTINE["claims"]).first()
    assert got["_dq_rule"] == "claim_rejected_invalid_value" and got["_entity"] == "claims"


def test_tagging_equals_the_two_way_split(spark, sf_dir):
    df = parsed(spark, sf_dir, "policy")
    clean, bad = split_quality(df, "policy", EXPECTATIONS["policy"], QUARANTINE["policy"])
    tagged = tag_quality(df, "policy", EXPECTATIONS["policy"], QUARANTINE["policy"])
    assert {r["_table"]: r["count"] for r in tagged.groupBy("_table").count().collect()} == {
        "clean": clean.count(),
        "quarantine": bad.count(),
    }


def test_four_way_split(spark, sf_dir):
    """Rows may be clean, quarantined, both (only a WARN rule broken) or neither (key not positive)."""
    df = parsed(spark, sf_dir, "policy")
    gate = F.coalesce(F.expr(" AND ".join(r.predicate for r in EXPECTATIONS["policy"] if r.action == DROP)), F.lit(False))
    label = F.expr(" OR ".join(f"({r.predicate})" for r in QUARANTINE["policy"]))
    cells = {
        (r["clean"], r["bad"]): r["count"]
        for r in df.groupBy(gate.alias("clean"), F.coalesce(label, F.lit(False)).alias("bad")).count().collect()
    }
    assert set(cells) == {(True, False), (False, True), (True, True), (False, False)}
    assert cells[(False, False)] == 1  # policy number 0: dropped without a label


def test_rule_order_is_kept(rows):
    rules = (QuarantineRule("first", "x > 0", "A"), QuarantineRule("second", "x > 1", "B"))
    assert quarantine(rows([(5,)], "x int"), "e", rules).first()["_dq_rule"] == "first"
