import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.plans import dq_log
from medallion.plans.catalogue import ISSUE_ROWS, ISSUE_SCHEMA, issue_catalogue
from medallion.plans.rulebook import RULE_BRIDGE
from medallion.sources.lookups import REGION_ROWS, REGION_SCHEMA, create_lookup, fill_lookup
from medallion.sources.tables import read_table, refresh_view, write_append, write_overwrite

NOW = datetime.datetime(2024, 1, 1)
LOG = "entity string, _dq_rule string, record_id string, source_file string, _dq_detected_at timestamp"


def events(rows, *items):
    return rows([(e, r, i, "f.csv", NOW) for e, r, i in items], LOG)


def stats(spark, rows, log, totals):
    counts = rows(totals, "entity string, total_rows bigint")
    got = dq_log.issue_stats(log, dq_log.rule_bridge(spark), counts, issue_catalogue(spark))
    return {r.issue_id: r for r in got.collect()}


def test_catalogue(spark):
    df = issue_catalogue(spark)
    assert {r.entity: r["count"] for r in df.groupBy("entity").count().collect()} == {
        "customers": 11, "cars": 8, "claims": 10, "policy": 4, "sales": 5,
    }
    by_status = {r.fix_status: r["count"] for r in df.groupBy("fix_status").count().collect()}
    assert by_status == {"UNRESOLVABLE": 3, "PARTIAL": 1, "FLAGGED": 5, "RESOLVED": 29}
    assert {i for _, _, i in RULE_BRIDGE} <= {r[0] for r in ISSUE_ROWS}
    assert df.filter("severity = 'CRITICAL' AND entity = 'claims'").count() == 3


def test_distinct_records_and_percentage(spark, rows):
    log = events(rows, *[("policy", "premium_non_positive", i) for i in ("1", "1", "2", None)])
    got = stats(spark, rows, log, [("policy", 3)])["DQ-POL-004"]
    assert (got.affected_records, got.affected_pct, got.fix_status, got.silver_total_rows) == (2, 66.67, "RESOLVED", 3)


def test_only_null_ids_means_resolved_unless_sticky(spark, rows):
    log = events(rows, ("policy", "policy_number_not_null", None), ("cars", "km_driven_negative", None), ("cars", "new_rule", None))
    got = stats(spark, rows, log, [("policy", 0)])
    assert got["DQ-POL-003"].affected_records == 0 and got["DQ-POL-003"].fix_status == "RESOLVED"
    assert got["DQ-POL-003"].affected_pct is None
    assert got["DQ-CARS-005"].fix_status == "FLAGGED"
    assert got["UNMAPPED-cars"].fix_status == "RESOLVED"


def test_unmapped_rule_keeps_its_unknown_status(spark, rows):
    got = stats(spark, rows, events(rows, ("cars", "new_rule", "5")), [("cars", 10)])
    assert got["UNMAPPED-cars"].fix_status is None and got["UNMAPPED-cars"].affected_pct == 10.0


def test_every_event_is_enriched(spark, rows):
    log = events(rows, ("cars", "fuel_unknown_type", "1"), ("cars", "fuel_unknown_type", "1"), ("cars", "new_rule", "2"))
    counts = rows([("cars", 4)], "entity string, total_rows bigint")
    bridge, catalogue = dq_log.rule_bridge(spark), issue_catalogue(spark)
    got = dq_log.enrich_issues(log, bridge, dq_log.issue_stats(log, bridge, counts, catalogue), catalogue).collect()
    assert len(got) == 3 and len(got[0]) == 17
    assert {(r.issue_id, r.column_name, r.affected_records, r._dq_table) for r in got} == {
        ("DQ-CARS-007", "fuel", 1, "silver_cars"),
        ("UNMAPPED-cars", None, 1, "silver_cars"),
    }


def test_status_rules(rows):
    df = rows([("PARTIAL", 0), ("RESOLVED", 3), ("OPEN", 0), (None, 0), (None, 1)], "s string, n bigint")
    got = [r[0] for r in df.select(dq_log.recompute_status(F.col("s"), F.col("n"))).collect()]
    assert got == ["PARTIAL", "RESOLVED", "RESOLVED", "RESOLVED", None]


def test_stored_lookup_tables(spark):
    for name, data, schema in (("region_lookup", REGION_ROWS, REGION_SCHEMA), ("issue_lookup", ISSUE_ROWS, ISSUE_SCHEMA)):
        for _ in range(2):
            create_lookup(spark, name, schema)
        fill_lookup(spark, name, data, schema)
        df = spark.table(name)
        assert df.count() == len(data)
        assert df.filter("md_created_datetime IS NULL").count() == 0
    assert isinstance(spark.table("issue_lookup").schema["affected_pct"].dataType, T.DoubleType)


def test_table_writers(spark, rows, tmp_path):
    for target in ("some_table", str(tmp_path / "t")):
        write_overwrite(rows([(1,)], "a int"), target)
        write_append(rows([(2,)], "a int"), target)
        assert sorted(r.a for r in read_table(spark, target).collect()) == [1, 2]
        view = refresh_view(spark, target, lambda s: s.range(3).select(F.col("id").cast("int").alias("a")))
        assert view.count() == 3
