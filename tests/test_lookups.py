"""Lookups that jobs read: changed by analysts, checked before they are stored."""

import pytest
from pyspark.sql import functions as F

from medallion import jobs
from medallion.plans.catalogue import ISSUE_ROWS
from medallion.plans.rulebook import RULE_BRIDGE


@pytest.fixture
def lake(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    return jobs.Lake(spark, str(tmp_path / "lake"))


def test_lookups_begin_with_the_rows_in_code(lake):
    assert lake.lookup("dq_rule_mapping").count() == len(RULE_BRIDGE) == 36
    assert lake.lookup("dq_issue_catalogue").count() == len(ISSUE_ROWS) == 38
    assert lake.lookup("region_mapper").filter("md_created_datetime IS NULL").count() == 0


def test_refused_rows(lake, rows):
    good = rows([("N", "North")], "reg_coded string, reg_mapped string")
    with pytest.raises(ValueError, match="unique"):
        lake.set_lookup("region_mapper", good.unionByName(rows([(" n", "Nord")], "reg_coded string, reg_mapped string")))
    with pytest.raises(ValueError, match="NULL"):
        lake.set_lookup("region_mapper", rows([("N", None)], "reg_coded string, reg_mapped string"))
    with pytest.raises(ValueError, match="missing"):
        lake.set_lookup("region_mapper", good.drop("reg_mapped"))
    assert lake.lookup("region_mapper").count() == 8


def test_jobs_follow_changed_lookups(lake, spark, tmp_path):
    header = "CustomerID,Reg,City,Marital_status,Education,State,Default,Balance,HHInsurance,CarLoan,Job\n"
    line = "{},{},c,single,primary,s,0,10.5,0,0,j\n"
    (tmp_path / "raw" / "customers_1.csv").write_text(header + line.format(1, "N") + line.format(2, "W"))
    jobs.run_all(lake, str(tmp_path / "raw"), "2024-01-01")
    assert {(r.customer_id, r.region) for r in lake.silver("customers").collect()} == {(1, "N"), (2, "West")}
    bad = lake.stats().filter("entity = 'customers'").collect()
    assert [r.affected_records for r in bad] == [1]

    regions = lake.lookup("region_mapper").select("reg_coded", "reg_mapped")
    lake.set_lookup("region_mapper", regions.unionByName(spark.createDataFrame([("N", "North")], "reg_coded string, reg_mapped string")))
    catalogue = lake.lookup("dq_issue_catalogue")
    lake.set_lookup("dq_issue_catalogue", catalogue.withColumn("severity", F.lit("URGENT")))
    (tmp_path / "raw" / "customers_2.csv").write_text(header + line.format(3, "N"))
    jobs.run_all(lake, str(tmp_path / "raw"), "2024-01-01")
    assert {(r.customer_id, r.region) for r in lake.silver("customers").collect()} == {(1, "N"), (2, "West"), (3, "North")}
    assert {r.severity for r in lake.read("silver", "dq_issues").collect()} == {"URGENT"}
