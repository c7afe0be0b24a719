import json

import pytest

from medallion.plans.entities import unify_customers
from medallion.sources.files import (
    evolve,
    header_groups,
    infer_schema,
    read_csv_by_header,
    read_csv_stream,
    read_json,
)
from medallion.sources.lookups import region_mapper
from medallion.streaming.jobs import ingest_csv, read_batches, run_append


@pytest.fixture
def customers(tmp_path):
    """Files of one entity: two share a header, one has others, one lies in a subfolder, one is foreign."""
    (tmp_path / "sub").mkdir()
    (tmp_path / "customers_1.csv").write_text("CustomerID,Reg,City\n1,West,a\n2,East,b\n")
    (tmp_path / "customers_3.csv").write_text("CustomerID,Reg,City\n3,South,c\n")
    (tmp_path / "sub" / "customers_2.csv").write_text('City_in_state,cust_id,Region\n"d, e",4,W\n,,\n')
    (tmp_path / "sales_1.csv").write_text("sales_id\n7\n")
    return tmp_path


def test_headers_are_grouped(spark, customers):
    groups = header_groups(spark, str(customers), "customers_*.csv")
    assert sorted((tuple(n), len(p)) for n, p in groups) == [
        (("City_in_state", "cust_id", "Region"), 1),
        (("CustomerID", "Reg", "City"), 2),
    ]


def test_columns_are_matched_by_name(spark, customers):
    df = read_csv_by_header(spark, str(customers), "customers_*.csv")
    got = {(r.CustomerID, r.cust_id, r.Region, r.City_in_state, r.source_file) for r in df.collect()}
    assert got == {
        ("1", None, None, None, "customers_1.csv"),
        ("2", None, None, None, "customers_1.csv"),
        ("3", None, None, None, "customers_3.csv"),
        (None, "4", "W", "d, e", "customers_2.csv"),
        (None, None, None, None, "customers_2.csv"),
    }
    assert all(r.ingestion_timestamp for r in df.collect())


def test_types_may_be_inferred(spark, customers):
    df = read_csv_by_header(spark, str(customers), "customers_*.csv", infer=True)
    assert dict(df.dtypes)["CustomerID"] == "int"
    assert infer_schema(spark, str(customers), "sales*.csv", "csv").simpleString() == "struct<sales_id:int>"


def test_no_matching_file_is_an_error(spark, customers):
    with pytest.raises(FileNotFoundError):
        read_csv_by_header(spark, str(customers), "policy*.csv")


def test_windows_line_ends_and_byte_order_mark(spark, tmp_path):
    (tmp_path / "cars_1.csv").write_bytes("﻿car_id,name\r\n1,a\r\n".encode())
    assert header_groups(spark, str(tmp_path), "cars*.csv")[0][0] == ["car_id", "name"]
    assert [(r.car_id, r.name) for r in read_csv_by_header(spark, str(tmp_path), "cars*.csv").collect()] == [("1", "a")]


def test_incremental_ingest_takes_each_file_once_and_evolves(spark, customers, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    target, checkpoint = str(out / "bronze"), str(out / "checkpoint")
    ingest_csv(spark, str(customers), "customers_*.csv", target, checkpoint, max_files=2)
    first = read_batches(spark, target)
    assert first.count() == 5 and "Edu" not in first.columns
    (customers / "customers_4.csv").write_text("Edu,CustomerID\nprimary,9\n")
    ingest_csv(spark, str(customers), "customers_*.csv", target, checkpoint, max_files=2)
    second = read_batches(spark, target)
    assert second.count() == 6
    assert [r.CustomerID for r in second.filter("Edu is not null").collect()] == ["9"]
    ingest_csv(spark, str(customers), "customers_*.csv", target, checkpoint, max_files=2)
    assert read_batches(spark, target).count() == 6


def test_ingested_customers_can_be_unified(spark, customers):
    df = read_csv_by_header(spark, str(customers), "customers_*.csv")
    for missing in ("State", "Default", "Balance", "HHInsurance", "CarLoan", "Job"):
        from pyspark.sql import functions as F

        df = df.withColumn(missing, F.lit(None).cast("string"))
    got = {(r.customer_id, r.region, r.city) for r in unify_customers(df, region_mapper(spark)).collect()}
    assert got == {(1, "West", "a"), (2, "East", "b"), (3, "South", "c"), (4, "West", "d, e"), (None, None, None)}


def test_stream_of_files_with_one_header(spark, tmp_path, tmp_path_factory):
    (tmp_path / "sales_1.csv").write_text("sales_id,price\n1,5\n,\n")
    schema = infer_schema(spark, str(tmp_path), "sales*.csv", "csv")
    out = tmp_path_factory.mktemp("out")
    for expected in (2, 3):
        run_append(read_csv_stream(spark, str(tmp_path), "sales*.csv", schema), str(out / "t"), str(out / "c"))
        assert spark.read.parquet(str(out / "t")).count() == expected
        (tmp_path / "sales_2.csv").write_text("sales_id,price\n3,7\n")


def test_json_over_several_lines(spark, tmp_path, tmp_path_factory):
    (tmp_path / "claims_1.json").write_text(json.dumps([{"ClaimID": 1, "injury": "5"}, {"ClaimID": 2}], indent=2))
    (tmp_path / "claims_2.json").write_text(json.dumps([{"ClaimID": 3, "vehicle": "7"}], indent=2))
    (tmp_path / "cars_1.csv").write_text("car_id\n1\n")
    df = read_json(spark, str(tmp_path), "claims_*.json")
    got = sorted((r.ClaimID, r.injury, r.vehicle, r.source_file) for r in df.collect())
    assert got == [(1, "5", None, "claims_1.json"), (2, None, None, "claims_1.json"), (3, None, "7", "claims_2.json")]
    out = tmp_path_factory.mktemp("out")
    run_append(read_json(spark, str(tmp_path), "claims_*.json", stream=True), str(out / "t"), str(out / "c"))
    assert spark.read.parquet(str(out / "t")).count() == 3


def test_evolve_fills_missing_columns(rows):
    got = evolve(rows([(1,)], "a int"), rows([(2, "x")], "a int, b string")).collect()
    assert sorted(map(tuple, got)) == [(1, None), (2, "x")]
