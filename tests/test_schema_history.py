"""Raw feeds whose types drift: values survive, tables stay readable, history is not read again."""

import json

import pytest
from pyspark.sql import types as T

from medallion import jobs
from medallion.sources.schemas import RESCUED, SchemaHistory, merge, widen
from medallion.streaming.jobs import ingest_feed


def ddl(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize(
    "old, new, wide",
    [
        ("int", "bigint", "bigint"),
        ("int", "double", "double"),
        ("bigint", "double", "decimal(38,18)"),
        ("bigint", "string", "bigint"),
        ("string", "bigint", "string"),
        ("double", "bigint", "double"),
        ("float", "double", "double"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("decimal(10,2)", "bigint", "decimal(22,2)"),
        ("decimal(38,18)", "double", "decimal(38,18)"),
        ("boolean", "string", "boolean"),
        ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("array<int>", "string", "array<int>"),
    ],
)
def test_widening(spark, old, new, wide):
    assert widen(ddl(old), ddl(new)).simpleString() == wide


def test_merge_adds_columns_and_ignores_case(spark):
    old, new = ddl("ClaimID bigint, injury bigint"), ddl("claimid double, Extra string")
    assert merge(old, new).simpleString() == "struct<ClaimID:decimal(38,18),injury:bigint,Extra:string>"
    assert merge(merge(old, new), new) == merge(old, new)


class Feed:
    def __init__(self, spark, folder, glob, **options):
        (folder / "raw").mkdir()
        self.spark, self.raw, self.glob, self.options = spark, folder / "raw", glob, options
        self.target, self.checkpoint = str(folder / "bronze"), str(folder / "checkpoint")
        self.history = SchemaHistory(spark, str(folder / "schema"))

    def deliver(self, name, content):
        (self.raw / name).write_text(content if isinstance(content, str) else json.dumps(content, indent=1))
        ingest_feed(self.spark, str(self.raw), self.glob, self.target, self.checkpoint, self.history, **self.options)

    def rows(self):
        return self.spark.read.schema(self.history.table_schema()).parquet(self.target).collect()


def rescued(row):
    return None if row[RESCUED] is None else {k: v for k, v in json.loads(row[RESCUED]).items() if k != "_file_path"}


def test_number_then_text_then_more_columns(spark, tmp_path):
    feed = Feed(spark, tmp_path, "claims_*.json")
    feed.deliver("claims_1.json", [{"ClaimID": 1, "injury": 500}, {"ClaimID": 2, "injury": None}])
    feed.deliver("claims_2.json", [{"ClaimID": "3", "injury": "unknown"}, {"ClaimID": "C-4", "injury": "70"}])
    feed.deliver("claims_3.json", [{"ClaimID": 5, "injury": 7.25, "Extra": {"a": [1]}}, {"claimid": 6, "injury": True}])
    got = {r["source_file"] + str(i): (None if r.ClaimID is None else int(r.ClaimID), None if r.injury is None else float(r.injury), rescued(r)) for i, r in enumerate(sorted(feed.rows(), key=lambda r: (r["source_file"], str(r["ClaimID"]))))}
    assert list(got.values()) == [
        (1, 500.0, None),
        (2, None, None),
        (3, None, {"injury": "unknown"}),
        (None, 70.0, {"ClaimID": "C-4"}),
        (5, 7.25, None),
        (6, None, {"injury": "true"}),
    ]
    assert [len(json.loads(v["schema"])["fields"]) for v in feed.history.rows()] == [2, 3]
    assert dict(zip(feed.history.latest().names, [f.dataType.simpleString() for f in feed.history.latest()]))["injury"] in ("bigint", "decimal(38,18)")


def test_history_is_not_read_again(spark, tmp_path):
    """Files of earlier deliveries may be gone when the next one comes."""
    feed = Feed(spark, tmp_path, "claims_*.json")
    feed.deliver("claims_1.json", [{"a": 1}])
    (feed.raw / "claims_1.json").unlink()
    feed.deliver("claims_2.json", [{"a": 2.5, "b": "x"}])
    assert sorted((float(r["a"]), r["b"]) for r in feed.rows()) == [(1.0, None), (2.5, "x")]


def test_nothing_new_makes_no_version(spark, tmp_path):
    feed = Feed(spark, tmp_path, "claims_*.json")
    feed.deliver("claims_1.json", [{"a": 1, "b": "x"}])
    feed.deliver("claims_2.json", [{"b": "y"}])
    feed.deliver("claims_3.json", "[]")
    assert len(feed.history.rows()) == 1 and len(feed.rows()) == 2
    assert feed.history.extend(ddl("a bigint")) == feed.history.latest() and len(feed.history.rows()) == 1


def test_broken_records_are_rescued(spark, tmp_path):
    feed = Feed(spark, tmp_path, "claims_*.json")
    feed.deliver("claims_1.json", [{"a": 1}])
    feed.deliver("claims_2.json", '{"a": 2, "b": ')
    rows = sorted(feed.rows(), key=lambda r: r["source_file"])
    assert rows[0]["a"] == 1 and rows[1]["a"] is None
    assert json.loads(rows[1][RESCUED])["_corrupt_record"].startswith('{"a": 2')


def test_nested_values(spark, tmp_path):
    feed = Feed(spark, tmp_path, "claims_*.json")
    feed.deliver("claims_1.json", [{"place": {"city": "x", "zip": 7}, "tags": [1, 2]}])
    feed.deliver("claims_2.json", [{"place": {"city": "y", "zip": "A1", "floor": 2}, "tags": [3]}])
    old, new = sorted(feed.rows(), key=lambda r: r["source_file"])
    assert (old["place"]["zip"], old["place"]["floor"], old["tags"], old[RESCUED]) == (7, None, [1, 2], None)
    assert new["place"]["city"] == "y" and new["place"]["floor"] == 2 and new["tags"] == [3]
    assert json.loads(json.loads(new[RESCUED])["place"]) == {"city": "y", "zip": "A1", "floor": 2}


def test_csv_with_types(spark, tmp_path):
    feed = Feed(spark, tmp_path, "cars*.csv", infer=True)
    feed.deliver("cars_1.csv", "id,price,name\n1,2.5,a\n2,3,b\n")
    feed.deliver("cars_2.csv", "price,id,colour\nfree,3,red\n4,007,blue\n1,5\n")
    assert feed.history.latest().simpleString() == "struct<id:bigint,price:double,name:string,colour:string>"
    got = sorted(((r["id"], r["price"], r["colour"]) for r in feed.rows()), key=str)
    assert got == sorted([(1, 2.5, None), (2, 3.0, None), (3, None, "red"), (None, 4.0, "blue"), (5, 1.0, None)], key=str)
    lost = {tuple(sorted(rescued(r).items())) for r in feed.rows() if r[RESCUED]}
    assert lost == {(("price", "free"),), (("id", "007"),), (("_corrupt_record", "1,5"),)}


def test_large_numbers_stay_exact(spark, tmp_path):
    feed = Feed(spark, tmp_path, "claims_*.json", multi_line=False)
    feed.deliver("claims_1.json", '{"a": 0.5}\n{"a": 9007199254740993}\n{"a": 9007199254740992}\n')
    got = sorted(((r["a"], rescued(r)) for r in feed.rows()), key=str)
    assert got == sorted([(0.5, None), (None, {"a": "9007199254740993"}), (9007199254740992.0, None)], key=str)


def test_silver_runs_on_over_drifting_claims(spark, tmp_path):
    """Number in the first file, text in the second, one more column in the third."""
    raw = tmp_path / "raw"
    raw.mkdir()
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    base = {"Claim_Logged_On": "2020-01-02", "Claim_Processed_On": "NULL", "incident_date": "2020-01-01", "Claim_Rejected": "N", "PolicyID": 9}
    for k in "authorities_contacted bodily_injuries collision_type incident_city incident_location incident_severity incident_state incident_type number_of_vehicles_involved police_report_available property property_damage vehicle witnesses".split():
        base[k] = "1"
    for n, row in enumerate([{"ClaimID": 1, "injury": 500}, {"ClaimID": 2, "injury": "none"}, {"ClaimID": 3, "injury": "80.5", "adjuster": "x"}]):
        (raw / f"claims_{n}.json").write_text(json.dumps([base | row]))
        jobs.ingest_bronze(lake, str(raw))
        jobs.build_silver(lake)
    assert sorted((r.claim_id, None if r.injury is None else float(r.injury)) for r in lake.silver("claims").collect()) == [(1, 500.0), (2, None), (3, 80.5)]
    bronze = {int(r.ClaimID): r for r in lake.read("bronze", "claims").collect()}
    assert json.loads(bronze[2][RESCUED])["injury"] == "none" and bronze[3][RESCUED] is None
    assert bronze[3].adjuster == "x" and bronze[1].adjuster is None
