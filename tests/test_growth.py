"""Work that must not grow faster than its input: no sort of wide rows, no text files written plainly."""

import gzip
import json
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql.streaming import StreamingQuery

from medallion.operators.quality import Expectation, QuarantineRule
from medallion.plans import star
from medallion.session import shared_dir
from medallion.sources.schemas import SchemaHistory
from medallion.sources.tables import stream_table
from medallion.streaming.jobs import ingest_feed, read_split, run_split
from queries.registry import drifting_claims


def test_split_keeps_a_file_open_per_table(spark, tmp_path, monkeypatch):
    """With room for more files than there are tables a task does not sort its rows by table."""
    setting, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    wait = StreamingQuery.awaitTermination
    monkeypatch.setattr(StreamingQuery, "awaitTermination", lambda q: (seen.append(int(spark.conf.get(setting))), wait(q))[1])
    source, target, checkpoint = (str(tmp_path / n) for n in ("s", "t", "c"))
    spark.createDataFrame([(i, -i if i % 3 else i) for i in range(40)], "id int, v int").coalesce(1).write.parquet(source)
    before = spark.conf.get(setting)
    run_split(
        stream_table(spark, source), "things", [Expectation("known", "id > 3", "drop")], [QuarantineRule("low", "v < 0", "1")], target, checkpoint
    )
    assert seen and seen[0] > 2 and spark.conf.get(setting) == before
    good, bad = read_split(spark, target)
    assert sorted(r.id for r in good.collect()) == list(range(4, 40))
    assert sorted(r.id for r in bad.collect()) == [i for i in range(40) if i % 3]
    assert len(list(Path(target).glob("_table=*/*.parquet"))) == 2


def test_compressed_json_lines(spark, tmp_path):
    folder, history = tmp_path / "raw", SchemaHistory(spark, str(tmp_path / "schema"))
    folder.mkdir()
    with gzip.open(folder / "claims_1.json.gz", "wt") as out:
        out.writelines(json.dumps(r) + "\n" for r in ({"a": 1, "b": "x"}, {"a": None, "b": "y"}))
    target = str(tmp_path / "t")
    ingest_feed(spark, str(folder), "claims_*.json.gz", target, str(tmp_path / "c"), history, multi_line=False)
    rows = spark.read.schema(history.table_schema()).parquet(target).collect()
    assert sorted(((r.a, r.b) for r in rows), key=str) == sorted([(1, "x"), (None, "y")], key=str)
    assert history.latest().simpleString() == "struct<a:bigint,b:string>"


def test_raw_claims_come_compressed(spark, sf_dir):
    root = Path(urlparse(shared_dir(spark)).path)
    known = set(root.glob("claim-files-*"))
    path, history = drifting_claims(spark, sf_dir)
    (folder,) = set(root.glob("claim-files-*")) - known
    files = list(folder.glob("*/part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    claims = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert spark.read.schema(history.table_schema()).parquet(path).count() == claims


def _claims(rows):
    own = ["claim_id long", "policy_id long", *(f"{c} string" for c in star.CLAIM_DETAILS), f"{star.INGESTED} string"]
    return rows([(c, p, *["x"] * len(star.CLAIM_DETAILS), "t") for c, p in ((1, 7), (2, 7), (3, 8), (4, None), (5, 9), (5, 9))], ", ".join(own))


def test_claims_are_not_sorted_for_their_policies(spark, rows, capsys):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        policy = rows([(7, 70), (7, 60), (8, None), (None, 5)], "policy_number long, customer_id long")
        facts = star.fact_claims(_claims(rows), policy)
        facts.explain()
        plan = capsys.readouterr().out
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        got = sorted(((r.claim_id, r.customer_id) for r in facts.collect()), key=str)
        assert got == [(1, 60), (2, 60), (3, None), (4, None), (5, None), (5, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
