"""Files that come late: the kept row, its events, its dimension row and the counts follow."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from medallion import jobs
from medallion.operators.quality import expect_or_drop, expectation_metrics, quarantine
from medallion.plans import dq_log, star
from medallion.plans.rulebook import EXPECTATIONS, QUARANTINE
from medallion.sources import versions
from medallion.streaming.upserts import CHANGED, fold, read_upserts, run_upserts
from queries.bronze import bronze
from tests.test_jobs import bag, write_raw

DROPPED = ("ingestion_timestamp", "md_created_datetime", CHANGED)


def held(df):
    return Counter(map(str, df.drop(*DROPPED).select(*sorted(set(df.columns) - set(DROPPED))).collect()))


class Feed:
    """Batches of (key, value); the smallest value of a key is kept."""

    def __init__(self, spark, folder):
        self.spark, self.raw, self.target, self.checkpoint = spark, folder / "raw", str(folder / "t"), str(folder / "c")
        self.rows = []

    def deliver(self, rows, **options):
        self.rows += rows
        self.spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").parquet(str(self.raw))
        stream = self.spark.readStream.schema("k string, v int").parquet(str(self.raw))
        return run_upserts(stream.groupBy("k").agg(F.min("v").alias("v")), self.target, self.checkpoint, ["k"], 2, **options)

    def kept(self):
        found = read_upserts(self.spark, self.target, ["k"]).select("k", "v").collect()
        assert len({r.k for r in found}) == len(found)
        return {r.k: r.v for r in found}

    def expected(self):
        return {k: min(v for j, v in self.rows if j == k) for k, _ in self.rows}


def test_a_late_row_replaces_the_one_before(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.deliver([("a", 5), ("b", 2), (None, 9), ("hot", 50)] + [("hot", i) for i in range(60, 2000)])
    assert feed.kept() == feed.expected()
    feed.deliver([("a", 3), ("b", 4), (None, 1), ("new", 0)])
    assert feed.kept() == feed.expected() == {"a": 3, "b": 2, None: 1, "hot": 50, "new": 0}


def test_folding_changes_nothing_for_readers(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for n, rows in enumerate([[("a", 5), ("b", 2)], [("a", 3)], [("c", 1), ("b", 1)], [("a", 1), ("d", 7)]]):
        feed.deliver(rows, fold_after=1)
        assert feed.kept() == feed.expected(), n
    assert versions.published(spark, f"{feed.target}/base")
    held_before = read_upserts(spark, feed.target, ["k"])
    assert not fold(spark, feed.target, ["k"]) or feed.kept() == feed.expected()
    assert held_before.count() == 4


def test_a_batch_that_did_not_finish_is_not_read(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.deliver([("a", 5)])
    spark.createDataFrame([("a", 1)], "k string, v int").withColumn(CHANGED, F.current_timestamp()).write.parquet(f"{feed.target}/changes/_batch=7")
    (tmp_path / "t" / "changes" / "_batch=7" / "_SUCCESS").unlink()
    assert feed.kept() == {"a": 5}
    with pytest.raises(FileNotFoundError):
        read_upserts(spark, str(tmp_path / "nothing"), ["k"])


def test_late_customer_files_correct_the_whole_chain(spark, sf_dir, tmp_path):
    """Files come in an order that makes most first rows wrong; after each run the tables equal the batch plans."""
    raw = tmp_path / "raw"
    raw.mkdir()
    late = write_raw(spark, sf_dir, raw)
    first = [raw / f"customers_{n}.csv" for n in (1, 3)]
    late |= {f.name: f.read_text() for f in first}
    for f in first:
        f.unlink()
    (raw / "customers_7.csv").write_text(late.pop("customers_7.csv"))
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    here = ["customers_4.csv", "customers_5.csv", "customers_6.csv", "customers_7.csv"]
    moved = []
    for files in ([], ["customers_2.csv", "customers_3.csv", "claims_2.json"], ["customers_1.csv"]):
        for name in files:
            (raw / name).write_text(late.pop(name))
        here += files
        jobs.ingest_bronze(lake, str(raw))
        jobs.build_silver(lake)
        jobs.log_issues(lake)
        jobs.build_gold(lake)
        source = bronze(spark, sf_dir, "customers").filter(F.col("source_file").isin(here))
        cleaned = jobs.clean_entity(spark, "customers", source)
        good, bad = expect_or_drop(cleaned, EXPECTATIONS["customers"]), quarantine(cleaned, "customers", QUARANTINE["customers"])
        assert held(lake.silver("customers")) == held(good)
        assert held(lake.quarantine("customers").drop("_dq_detected_at")) == held(bad.drop("_dq_detected_at"))
        assert held(lake.read("gold", "dim_customer")) == held(star.dim_customer(good))
        events = lake.read("silver", "quality_issues_log").filter("entity = 'customers'").drop("_dq_detected_at")
        assert held(events) == held(dq_log.quality_log({"customers": bad}).drop("_dq_detected_at"))
        assert lake.read("silver", "dq_issues").filter("entity = 'customers'").count() == events.count()
        counters = dq_log.issue_counters(dq_log.quality_log({"customers": bad}), dq_log.rule_bridge(spark))
        live = lake.stats().filter("entity = 'customers'")
        assert held(live.select("issue_id", "affected_records")) == held(counters.select("issue_id", "affected_records"))
        moved.append(held(lake.silver("customers")))
    assert sum((moved[0] - moved[1]).values()) > 0  # rows were replaced, not only added

    counted = {(r.entity, r.rule): (r.action, r.passed, r.failed) for r in lake.expectations().collect()}
    for entity in jobs.ENTITIES:
        frame = jobs.clean_entity(spark, entity, bronze(spark, sf_dir, entity))
        for r in expectation_metrics(frame, EXPECTATIONS[entity]).collect():
            assert counted.pop((entity, r.rule)) == (r.action, r.passed, r.failed), (entity, r.rule)
    assert not counted
    # Nothing new: a further run counts nothing twice.
    again = held(lake.expectations())
    jobs.build_silver(lake)
    assert held(lake.expectations()) == again
