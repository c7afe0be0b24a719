import pytest
from pyspark.sql import functions as F

from medallion.operators.aggregates import inconsistent_keys, zscore
from medallion.operators.dedupe import dedupe_first
from medallion.operators.joins import checked_lookup, lookup_expand, union_all, with_group_count
from medallion.sources.lookups import region_mapper


def test_dedupe_keeps_first_in_order_and_null_is_a_key(rows):
    df = rows([(1, "b", 1), (1, "a", 2), (None, "z", 3), (None, None, 4), (2, "c", 5)], "k int, f string, v int")
    got = sorted(r.v for r in dedupe_first(df, ["k"], ["f", "v"]).collect())
    assert got == [2, 4, 5]


def test_dedupe_reduces_before_the_shuffle(spark, capsys):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    dedupe_first(df, ["k"], ["id"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2


def test_lookup_fallback_is_upper_cased(spark, rows):
    df = rows([(" w",), ("East",), ("north ",), (None,)], "r string")
    got = [r.out for r in lookup_expand(df, region_mapper(spark), "r", "reg_coded", "reg_mapped", "out").collect()]
    assert sorted(got, key=str) == ["East", "NORTH", None, "West"]


def test_lookup_with_duplicate_keys_is_refused(rows):
    with pytest.raises(ValueError, match="not unique"):
        checked_lookup(rows([("w", 1), (" W", 2)], "k string, v int"), ["k"])


def test_lookup_is_broadcast_only_under_its_bound(spark, rows, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = rows([("w", 1), ("e", 2)], "k string, v int")
        for bound, join in ((10, "BroadcastHashJoin"), (1, "SortMergeJoin")):
            df = rows([("w",)], "code string").join(checked_lookup(lookup, ["k"], bound), F.col("code") == F.col("k"), "left")
            df.explain()
            assert join in capsys.readouterr().out
            assert df.first()["v"] == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_group_count_counts_null_keys_and_keeps_rows(rows):
    df = rows([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "k int, v string")
    got = {r.v: r.n for r in with_group_count(df, ["k"], "n").collect()}
    assert got == {"a": 2, "b": 2, "c": 2, "d": 2, "e": 1}


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_group_count_with_a_hot_key(spark, no_auto_broadcast):
    """A third of the rows share a key, another third of them the NULL key: both are served by broadcast."""
    key = F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, F.col("id"))
    df = spark.range(30_000).select(key.alias("k"), (F.col("id") % 2).alias("v"))
    counted = with_group_count(df, ["k"], "n", hot_keys=10)
    got = {(r.k is None, r.n): r["count"] for r in counted.groupBy("k", "n").count().groupBy(
        F.col("k").alias("k"), "n").agg(F.sum("count").alias("count")).filter("k IS NULL OR k = -1").collect()}
    assert got == {(True, 10_000): 10_000, (False, 10_000): 10_000}
    assert counted.filter("n = 1").count() == 10_000 and counted.count() == 30_000


def test_group_count_spreads_hot_rows(spark, no_auto_broadcast):
    """After the join no task holds more than its share of the hot key."""
    df = spark.range(0, 40_000, 1, 40).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = with_group_count(df, ["k"], "n", hot_keys=10).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in parts) == 40_000 and max(r["count"] for r in parts) < 20_000


def test_inconsistent_keys(rows):
    df = rows([(1, "a"), (1, "b"), (1, None), (2, "a"), (2, "a")], "k int, v string")
    assert [tuple(r) for r in inconsistent_keys(df, "k", "v", "n").collect()] == [(1, 2)]


def test_zscore(rows):
    got = [r.z for r in zscore(rows([(1,), (2,), (3,), (None,)], "x int"), "x", "z").collect()]
    assert got == [-1.0, 0.0, 1.0, None]


@pytest.mark.parametrize("data", [[(5,)], [(5,), (5,)]])
def test_zscore_of_a_constant_is_null(rows, data):
    assert {r.z for r in zscore(rows(data, "x int"), "x", "z").collect()} == {None}


def test_zscore_plans_no_cross_join(rows, capsys):
    zscore(rows([(1,), (2,)], "x int"), "x", "z", "m").explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_union_by_name(rows):
    df = union_all([rows([(1, "a")], "x int, y string"), rows([("b", 2)], "y string, x int")])
    assert sorted(map(tuple, df.collect())) == [(1, "a"), (2, "b")]
