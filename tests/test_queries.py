"""Every registered query against its reference SQL, over whole tables."""

import pytest

import __spark_entry__ as entry_points
from queries.oracles import ORACLES
from queries.registry import QUERIES
from tools.check_oracles import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_registry():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    problem, rows = compare(spark, con, name, sf_dir)
    assert not problem and rows > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_no_plan_pairs_all_rows(spark, sf_dir, name, capsys):
    QUERIES[name](spark, sf_dir).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan
