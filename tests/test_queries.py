"""Registered queries: contract, results against SQL, and plan shapes.

By default every tenth query and the headline queries are compared; set
TICKTIDE_ALL=1 to compare all of them (some minutes).
"""

import os

import pytest

import __spark_entry__ as contract
from bench import HEADLINES
from compare import connect, difference

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
COMPARED = list(ORACLES) if os.environ.get("TICKTIDE_ALL") else sorted(
    set(list(ORACLES)[::10]) | set(HEADLINES) & set(ORACLES))
STREAMED = {n for n in QUERIES if n.startswith(("x0", "x1", "a12", "s09"))}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_contract(spark):
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 200
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", COMPARED)
def test_result(spark, con, sf_dir, name):
    problem = difference(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(HEADLINES) - STREAMED))
def test_no_nested_loops(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_scans_are_pruned_and_filtered(spark, sf_dir):
    plan = QUERIES["s17_compaction"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in plan
    plan = QUERIES["j11_asof_last_quote"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in plan


def test_bars_need_one_shuffle_of_trades(spark, sf_dir):
    plan = QUERIES["a04_crypto_volume_bars"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan
