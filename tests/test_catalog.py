"""Every named query: plan shape, and agreement with its SQL on the smallest tables."""

import importlib.util
import os
import re

import pytest

from granary.plans import catalog
from tools.check_oracle import compare, duck

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
QUERIES = catalog()
# queries that write, train or stream run in the oracle check only
SLOW = re.compile(r"^(f09|f10|l06d|l07c|l08|l09|l1[0-3]|x0)")


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_driver_contract(spark):
    spec = importlib.util.spec_from_file_location("entry", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(module.oracle_sql()) <= set(module.queries())
    assert module.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql and not SLOW.match(n)])
def test_matches_sql(spark, sf, con, name):
    status, _, _, note = compare(spark, con, sf, QUERIES[name])
    assert status == "ok", note


@pytest.mark.parametrize("name", [n for n in QUERIES if not SLOW.match(n) and not n.startswith("s0")])
def test_plan_has_no_row_at_a_time_python_and_no_cross_join(spark, sf, name):
    plan = QUERIES[name].run(spark, sf)._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad
