"""Every registered query against its oracle, and the shape of its plan."""

import inspect
import re

import pytest

import __spark_entry__ as contract
from contract import compare, inputs, queries
from contract.oracle import ORACLE
from contract.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
# Windows over one row per bucket, of a fixed list or of 4096 hash buckets.
SMALL_WINDOWS = {"value_distribution", "dim_indicator_build", "dim_indicator_upsert", "dim_date_build", "eda_describe"}


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_entry_points():
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) == 104
    assert QUERIES.items() <= contract.queries().items() and ORACLE.items() <= contract.oracle_sql().items()
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 10 and rows[0].total_value >= rows[-1].total_value


@pytest.mark.parametrize("key", sorted(set(QUERIES) & set(ORACLE)))
def test_matches_oracle(spark, con, key):
    assert compare.difference(spark, con, FOLDER, key) is None


def windows_in_one_task(plan):
    """Window operators whose input was gathered into a single partition."""
    lines = plan.splitlines()
    found = 0
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line):
            exchange = next((below for below in lines[i + 1 :] if "Exchange" in below), "")
            found += "SinglePartition" in exchange
    return found


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan(spark, key):
    plan = QUERIES[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "BatchEvalPython"):
        assert unwanted not in plan
    assert bool(windows_in_one_task(plan)) == (key in SMALL_WINDOWS)


def test_inputs_read_whole_tables():
    """No id subset, modulo filter, prefix or row cap on an input."""
    source = inspect.getsource(inputs)
    assert ".limit(" not in source and ".sample(" not in source
    for condition in re.findall(r"\.where\((.*)\)", source):
        assert "%" not in condition, condition
    assert ".limit(" not in inspect.getsource(queries)
