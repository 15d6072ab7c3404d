"""Every registered query against its SQL."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from check import TABLES, compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, sql, name):
    got = contract.queries()[name](spark, FOLDER).toArrow()
    text = contract.oracle_sql().get(name)
    if text is None:
        assert len(got) > 0
    else:
        assert compare(got, sql.execute(text).to_arrow_table()) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_no_python_worker_in_any_plan(spark):
    for name in ("modelling_table", "master_table", "category_totals", "clean_expenses"):
        plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan
