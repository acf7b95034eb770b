"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import oracle
import pytest

import __spark_entry__ as contract
from orebelt.plans.queries import QUERIES

SF_DIR = os.environ.get("OREBELT_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


# Rows through Python, or pairs of all rows.
UNWANTED = ("Python", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in UNWANTED if step in plan]
    names, kinds, rows = oracle.spark_rows(df)
    duck_names, duck_kinds, duck_rows = oracle.duck_rows(con, contract.oracle_sql()[name])
    assert names == duck_names
    assert kinds == duck_kinds
    assert rows == duck_rows
    assert sum(rows.values()) > 0


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
