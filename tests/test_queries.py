"""Every registered query against its SQL twin on the smallest test tables."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as driver
from checks import compare
from checks.oracle import ORACLE
from checks.queries import QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, con, name):
    problem = compare.difference(spark, con, name, DATA)
    assert problem is None or problem == "no rows"


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= driver.queries().keys() and ORACLE.keys() <= driver.oracle_sql().keys()


def test_entry(spark):
    df = driver.entry(spark)
    assert "rfm_segment" in df.columns and df.count() > 0


FORBIDDEN = ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize(
    "name", ["rfm_enriched", "anomaly_alerts", "arr_waterfall", "nrr_quality", "alert_payload", "quarantine"]
)
def test_plans_stay_native(spark, capsys, name):
    driver.queries()[name](spark, DATA).explain()
    plan = capsys.readouterr().out
    assert not [word for word in FORBIDDEN if word in plan]


@pytest.mark.parametrize("name", ["rfm_quintiles", "rfm_enriched", "mrr_ledger", "cohort_matrix", "rolling_7_30"])
def test_no_table_moves_to_one_task(spark, capsys, name):
    """Single-partition exchanges carry only partially aggregated one-row results."""
    driver.queries()[name](spark, DATA).explain()
    lines = capsys.readouterr().out.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert re.search(r"Aggregate\(keys?=\[\], functions=\[partial_", lines[i + 1])
