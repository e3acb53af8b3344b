import sys

import __spark_entry__ as driver
from checks.queries import QUERIES


def test_core_queries_without_the_optional_packages(monkeypatch):
    monkeypatch.setitem(sys.modules, "tallyspark.llm", None)  # an import of it fails
    assert driver.queries().keys() == QUERIES.keys() and driver.oracle_sql()


def test_queries_without_the_pipeline(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert "pipeline" not in driver.queries()
