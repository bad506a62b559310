"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from parity import compare, connect

import __spark_entry__ as entry
import workload

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert workload.QUERIES.keys() == workload.ORACLES.keys() and len(workload.QUERIES) >= 75
    assert workload.QUERIES.items() <= entry.queries().items()


@pytest.mark.parametrize("name", list(workload.QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) == ""


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "record_id" and df.count() > 0
