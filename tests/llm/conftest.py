from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return brute.corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, brute.SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], brute.SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same documents with further columns whose names clash."""
    wide = docs.selectExpr("1 as DOC_ID", "*", "'x' as Text", "2 as path", "3 as root")
    return wide.toDF("DOC_ID", *docs.columns, "Text", "path", "text")
