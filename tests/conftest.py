from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from recordmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        **{"spark.checkpoint.dir": tmp_path_factory.mktemp("shared").as_uri(), "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def apply(spark):
    """Evaluate a column function on plain values, in order."""
    from pyspark.sql import functions as F

    def run(function, values, *types):
        rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
        width = len(rows[0]) - 1
        names = [f"v{i}" for i in range(width)]
        schema = "i int, " + ", ".join(f"{n} {t}" for n, t in zip(names, types or ["string"] * width))
        df = spark.createDataFrame(rows, schema)
        out = df.select("i", function(*[F.col(n) for n in names]).alias("out")).collect()
        return [row.out for row in sorted(out, key=lambda r: r.i)]

    return run
