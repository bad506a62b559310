"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return [_cell(v) for v in value]
    return value


def rows_of(names: list[str], rows) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_cell(row[i]) for i in order]) for row in rows)


def compare(spark, con, name: str, folder: str) -> str:
    """'' where both sides agree, else what differs."""
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, folder)
    ours = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "" if ours else "no rows and no oracle"
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    theirs = rows_of(relation.columns, relation.fetchall())
    if ours == theirs:
        return "" if ours else "agree on no rows at all"
    left, right = set(ours) - set(theirs), set(theirs) - set(ours)
    return (
        f"{len(ours)} rows against {len(theirs)}; only ours {len(left)}: {sorted(left)[:3]}; "
        f"only theirs {len(right)}: {sorted(right)[:3]}"
    )


def main(folder: str, only: list[str]) -> int:
    import __spark_entry__ as entry

    from recordmill.session import build_session

    spark = build_session("local[8]", **{"spark.checkpoint.dir": Path(tempfile.mkdtemp(prefix="parity-")).as_uri(), "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in only or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        checked = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok'} {name} [{checked}] {time.time() - start:.1f}s {problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
