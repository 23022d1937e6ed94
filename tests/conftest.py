"""One session for all tests, and a comparison with DuckDB."""

from __future__ import annotations

import decimal
import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g", "spark.driver.host": "127.0.0.1",
        "spark.checkpoint.dir": str(work / "shared"), "spark.sql.warehouse.dir": str(work / "warehouse"),
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for file in Path(SMALL).glob("*.parquet"):
        con.sql(f"create view {file.stem} as select * from '{file}'")
    return con


def plain(value) -> str:
    """A value as text, alike for either engine."""
    if value is None:
        return "NULL"
    if isinstance(value, (float, decimal.Decimal)):
        return f"{float(value):.9g}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    return str(value)


@pytest.fixture(scope="session")
def agrees(spark, duck):
    """Asserts that a query and its SQL return the same rows."""

    def check(query, sql: str) -> None:
        df = query(spark, SMALL)
        columns = sorted(df.columns)
        ours = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
        theirs = duck.sql(sql)
        assert sorted(theirs.columns) == columns
        at = [theirs.columns.index(c) for c in columns]
        assert ours == sorted(tuple(plain(r[i]) for i in at) for r in theirs.fetchall())

    return check
