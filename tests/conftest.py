from __future__ import annotations

import glob
import os

import duckdb
import pytest
from pyspark.sql import SparkSession

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def rows_of(found):
    """Rows of a Spark frame or a DuckDB relation as sorted tuples of texts, columns by name."""
    names, rows = (found.columns, found.fetchall()) if hasattr(found, "fetchall") else (found.columns, found.collect())
    places = [names.index(c) for c in sorted(names)]

    def cell(v):
        return "(null)" if v is None else "(nan)" if v != v else repr(round(v, 6)) if isinstance(v, float) else str(v)

    return sorted(tuple(cell(row[k]) for k in places) for row in rows)
