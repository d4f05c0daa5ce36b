"""The driver contract: entry smoke test and Spark vs DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import driver

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
STORAGE = {"csv_roundtrip", "refresh_tables", "views", "catalog_views", "load_counters"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "success_rate_pct" in df.columns


def test_every_query_of_the_library_has_oracle():
    assert set(driver.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else ("NULL" if v is None else str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql())))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    srows = df.collect()
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    a = sorted(tuple(_norm(r[c]) for c in order) for r in srows)
    b = sorted(tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows)
    assert a == b


@pytest.mark.parametrize("name", sorted(STORAGE))
def test_storage_queries_run_twice(spark, name):
    """Writing paths are fresh or overwritten, so a second call works too."""
    assert E.queries()[name](spark, SF).count() > 0


def test_entry_imports_without_a_session():
    """The driver imports the entry module before any session exists."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    queries, oracles = map(int, out.stdout.split())
    assert queries >= oracles >= len(driver.QUERIES) == 73
