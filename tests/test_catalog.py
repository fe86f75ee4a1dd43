"""Every query with SQL beside it gives what DuckDB gives on the same tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from reelforge.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def shown(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, datetime.datetime):
        return str(v.replace(tzinfo=None))
    return str(v)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(map(shown, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    found = con.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(shown(r[i]) for i in at) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 4
    assert set(e.oracle_sql()) <= set(e.queries())


def test_import_needs_no_session():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-500:]
