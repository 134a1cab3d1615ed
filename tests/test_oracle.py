"""Registered queries agree with their SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from staygrid.plans import catalogue

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return repr(value)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sql, name):
    df = catalogue.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    result = sql.sql(catalogue.ORACLE_SQL[name])
    assert sorted(result.columns) == columns
    at = [list(result.columns).index(c) for c in columns]
    assert got == sorted(tuple(_plain(r[i]) for i in at) for r in result.fetchall())


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert catalogue.FLAGSHIP in entry.queries()
