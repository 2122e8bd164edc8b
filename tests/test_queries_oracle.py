"""Every registered query against its DuckDB oracle on the sf0.001 tables,
plus the driver contract (entry, key sets)."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from matchmart.registry import QUERIES

TABLES = ["orders", "lineitem", "part", "customer", "supplier", "events"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return repr(round(v, 9))
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if v is pd.NA or v is pd.NaT:
        return "NULL"
    return str(v)


def _rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    return sorted("|".join(_norm(None if pd.isna(x) else x) for x in rec) for rec in df[cols].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_contract_keys():
    q, o = entry.queries(), entry.oracle_sql()
    assert len(q) >= 62
    missing = sorted(set(QUERIES) - set(o))
    assert missing == [], f"queries without oracle: {missing}"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "win_rate" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL).toPandas()
    odf = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert _rows(sdf) == _rows(odf)
