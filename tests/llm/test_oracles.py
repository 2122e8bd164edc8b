"""Every training-data query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest
from conftest import SF_SMALL
from test_queries_oracle import _rows

from matchmart.llm.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF_SMALL).toPandas()
    theirs = duck.execute(ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert _rows(ours) == _rows(theirs)


def test_registered():
    import __spark_entry__ as entry

    have = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {k.split("_")[0] for k in have}
    assert "pipeline" in have
