"""The SQL of the training-data operators, in DuckDB, against their queries."""

import duckdb
import pytest

from pluvia.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect(config={"threads": 1})
    for table in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    want = con.execute(Q.ORACLES[name])
    columns = [c[0] for c in want.description]
    show = lambda row: tuple(f"{v:.6g}" if isinstance(v, float) else str(v) for v in row)
    got = Q.QUERIES[name](spark, sf)
    assert set(got.columns) == set(columns)
    assert sorted(map(show, got.select(*columns).collect())) == sorted(map(show, want.fetchall()))
