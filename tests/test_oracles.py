"""Every registered query against its SQL in DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from pluvia import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "NULL"
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, int) and not isinstance(value, bool):
        return f"{float(value):.9g}"
    return str(value)


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, sf, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    db.execute(catalog.ORACLES[name])
    expected, columns = db.fetchall(), [c[0] for c in db.description]
    got = catalog.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, got.collect()) == rows(columns, expected)
