"""Every registered query of the library against its SQL in DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from furlong.plans.catalog import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in ORACLE_SQL:
        assert rows
        return
    found = duck.sql(ORACLE_SQL[name])
    assert sorted(found.columns) == columns
    at = [found.columns.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=str)
