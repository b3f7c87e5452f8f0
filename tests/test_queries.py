"""Every registered query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from qirtas.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{DATA}/{t}.parquet"):
            con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(float(value)) if isinstance(value, float) else str(value)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    found = catalog.QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in found.collect())
    if name not in catalog.ORACLES:
        assert columns
        return
    result = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())
