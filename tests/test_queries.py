import os

import duckdb
import pytest

from veilframe import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_same_as_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.ORACLES[name])
    cols = [c[0] for c in found.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*[f"`{c}`" for c in cols]).collect()), key=str) == sorted(found.fetchall(), key=str)


def test_entry(spark):
    assert queries.entry(spark, SF).count() == 6000
