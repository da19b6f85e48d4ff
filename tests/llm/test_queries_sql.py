import os

import duckdb
import pytest

from veilframe.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op7_topk", "op10_warc", "op11_merkle", "op12_spelling", "op13_substrings"])
def test_same_as_sql(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    df = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.ORACLES[name])
    cols = [c[0] for c in found.description]
    rows = found.fetchall()
    assert sorted(cols) == sorted(df.columns) and rows
    assert sorted(map(tuple, df.select(*[f"`{c}`" for c in cols]).collect()), key=str) == sorted(rows, key=str)
