"""Each query of the training-data operators against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from attestry.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    result = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    want = sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in result.fetchall())
    assert sorted(names) == cols
    assert sorted(repr(tuple(r[c] for c in cols)) for r in df.collect()) == want
