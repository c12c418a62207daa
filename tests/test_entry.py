"""Every oracle against its query on the smallest tables, where they are there."""

import os

import pytest

import __spark_entry__
from glyphgrid.plans import catalog

SMALL = "/root/testdata/sf0.001"
NAMES = sorted(catalog.ORACLES)


def test_registry():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, name):
    duckdb, pd = pytest.importorskip("duckdb"), pytest.importorskip("pandas")
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        path = os.path.join(SMALL, file)
        con.execute(f"create view {file.split('.')[0]} as select * from read_parquet('{path}{'/**/*.parquet' if os.path.isdir(path) else ''}')")
    got = __spark_entry__.queries()[name](spark, SMALL).toPandas()
    want = con.execute(__spark_entry__.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)

    def rows(frame):
        shown = lambda x: "null" if pd.isna(x) else f"{x:.6g}" if isinstance(x, float) else str(x)
        return sorted(tuple(map(shown, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False))

    assert rows(got) == rows(want)
