import os

import duckdb
import pytest

import __spark_entry__
from pulsemill.plans import catalogue

PATH = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(df):
    def cell(v):
        if hasattr(v, "__len__") and not isinstance(v, str):
            return str([round(float(x), 6) for x in v])
        if isinstance(v, float):
            return str(int(v)) if v.is_integer() else repr(round(v, 9))
        return str(v)

    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{PATH}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(PATH), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    got = catalogue.QUERIES[name](spark, PATH).toPandas()
    if name in catalogue.ORACLE:
        want = con.sql(catalogue.ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        got, want = got.astype(object).where(got.notna(), None), want.astype(object).where(want.notna(), None)
        assert shown(got) == shown(want)
    else:
        assert len(got)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
