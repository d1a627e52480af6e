"""Every core query against its SQL on the small tables."""

import glob
import os

import duckdb
import pytest

from noticeloom.plans import catalogue


def normal(rows, columns):
    def cell(v):
        if v is None or v != v:
            return ""
        if isinstance(v, float) and v == int(v):
            v = int(v)
        return str(v)

    return sorted(tuple(cell(r[c]) for c in columns) for r in rows)


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in glob.glob(f"{data}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_equals_sql(spark, data, duck, name):
    got = catalogue.QUERIES[name](spark, data)
    want = duck.execute(catalogue.ORACLE[name]).fetchdf().astype(object)
    want = want.where(want.notna(), None)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert normal([r.asDict() for r in got.collect()], columns) == normal(want.to_dict("records"), columns)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_query_runs(spark, data, name):
    assert catalogue.QUERIES[name](spark, data).count() > 0
