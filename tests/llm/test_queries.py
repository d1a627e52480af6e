"""The registered queries over the small tables."""

import glob
import os

import duckdb
import pytest

from noticeloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, data, name):
    c = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    got = queries.QUERIES[name](spark, data)
    assert sorted(map(tuple, got.collect())) == sorted(c.execute(queries.ORACLE[name]).fetchall())


COLUMNS = {
    "p1_found": "edital_id_a bigint, edital_id_b bigint", "p3_found": "edital_id_a bigint, edital_id_b bigint", "p4_found": "edital_id bigint, portal_id bigint",
    "p5_found": "raw_id bigint, line_no int", "p6_found": "edital_id bigint, campo string, pos int, ref_id bigint", "p9_found": "doc_id bigint",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_no_case_twice(spark, data, name):
    got = queries.QUERIES[name](spark, data)
    assert ", ".join(f"{n} {t}" for n, t in got.dtypes) == COLUMNS[name]
    rows = got.collect()
    assert 0 < len(rows) == len(set(map(tuple, rows)))
