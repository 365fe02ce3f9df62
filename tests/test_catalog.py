"""The correctness gate: every catalog query against its DuckDB oracle at sf0.001."""

import os

import duckdb
import pytest

from tools.oracle_check import TABLES, rows_of, type_diff

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _names():
    import __spark_entry__ as E

    return sorted(E.queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E

    frame = E.queries()[name](spark, SF)
    sdf = frame.toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sdf) >= 0
        return
    rel = con.sql(sql)
    assert type_diff(frame.schema, rel) == {}
    sc, sr = rows_of(sdf)
    oc, orr = rows_of(rel.df())
    assert sc == oc
    assert len(sr) == len(orr)
    assert sr == orr


def test_entry_smoke(spark):
    import __spark_entry__ as E

    rows = E.entry(spark).collect()
    assert len(rows) == 1
    assert (rows[0].expired_rows, rows[0].released_keys, rows[0].clean_rows) == (48, 9, 118)
