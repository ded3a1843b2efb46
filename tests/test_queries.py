"""Every registered query against its oracle SQL (DuckDB) on the sf0.001 tables, the same
comparison the driver makes at sf0.01: row count, column names and all values."""

import pytest

import __spark_entry__ as E
from graphloom.plans.tpch_oracle import ORACLE
from graphloom.plans.tpch_queries import QUERIES
from tests.conftest import SF001


def _norm(v):
    if v is None:
        return "\x00"
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def _canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rs)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _canon(df.columns, got) == _canon(cols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["s", "p", "o", "o_kind", "o_datatype", "o_lang"]
    assert df.count() > 0
