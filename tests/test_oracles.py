"""Every query with a SQL counterpart returns the same table as DuckDB."""

import math
import os

import duckdb
import pytest
from conftest import SF

from sirenlake.plans.oracles import ORACLES
from sirenlake.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def table(arrow):
    names = sorted(arrow.column_names)
    found = [tuple(plain(v) for v in r.values()) for r in arrow.select(names).to_pylist()]
    return names, sorted(found, key=repr)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_result(spark, duck, key):
    names, got = table(QUERIES[key](spark, SF).toArrow())
    want_names, want = table(duck.sql(ORACLES[key]).to_arrow_table())
    assert names == want_names
    assert len(got) == len(want) > 0
    assert got == want
