"""Registered queries against their SQL on DuckDB, whole tables."""

import pytest

from metroloom.llm import oracles, queries

from .conftest import DATA


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    r = duck.execute(oracles.ORACLES[name])
    columns = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    want = sorted(repr([row[columns.index(c)] for c in order]) for row in r.fetchall())
    assert sorted(repr([row[c] for c in order]) for row in df.collect()) == want
