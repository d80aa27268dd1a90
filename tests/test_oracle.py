"""Every registered query against its SQL counterpart on the given tables."""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as entry_module
from rollscore.plans.catalog import ORACLES, QUERIES


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "null"
    return repr(x)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    got = table(df.columns, df.collect())
    result = duck.execute(ORACLES[name])
    want = table([c[0] for c in result.description], result.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
