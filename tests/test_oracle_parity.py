"""Every query with SQL gives the SQL's rows; every other query runs and repeats itself."""

import pytest

import __spark_entry__ as entry
from conftest import SF, normal
from jurisdiff.plans import general, landed, pipeline, views

CORE = {k: f for m in (general, pipeline, views, landed) for k, f in m.QUERIES.items()}
SQL = {k: q for m in (general, pipeline, views, landed) for k, q in m.ORACLES.items()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, oracle, name):
    df = CORE[name](spark, SF)
    columns, rows = oracle(SQL[name])
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.collect(), range(len(df.columns))) == normal(rows, [columns.index(c) for c in df.columns])


@pytest.mark.parametrize("name", sorted(set(CORE) - set(SQL)))
def test_repeats_itself(spark, name):
    once, again = CORE[name](spark, SF).collect(), CORE[name](spark, SF).collect()
    assert once and sorted(map(repr, once)) == sorted(map(repr, again))


def test_entry(spark):
    assert entry.entry(spark).columns == ["regulation_id", "valid_from", "valid_to"]
    assert set(CORE) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
