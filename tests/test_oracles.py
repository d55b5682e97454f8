"""Every registered query against its SQL on the smallest driver tables."""

import pytest

from check import compare, database
from tallyline.plans import all_queries  # noqa: F401
from tallyline.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


def no_pairs_and_no_python(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    for word in ("NestedLoop", "Cartesian", "Python", "ArrowEval", "MapInPandas"):
        assert word not in text, word


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, note, _ = compare(spark, con, QUERIES[name], ORACLES.get(name), SF, no_pairs_and_no_python)
    assert ok, note
    assert "TYPES" not in note, note


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())
