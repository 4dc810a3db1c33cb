import re

import pytest

import __spark_entry__ as entry
from workload import ORACLES, QUERIES
from workload.compare import difference, ordered, sql_rows

NO_SQL = {"fuzzy_search", "sequence_similarity"}


def test_every_query_has_sql_but_the_stated_ones():
    assert set(ORACLES) == set(QUERIES) - NO_SQL


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("BroadcastNestedLoopJoin|CartesianProduct|BatchEvalPython", plan)
    rows = [tuple(r) for r in df.collect()]
    if name in ORACLES:
        assert difference(ordered(df.columns, rows), ordered(*sql_rows(sf, ORACLES[name]))) is None
    else:
        assert rows
