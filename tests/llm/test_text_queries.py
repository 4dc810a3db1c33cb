import re

import pytest

from stackroom.llm.queries import ORACLES, QUERIES
from workload.compare import difference, ordered, sql_rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    assert difference(ordered(df.columns, rows), ordered(*sql_rows(sf, ORACLES[name]))) is None


def test_all_operators():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op3_license_scan", "op5_line_dedup"])
def test_native_operators_run_no_python(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", plan)
