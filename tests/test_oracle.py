"""Every registered query against its DuckDB oracle (small scale)."""

import pytest

import __spark_entry__ as E
from tidewater.plans import ORACLE_SQL, QUERIES
from tools.check_oracle import compare

from conftest import SF_SMALL


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["AIRLINE_NAME", "FLIGHTS_COUNT", "AVG_ARRIVAL_DELAY_MINUTES"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=True)[name]
    assert res["ok"], res


PYTHON_OPERATORS = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow",
                    "FlatMapGroupsInPandas", "MapPartitions", "PythonUDF")


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if not q.startswith("stream_")))
def test_plans_stay_in_the_jvm(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in PYTHON_OPERATORS if op in plan], plan
