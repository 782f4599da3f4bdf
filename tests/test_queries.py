"""Every registered query against its SQL on the smallest tables: names, types, rows and values.

No plan may pair all rows of two tables or run Python per row.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from fieldlens.testbed.queries import REGISTRY
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    sql = contract.oracle_sql()[name]
    query = contract.queries()[name]
    wanted = {row[0]: row[1] for row in con.execute("DESCRIBE " + sql).fetchall()}
    frames = []

    def keeping(session, sf_dir):
        frames.append(query(session, sf_dir))
        return frames[-1]

    assert difference(spark, con, SF_DIR, keeping, sql) == ""
    plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in FORBIDDEN if operator in plan]
    assert {f.name: TYPES[f.dataType.simpleString()] for f in frames[0].schema} == wanted


def test_entry_is_the_flagship(spark):
    assert contract.FLAGSHIP in contract.queries()
    assert contract.entry(spark).limit(1).count() == 1
