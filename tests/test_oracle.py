"""Every registered query against its SQL, on the smallest tables: same rows, and no cross join or Python step."""

import pytest

from ledgerloom.catalog import all_entries
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert all(e.oracle for e in all_entries().values())


@pytest.mark.parametrize("name", sorted(all_entries()))
def test_query_equals_sql(spark, duck, name):
    entry = all_entries()[name]
    df = entry.build(spark, FOLDER)
    _, problems = compare(df, duck, entry.oracle)
    assert not problems
    text = df._jdf.queryExecution().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in text, bad
