"""Plans hold at scale: pushed filters, pruned columns, checked broadcasts, no single-task windows over data."""

import re

import pytest

import __spark_entry__ as spark_entry
from ledgerloom import session
from ledgerloom.operators import audit, joins, skew
from ledgerloom.sources.tables import lookup
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark_entry.queries()["attribute_inner"](spark, FOLDER))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("l_orderkey" in s and "l_shipdate" not in s for s in scans)
    text = plan(spark_entry.queries()["append_with_codes"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,P))]" in text


def test_numbering_window_sees_task_totals_only(spark):
    text = plan(spark_entry.queries()["row_ids"](spark, FOLDER))
    physical = text[text.index("== Physical Plan =="):]
    window = physical[physical.index("Window ["):]
    assert "HashAggregate" in window and "SinglePartition" in window
    assert "l_partkey" not in window[: window.index("HashAggregate")]


def test_small_side_is_broadcast_and_large_side_is_not(rows):
    left, right = rows("k string", [("a",)]), rows("k string, v int", [("a", 1)])
    small = session.store(right)
    large = session.Stored(small.df, 10**9, 10**12)

    def joined(side):
        return plan(skew.lookup_join(left, side, F.col("k"), F.col("k"), {"v": F.col("v")}))

    assert "rightHint=(strategy=broadcast)" in joined(small)
    assert "strategy=broadcast" not in joined(large)


def test_require_unique(rows):
    with pytest.raises(ValueError):
        audit.require_unique(rows("k string", [("a",), ("a",)]), ["k"])
    assert audit.require_unique(rows("k string", [("a",), (None,), (None,)]), ["k"]).count() == 3


def test_intermediate_tables_go_to_the_named_folder(spark, rows):
    stored = session.write_once(rows("k string", [("a",)]))
    assert spark.conf.get("spark.checkpoint.dir") in stored.inputFiles()[0]


def test_code_lists_are_bounded_and_broadcast(spark, rows):
    codes = lookup(spark, [("a", 1)], "code string, id int")
    text = plan(joins.decode(rows("k string", [("a",)]), codes, "k", "code", {"id": "id"}))
    assert "BroadcastHashJoin" in text
    with pytest.raises(ValueError):
        lookup(spark, [("a", 1)] * 10_001, "code string, id int")


def test_every_recoded_column_has_a_reference():
    from ledgerloom.plans.fixed import CLIENT_REFERENCES
    from ledgerloom.plans.schemas import REFERENCES

    missing = [(t, c) for t, columns in CLIENT_REFERENCES.items() for c in columns if c not in REFERENCES.get(t, {})]
    assert not missing
