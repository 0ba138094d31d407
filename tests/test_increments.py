"""Batches in any order, some of them twice, give what one batch gives."""

import random

import pytest

from ledgerloom.operators import merge
from ledgerloom.operators.increments import STATE, merge_increment, merged_so_far
from ledgerloom.sources.snapshots import open_snapshot, versions
from ledgerloom.streaming.arrivals import insert_batch, insert_stream, start_arrivals, with_arrivals

ROWS = "code string, name string, notes string, o int"


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some_registers(rows, data):
    labels = ["", " A: ", " B: "]
    return [merge.Register(rows(ROWS, [d[1] for d in data if d[0] == i]), label, ["o"]) for i, label in enumerate(labels)]


@pytest.mark.parametrize("partitions", [1, 4, 32])
@pytest.mark.parametrize("keep", [False, True])
def test_increments_equal_one_merge(spark, rows, tmp_path, partitions, keep):
    dice = random.Random(partitions)
    data = [
        (dice.randrange(3), (f"c{dice.randrange(6)}", dice.choice("xyz"), dice.choice([None, "n", "m", "k"]), dice.randrange(9)))
        for _ in range(150)
    ]
    data += [(1, ("hot", "h", dice.choice(["a", "b"]), i)) for i in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        path = str(tmp_path / "merged")
        dice.shuffle(data)
        parts = [data[i::3] for i in range(3)]
        for number in (2, 0, 0, 1):
            merge_increment(spark, path, some_registers(rows, parts[number]), "code", ["name"], number, keep_notes=keep, hot_rows=20)
        expected = bag(merge.precedence_merge(some_registers(rows, data), "code", ["name"], keep_notes=keep))
        assert bag(merged_so_far(spark, path)) == expected
        assert len(versions(spark, path)) == 4  # the empty one, and one for each increment
        held = open_snapshot(spark, path).read(STATE)
        assert held.count() < len(set(data)) or keep
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_an_increment_leaves_other_files_alone(spark, rows, tmp_path):
    path = str(tmp_path / "merged")
    many = [(0, (f"c{i:03}", "n", "t", i)) for i in range(200)]
    merge_increment(spark, path, some_registers(rows, many), "code", ["name"], 0)
    before = {f["file"] for f in open_snapshot(spark, path).files_of(STATE)}
    spread = len(before) > 1
    done = merge_increment(spark, path, some_registers(rows, [(1, ("c000", "other", "late", 0)), (2, (None, "no code", "t", 0))]), "code", ["name"], 1)
    after = {f["file"] for f in open_snapshot(spark, path).files_of(STATE)}
    assert done.rewritten == 2 and (not spread or before & after)
    found = {r["code"]: (r["name"], r["notes"]) for r in merged_so_far(spark, path).collect()}
    assert len(found) == 200 and found["c000"] == ("n", "t A: late") and found["c001"] == ("n", "t")


def test_nothing_arrives(spark, rows, tmp_path):
    path = str(tmp_path / "merged")
    merge_increment(spark, path, some_registers(rows, []), "code", ["name"], 0)
    assert bag(merged_so_far(spark, path)) == []


TABLE, ARRIVING = "a string, b long, name string", "a string, b int, name string, at int"
KEY = ["a", "b"]


@pytest.mark.parametrize("turns", [(0, 1, 2), (2, 1, 0), (1, 1, 2, 0, 1)])
def test_arrivals_in_any_order_equal_one_batch(spark, rows, tmp_path, turns):
    dice = random.Random(7)
    table = rows(TABLE, [("k0", 0, "old"), ("k1", 1, "old"), (None, 3, "old"), (None, 3, "old")])
    data = [(dice.choice([None, "k0", "k1", "k2"]), dice.choice([None, 0, 1, 2]), f"n{i}", dice.randrange(20)) for i in range(90)]
    data += [("hot", 5, f"h{i}", i) for i in range(100, 160)] + [(None, 1, "twin", 1)] * 2
    dice.shuffle(data)
    batch = rows(ARRIVING, data)
    target = start_arrivals(table, batch.schema, str(tmp_path / "t"), KEY, ["at"])
    assert bag(with_arrivals(spark, target)) == bag(table)
    for turn in turns:
        insert_batch(target, rows(ARRIVING, data[turn::3]), turn)
    assert bag(with_arrivals(spark, target)) == bag(merge.insert_if_absent(table, batch, KEY, ["at"]))


def test_a_key_that_keeps_arriving_is_written_once(spark, rows, tmp_path):
    target = start_arrivals(rows(TABLE, []), rows(ARRIVING, []).schema, str(tmp_path / "t"), KEY, ["at"])
    for turn in range(3):
        insert_batch(target, rows(ARRIVING, [("k", 1, "n", turn)]), turn)
    insert_batch(target, rows(ARRIVING, []), 3)
    assert spark.read.parquet(f"{target.path}/arrived").count() == 1
    assert bag(with_arrivals(spark, target)) == [("k", 1, "n")]


def test_a_stream_inserts(spark, rows, tmp_path):
    inbox, state = str(tmp_path / "inbox"), str(tmp_path / "state")
    target = start_arrivals(rows(TABLE, [("k", 1, "old")]), rows(ARRIVING, []).schema, str(tmp_path / "t"), KEY, ["at"])
    for late in ([("k", 1, "no", 1), ("l", 1, "second", 2)], [("l", 1, "first", 1), (None, None, "null", 1)]):
        rows(ARRIVING, late).coalesce(1).write.mode("append").parquet(inbox)
        query = insert_stream(spark.readStream.schema(ARRIVING).parquet(inbox), target, state, availableNow=True)
        assert query.awaitTermination(120)
    assert bag(with_arrivals(spark, target)) == sorted([("k", 1, "old"), ("l", 1, "first"), (None, None, "null")], key=repr)
