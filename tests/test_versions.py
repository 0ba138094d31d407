"""Published versions, updates by file, lasting numbers and checked writes."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.operators import dictionary, joins, merge
from ledgerloom.sources import checked, snapshots


@pytest.fixture
def folder(spark):
    return f"{session.shared_folder(spark)}/test-{uuid.uuid4().hex}"


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_stopped_refresh_leaves_the_old_state(spark, rows, folder):
    old = {"a": rows("k int", [(1,), (2,)]), "b": rows("k int, v string", [(1, "x")])}
    assert snapshots.publish_snapshot(spark, old, folder).version == 1
    broken = rows("k int", [(1,)]).select((F.col("k") / F.raise_error(F.lit("stop here"))).cast("int").alias("k"))
    with pytest.raises(Exception, match="stop here"):
        snapshots.publish_snapshot(spark, {"a": rows("k int", [(9,)]), "b": broken}, folder)
    assert snapshots.versions(spark, folder) == [1]
    assert {n: bag(df) for n, df in snapshots.read_snapshot(spark, folder).items()} == {"a": [(1,), (2,)], "b": [(1, "x")]}
    reader = snapshots.read_snapshot(spark, folder, ["a"])["a"]
    new = snapshots.publish_snapshot(spark, {"a": rows("k int", [(7,)])}, folder, keep_others=True)
    assert new.version == 2 and new.rows == {"a": 1, "b": 1}
    assert bag(reader) == [(1,), (2,)] and bag(new.read("a")) == [(7,)] and bag(new.read("b")) == [(1, "x")]
    assert bag(snapshots.read_snapshot(spark, folder, ["a"], version=1)["a"]) == [(1,), (2,)]


def test_versions_conflict_and_expire(spark, rows, folder):
    assert snapshots.open_snapshot(spark, folder) is None
    with pytest.raises(KeyError):
        snapshots.read_snapshot(spark, folder)
    first = snapshots.publish_snapshot(spark, {"a": rows("k int", [(1,)]), "none": rows("k int", [])}, folder)
    assert bag(first.read("none")) == [] and first.rows["none"] == 0
    snapshots.publish_snapshot(spark, {"a": rows("k int", [(2,)])}, folder, keep_others=True)
    with pytest.raises(RuntimeError, match="meanwhile"):
        snapshots._commit(spark, folder, first, list(first.files))
    # A manifest that was never finished is passed over.
    rows("k int", [(1,)]).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/versions/000000000003")
    third = snapshots.publish_snapshot(spark, {"a": rows("k int", [(3,)])}, folder, keep_others=True)
    assert third.version == 4 and snapshots.versions(spark, folder) == [1, 2, 4]
    assert snapshots.expire(spark, folder, keep=1) == [1, 2, 3]
    assert snapshots.versions(spark, folder) == [4]
    now = snapshots.read_snapshot(spark, folder)
    assert bag(now["a"]) == [(3,)] and bag(now["none"]) == []
    assert not spark.read.parquet(f"{folder}/data/*").filter("k in (1, 2)").count()
    with pytest.raises(KeyError):
        snapshots.open_snapshot(spark, folder, 1)


@pytest.mark.parametrize("kind", ["int", "string"])
def test_upsert_by_file_equals_upsert(spark, rows, folder, kind):
    key = (lambda i: i) if kind == "int" else (lambda i: f"k{i:05d}")
    data = [(key(i), f"t{i}", i % 7, f"s{i}") for i in range(2000)] + [(None, "no key", 0, None)]
    table = rows(f"code {kind}, title string, n int, state string", data)
    # One key of a hundred: neighbours, some of them twice, new keys, and one without a key.
    some = [(key(i), f"new{i}", None, "x", i) for i in range(1000, 1016)] + [(key(1003), "again", 5, "y", 5000)]
    some += [(key(i), f"fresh{i}", 1, "z", i) for i in range(9000, 9003)] + [(None, "nothing", 1, "w", 1)]
    batch = rows(f"code {kind}, title string, n int, state string, _row int", some)
    snapshots.publish_snapshot(spark, {"t": table, "other": table.limit(1)}, folder, keys={"t": "code"}, rows_per_file=100)
    files = len(snapshots.open_snapshot(spark, folder).files_of("t"))
    done = snapshots.upsert_files(spark, folder, "t", batch, "code", ["title", "n"])
    assert files >= 20 and done.rewritten <= 2 and done.kept == files - done.rewritten and done.read < files
    assert bag(done.snapshot.read("t")) == bag(merge.upsert(table, batch, "code", ["title", "n"]))
    assert done.snapshot.rows["t"] == 2001 + 4 and done.snapshot.rows["other"] == 1
    assert bag(snapshots.open_snapshot(spark, folder, 1).read("t")) == bag(table)
    # Scattered keys, after the first update: everything is searched, all is right.
    spread = rows(f"code {kind}, title string, n int, state string, _row int", [(key(i), f"u{i}", i, "v", i) for i in range(0, 9010, 150)])
    before = done.snapshot.read("t")
    again = snapshots.upsert_files(spark, folder, "t", spread, "code", ["title"])
    assert bag(again.snapshot.read("t")) == bag(merge.upsert(before, spread, "code", ["title"]))


def test_update_by_file_equals_update_matched(spark, rows, folder):
    table = rows("code int, v string, w int", [(i, f"v{i}", i) for i in range(500)] + [(None, "none", 1)])
    source = rows("code int, x string", [(i, None if i % 2 else f"x{i}") for i in range(40, 45)] + [(900, "lost"), (None, "null")])
    snapshots.publish_snapshot(spark, {"t": table}, folder, keys={"t": "code"}, rows_per_file=50)
    done = snapshots.update_files(spark, folder, "t", source, "code", {"v": F.col("x")})
    assert done.rewritten == 1
    assert bag(done.snapshot.read("t")) == bag(joins.update_matched(table, source, {"code": "code"}, {"v": F.col("x")}))
    nothing = snapshots.update_files(spark, folder, "t", rows("code int, x string", [(70000, "lost")]), "code", {"v": F.col("x")})
    assert nothing.rewritten == 0 and nothing.snapshot.version == done.snapshot.version
    empty = snapshots.upsert_files(spark, folder, "t", rows("code int, v string, w int, _row int", []), "code", ["v"])
    assert empty.rewritten == 0 and bag(empty.snapshot.read("t")) == bag(done.snapshot.read("t"))


def test_numbers_last_over_refreshes(spark, rows, folder):
    """Six refreshes with rows coming and going: no known number changes, and none is given twice."""
    pick, given = random.Random(2), {}
    for _ in range(6):
        here = [(pick.choice(["a", "b", None]), pick.randrange(40)) for _ in range(30)]
        rows_in = rows("name string, n int", here)
        got = dictionary.lasting_numbers(spark, folder, "names", rows_in, ["name", "n"], hot_rows=5)
        assert got.count() == len(here)
        for name, n, number in got.distinct().collect():
            assert given.setdefault((name, n), number) == number
        fresh = sorted(given.values())
        assert len(set(fresh)) == len(fresh) and fresh == list(range(1, len(fresh) + 1))
    codes = dictionary.lasting_codes(spark, folder, "codes", rows("k int", [(5,), (7,), (5,)]), ["k"], "code", "id", 3, start=8)
    assert bag(codes) == [(5, "id008"), (5, "id008"), (7, "id009")]
    codes = dictionary.lasting_codes(spark, folder, "codes", rows("k int", [(1,), (7,)]), ["k"], "code", "id", 3, start=8)
    assert bag(codes) == [(1, "id010"), (7, "id009")]
    with pytest.raises(OverflowError):
        dictionary.lasting_codes(spark, folder, "codes", rows("k int", [(2,)]), ["k"], "code", "id", 1)


def test_checked_write(spark, rows, folder):
    data = [(1, "ab", "x"), (1, "abc", "x"), (None, "abcd", "q"), (2, None, None), (3, "c", "y"), (3, "c", "y")]
    rules = checked.Rules(["id"], {"name": 3}, {"kind": ["x", "y"]}, [["id"], ["name", "kind"]], {"small": F.col("id") < 3})
    found = checked.checked_write(rows("id int, name string, kind string", data), rules, folder)
    assert bag(found.good) == [(1, "ab", "x"), (1, "abc", "x"), (2, None, None)]
    bad = bag(found.quarantined)
    assert bad == [(3, "c", "y", ["test:small"])] * 2 + [(None, "abcd", "q", ["required:id", "width:name", "domain:kind"])]
    assert found.counts == {"rows": 6, "quarantined": 3, "required:id": 1, "width:name": 1, "domain:kind": 1, "test:small": 2}
    assert bag(found.repeated) == [("id", "1", 2)]
    plain = checked.checked_write(rows("id int", [(1,), (1,)]), checked.Rules())
    assert plain.good.count() == 2 and plain.quarantined.count() == 0 and plain.repeated.count() == 0


def test_rules_cost_one_scan(spark, rows, folder):
    """The rules add a projection to the write's own plan: one scan, no exchange."""
    table = session.write_once(rows("id int, name string", [(1, "a")]))
    marked = table.withColumn("violations", checked.violations(checked.Rules(["id", "name"], {"name": 1})))
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
