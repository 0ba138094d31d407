"""Hot keys, numbering and merges: the same result whatever the key distribution and partitioning."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import codes, crosswalk, joins, merge, numbering, skew
from ledgerloom.operators.merge import Register
from ledgerloom import session


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def skewed(n=300, seed=1):
    """A third of the rows share one key, and another part has none."""
    rnd = random.Random(seed)
    keys = [rnd.choice(["hot", "hot", "lost", None, *[f"k{i}" for i in range(6)]]) for _ in range(n)]
    return [(i, k) for i, k in enumerate(keys)]


@pytest.fixture(params=[1, 4, 32])
def partitions(request, spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_lookup_join_with_hot_keys(rows, partitions):
    data = skewed()
    left = rows("i int, k string", data)
    side = {"hot": 1, **{f"k{i}": 10 + i for i in range(0, 6, 2)}}
    right = rows("code string, v int", list(side.items()))
    want = sorted(((i, k, side.get(k), k in side) for i, k in data), key=repr)
    for hot_rows in (20, 10_000):
        got = skew.lookup_join(left, right, F.col("k"), F.col("code"), {"v": F.col("v")}, "found", hot_rows=hot_rows)
        assert bag(got) == want
    stored = session.store(right)
    assert stored.fits_broadcast and stored.rows == len(side)
    assert bag(skew.lookup_join(left, stored, F.col("k"), F.col("code"), {"v": F.col("v")}, "found")) == want


def test_recode_keeps_rows_and_nulls_the_rest(rows):
    data = skewed()
    pairs = rows("old string, new string", [("hot", "z9"), ("hot", "a1"), ("k1", "b"), (None, "never")])
    table = rows("i int, k string", data)
    want = sorted(((i, {"hot": "a1", "k1": "b"}.get(k)) for i, k in data), key=repr)
    walk = crosswalk.one_to_one(pairs, "old", "new")
    assert bag(crosswalk.recode(table, walk, ["k"])) == want
    large = crosswalk.Crosswalk(session.Stored(walk.df, 10**9, 10**12), "old", "new")
    for hot_rows in (5, 10_000):
        assert bag(crosswalk.recode(table, large, ["k"], hot_rows)) == want
    assert bag(crosswalk.ambiguous(pairs, "old", "new")) == [("hot", 2, "a1")]
    lost = sum(k not in ("hot", "k1") and k is not None for _, k in data)
    assert bag(crosswalk.unmatched({"t": table}, walk, {"t": ["k"]})) == [("t", "k", lost)]


def test_melted_recode_moves_a_table_once(spark, rows, partitions):
    """Three reference columns, one hot code, rows without any code, repeated rows, and a payload that travels once."""
    rnd = random.Random(4)
    pick = lambda: rnd.choice(["hot", "hot", "lost", None, "k1", "k2"])
    data = [(rnd.randrange(5), pick(), pick(), pick(), "x" * 50) for _ in range(300)] + [(9, None, None, None, "none")]
    new = {"hot": "a1", "k1": "b", "k2": "c"}
    table = rows("__id int, a string, b string, c string, payload string", data)
    other = rows("a string, n int", [("hot", 1), (None, 2)])
    walk = crosswalk.one_to_one(rows("old string, new string", list(new.items())), "old", "new")
    want = sorted(((i, *(new.get(x) for x in codes), p) for i, *codes, p in data), key=repr)
    for hot_rows in (20, 10_000):
        spec = {"t": ["a", "b", "c"], "o": ["a"]}
        got = crosswalk.recode_all({"t": table, "o": other, "left": other}, walk, spec, hot_rows, send_small=False)
        assert bag(got["t"]) == want and got["t"].columns == table.columns
        assert bag(got["o"]) == [("a1", 1), (None, 2)] and got["left"] is other
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        got["t"].select("*").explain("formatted")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = [x for x in plan.getvalue().split("\n\n") if ") Exchange" in x]
    assert sum("payload" in x for x in exchanges) == 1
    lost = {c: sum(r[k] == "lost" for r in data) for k, c in ((1, "a"), (2, "b"), (3, "c"))}
    assert bag(crosswalk.unmatched({"t": table}, walk, {"t": ["a", "b", "c"]})) == [("t", c, n) for c, n in lost.items()]
    with pytest.raises(TypeError):
        crosswalk.recode(rows("a int, b int", [(1, 2)]), crosswalk.Crosswalk(session.Stored(walk.df, 10**9, 10**12), "old", "new"), ["a", "b"])


def test_missing_from_and_attribute(rows):
    data = skewed()
    left = rows("i int, k string", data)
    right = rows("code string", [("hot",), ("hot",), ("k1",), (None,)])
    for hot_rows in (5, 10_000):
        plain = joins.missing_from(left, right, {"k": "code"}, hot_rows=hot_rows)
        assert bag(plain) == sorted(((i, k) for i, k in data if k not in ("hot", "k1")), key=repr)
        safe = joins.missing_from(left, right, {"k": "code"}, null_safe=True, hot_rows=hot_rows)
        assert bag(safe) == sorted(((i, k) for i, k in data if k not in ("hot", "k1", None)), key=repr)


def test_join_text_with_hot_keys(rows, partitions):
    data = skewed()
    df = rows("i int, k string", data).withColumn("t", F.when(F.col("i") % 5 != 0, F.col("i").cast("string")))
    want = {}
    for i, k in data:
        want.setdefault(k, []).extend([str(i)] if i % 5 else [])
    want = sorted(((k, ";".join(sorted(v)) if v else None) for k, v in want.items()), key=repr)
    for hot_rows in (30, 10_000):
        assert bag(skew.join_text(df, "k", F.col("t"), [F.col("t")], ";", "x", hot_rows)) == want


def test_numbers_are_dense_and_ordered(spark, rows, partitions):
    values = [(random.Random(i).randint(0, 50), i) for i in range(500)]
    df = rows("a int, b int", values).repartition(7)
    numbered = numbering.number_rows(df, ["a", "b"], "n", start=11)
    got = sorted(numbered.df.collect(), key=lambda r: r["n"])
    assert numbered.rows == 500
    assert [r["n"] for r in got] == list(range(11, 511))
    assert [(r["a"], r["b"]) for r in got] == sorted(values)
    assert numbering.number_rows(df.limit(0), ["a", "b"]).rows == 0


def fold_notes(registers, keep):
    """The append rule written as the plain loop it stands for."""
    out = {}
    for label, entries in registers:
        for code, name, note in entries:
            if code not in out:
                out[code] = [name, note]
            elif note is None:
                out[code][1] = out[code][1] if keep else None
            else:
                out[code][1] = (out[code][1] or "") + label + note
    return sorted(((c, n, t) for c, (n, t) in out.items()), key=repr)


def test_precedence_merge_equals_the_loop(rows, partitions):
    seed = partitions
    rnd = random.Random(seed)
    registers = []
    for r in range(4):
        codes_ = [rnd.choice(["hot", *[f"c{i}" for i in range(12)]]) for _ in range(40)]
        if r == 0:
            codes_ = list(dict.fromkeys(codes_))
        registers.append((f" L{r}: ", [(c, f"n{r}-{i}", rnd.choice([None, f"x{i}", f"y{i}"])) for i, c in enumerate(codes_)]))
    frames = [
        Register(rows("_row int, code string, name string, notes string", [(i, *e) for i, e in enumerate(entries)]), label, ["_row"])
        for label, entries in registers
    ]
    for keep, hot_rows in ((False, 10), (False, 10_000), (True, 10)):
        got = merge.precedence_merge(frames, "code", ["name"], keep_notes=keep, hot_rows=hot_rows)
        assert bag(got) == fold_notes(registers, keep)


def test_notes_of_three_registers(rows):
    def one(note):
        return rows("code string, name string, notes string", [("a", "n", note)])

    registers = [Register(one("x")), Register(one(None), " L1: "), Register(one("y"), " L2: ")]
    assert bag(merge.precedence_merge(registers, "code", ["name"])) == [("a", "n", " L2: y")]
    assert bag(merge.precedence_merge(registers, "code", ["name"], keep_notes=True)) == [("a", "n", "x L2: y")]
    assert bag(merge.precedence_merge(registers[:2], "code", ["name"])) == [("a", "n", None)]


def test_insert_if_absent(rows):
    ddl = "a string, b string, n int"
    table = rows(ddl, [("k2", "k2", 0)])
    batch = rows(ddl, [("k1", "k1", 2), ("k1", "k1", 1), ("k2", "k2", 3), (None, "x", 4), (None, "x", 5)])
    once = merge.insert_if_absent(table, batch, ["a", "b"], ["n"])
    assert bag(once) == sorted([("k2", "k2", 0), ("k1", "k1", 1), (None, "x", 4), (None, "x", 5)], key=repr)
    whole = batch.filter("a is not null")
    assert bag(merge.insert_if_absent(once, whole, ["a", "b"], ["n"])) == bag(once)


def test_upsert_small_and_large_batches_agree(rows, monkeypatch):
    table = rows("code string, title string, work string", [("old", "t0", "w0"), ("kept", "t1", "w1")])
    batch = rows(
        "_row int, code string, title string, work string",
        [(1, "new", "first", "w-first"), (2, "new", "last", "w-last"), (3, "old", "changed", "w-ignored"), (4, "old", None, "x")],
    )
    want = [("kept", "t1", "w1"), ("new", "last", "w-first"), ("old", None, "w0")]
    assert bag(merge.upsert(table, batch, "code", ["title"])) == want
    monkeypatch.setattr(session, "BROADCAST_ROWS", -1)
    assert bag(merge.upsert(table, batch, "code", ["title"])) == want
    fresh = merge.insert_if_absent(table, batch.drop("_row"), ["code"], ["title"])
    assert bag(fresh.select("code")) == [("kept",), ("new",), ("old",)]


def test_append_new_pairs_keeps_repeats(rows):
    ddl = "a string, b string"
    got = merge.append_new_pairs(rows(ddl, [("x", None), ("y", "1")]), rows(ddl, [("x", None), ("z", "2"), ("z", "2"), ("y", None)]), ["a", "b"])
    assert bag(got) == sorted([("x", None), ("y", "1"), ("z", "2"), ("z", "2"), ("y", None)], key=repr)


def test_first_and_last(rows):
    df = rows("k string, n int, v string", [("a", 2, "two"), ("a", 1, "one"), ("b", 1, None), (None, 5, "x")])
    assert bag(merge.first_by(df, ["k"], ["n"])) == sorted([("a", 1, "one"), ("b", 1, None), (None, 5, "x")], key=repr)
    assert bag(merge.last_by(df, ["k"], ["n"])) == sorted([("a", 2, "two"), ("b", 1, None), (None, 5, "x")], key=repr)


def test_all_counterparts(rows, monkeypatch):
    left = rows("i int, k string", [(1, "a"), (2, "b"), (3, None), (4, "z"), (5, "a")])
    pairs = rows("k string, v string", [("a", "y"), ("a", "x"), ("a", "x"), ("a", None), ("b", "w")])
    want = [(1, "a", "x"), (1, "a", "y"), (2, "b", "w"), (5, "a", "x"), (5, "a", "y")]
    for gathered in (1000, 1):
        monkeypatch.setattr(joins, "GATHERED", gathered)
        kept = joins.all_counterparts(left, pairs, "k", "k", "v", "v", keep_unmatched=True)
        assert bag(kept) == sorted([*want, (3, None, None), (4, "z", None)], key=repr)
        assert bag(joins.all_counterparts(left, pairs, "k", "k", "v", "v")) == sorted(want, key=repr)


def test_codes(rows):
    existing = rows("c string", [("id000009",), ("id000003",)])
    new = rows("n string", [("y",), ("x",)])
    assert bag(codes.allocate_codes(existing, "c", new, ["n"])) == [("x", "id000010"), ("y", "id000011")]
    with pytest.raises(OverflowError):
        codes.allocate_codes(rows("c string", [("a9",)]), "c", new, ["n"])
    with pytest.raises(ValueError):
        codes.allocate_codes(existing.limit(0), "c", new, ["n"])
    zero = codes.code_profile(rows("c string", [("k000",)]), "c")
    assert bag(zero) == [("k", 3, 0, 1)]
    assert bag(codes.repair_codes(rows("k string", [("k0007",), ("kx",), ("k12",)]), "k", 5, "k")) == [
        ("k0007", "k0007"), ("k12", "k0008"), ("kx", "k0009")]
    added = codes.append_with_codes(rows("c string, n string", [("w0001", "a")]), rows("c string, n string", [("zz", "b")]), "c", ["n"])
    assert bag(added) == [("w0001", "a"), ("w0002", "b")]
    authors = rows("a string, n string", [("1", "R"), ("2", "R"), ("3", None), ("4", "V")])
    coded, names, left_over = codes.codes_by_name(codes.CodeFrame("id", 3, 5), authors, "n", "code")
    assert dict(bag(coded.select("a", "code"))) == {"1": "id007", "2": "id007", "3": "id006", "4": "id008"}
    assert names.count() == 3 and left_over.last == 8


def test_codes_into_the_prefix(rows):
    """Past the digits of its frame a number takes letters of the prefix, and whoever profiles such codes goes on from them."""
    frame = codes.CodeFrame("id", 2, 97, into_prefix=True)
    new = rows("n int", [(i,) for i in range(905)])
    coded, left_over = codes.take_codes(frame, new, ["n"], "c")
    got = [c for _, c in sorted(coded.collect())]
    assert got == ["id98", "id99", *[f"i{i}" for i in range(100, 1000)], "1000", "1001", "1002"] and left_over.last == 1002
    assert bag(codes.allocate_codes(coded.filter("n < 700"), "c", rows("k int", [(1,)]), ["k"])) == [(1, "i798")]
    with pytest.raises(OverflowError):
        frame.after(9903)
    with pytest.raises(OverflowError):
        codes.take_codes(codes.CodeFrame("id", 2, 97), new, ["n"], "c")


def test_join_key_parts_do_not_run_together(rows):
    df = rows("a string, b string", [("x", "1y"), ("x1", "y"), (None, "y"), ("x", None)])
    assert df.select(skew.join_key("a", "b").alias("k")).filter("k is not null").distinct().count() == 2
    assert df.select(skew.join_key("a", "b", null_safe=True).alias("k")).distinct().count() == 4


@pytest.mark.parametrize("kinds", [("int", "double"), ("decimal(10,1)", "decimal(12,3)"), ("date", "timestamp"), ("bigint", "int")])
@pytest.mark.parametrize("side", ["small", "large", "hot"])
def test_keys_of_unlike_types_match_in_every_branch(spark, kinds, side):
    values = ["2020-01-01", "2020-01-02", None] if kinds[0] == "date" else ["8", "0", None]
    left = spark.createDataFrame([(v,) for v in values * 3], "k string").select(F.col("k").cast(kinds[0]).alias("k"))
    right = spark.createDataFrame([(v,) for v in values], "k string").select(F.col("k").cast(kinds[1]).alias("r"), F.lit("x").alias("v"))
    other = session.store(right) if side == "small" else right
    hot = {"hot_rows": 2} if side == "hot" else {"hot": None}
    got = skew.lookup_join(left, other, F.col("k"), F.col("r"), {"v": F.col("v")}, "found", **hot)
    assert sorted((r.k is None, r.v, r.found) for r in got.collect()) == [(False, "x", True)] * 6 + [(True, None, False)] * 3


def test_text_keys_are_not_compared_with_numbers(rows):
    with pytest.raises(TypeError):
        skew.lookup_join(rows("k string", [("1",)]), rows("r int", [(1,)]), F.col("k"), F.col("r"), {})


@pytest.mark.parametrize("limit", [0, 10**9])
def test_upsert_gives_the_same_rows_for_small_and_large_batches(rows, monkeypatch, limit):
    monkeypatch.setattr(session, "BROADCAST_ROWS", limit)
    table = rows("code int, title string, n int", [(1, "a", 1), (None, "t", 3), (4, "d", 4)])
    batch = rows("_row bigint, code double, title string, n double", [(1, 1.0, "u1", 5.0), (2, None, "u2", 6.0), (3, 9.0, "u3", 7.0), (4, None, "u4", 8.0)])
    got = merge.upsert(table, batch, "code", ["title"])
    assert got.schema["n"].dataType.simpleString() == "int"
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(
        map(repr, [(1, "u1", 1), (None, "t", 3), (4, "d", 4), (None, "u4", 6), (9, "u3", 7)])
    )


def test_equal_and_repeated_rows_of_one_register(rows):
    ddl = "code string, name string, notes string"
    first = rows(ddl, [("c1", "n", "a"), ("c1", "n", "b"), ("c2", "n", "x"), ("c2", "n", "x"), ("c3", "n", None), ("c3", "n", "y")])
    later = rows("code string, name string, notes string, o string", [("c1", "m", "z", "b"), ("c1", "m", "w", "a"), ("c2", "m", None, "a")])
    got = merge.precedence_merge([merge.Register(first, ": "), merge.Register(later, "; ", ["o"])], "code", ["name"])
    assert {r.code: r.notes for r in got.collect()} == {"c1": "a: b; w; z", "c2": None, "c3": ": y"}


def test_gathered_counterparts_move_lists_not_rows(rows, monkeypatch):
    """One row for each row of the left side, however many counterparts it has, but for keys with very many."""
    left = rows("i int, k string", [(1, "a"), (2, "b"), (3, None), (4, "a")])
    pairs = rows("k string, v string", [("a", "x"), ("a", "y"), ("a", "y"), ("b", None), (None, "z")])
    got = joins.gathered_counterparts(left, pairs, "k", "k", "v", "v")
    assert sorted((r["i"], sorted(r["v"] or [])) for r in got.collect()) == [(1, ["x", "y"]), (2, []), (3, []), (4, ["x", "y"])]
    monkeypatch.setattr(joins, "GATHERED", 1)
    got = joins.gathered_counterparts(left, pairs, "k", "k", "v", "v")
    assert sorted((r["i"], v) for r in got.collect() for v in r["v"] or [None]) == sorted(
        [(1, "x"), (1, "y"), (2, None), (3, None), (4, "x"), (4, "y")], key=lambda p: (p[0], p[1] or "")
    )


def test_join_lists_as_join_text(rows, partitions):
    rnd = random.Random(5)
    data = [
        (k, rnd.choice(["t", "u", None]), rnd.choice([None, [], ["b", "a"], ["c", None, "a"]]))
        for k in [*["hot"] * 60, None, None, "none", *[f"k{i % 9}" for i in range(50)]]
    ]
    data.append(("none", "t", None))
    df = rows("k string, t string, v array<string>", data)
    want = {}
    for k, t, v in data:
        want.setdefault(k, []).extend(f"{t}({a})" for a in v or [] if t is not None and a is not None)
    want = sorted(((k, ";".join(sorted(p)) if p else None) for k, p in want.items()), key=repr)
    pieces = lambda row: F.transform(row["v"], lambda a: F.concat(row["t"], F.lit("("), a, F.lit(")")))
    for hot_rows, hot_bytes in ((10, 10**9), (10**9, 100), (10**9, 10**9)):
        assert bag(skew.join_lists(df, "k", ["t", "v"], pieces, ";", "x", hot_rows, hot_bytes)) == want


def test_lowest_notes_when_the_lowest_client_is_unknown(rows):
    """An agent's note is that of its lowest client that is listed; NULL codes and repeats don't count."""
    from ledgerloom.plans.agents import lowest_notes

    pairs = rows(
        "client_code string, agent_code string",
        [("c1", "a"), ("c2", "a"), ("c2", "b"), ("c2", "b"), ("c0", "c"), (None, "c"), ("c0", "d"), ("c3", "d"), ("c4", "d"), (None, "e")],
    )
    clients = rows("client_code string, notes string", [("c1", "one"), ("c2", None), ("c3", "three"), ("c4", "four"), (None, "never")])
    assert bag(lowest_notes(pairs, clients)) == [("a", "one"), ("b", None), ("d", "three")]
