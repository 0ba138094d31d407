"""Cleaning of cells: one row per quirk of the source data."""

from pyspark.sql import functions as F

from ledgerloom.functions import dates, predicates, text
from ledgerloom.sources.tables import pick, scan_grid, scan_sheet


def column(rows, values, expression):
    df = rows("i int, c string", list(enumerate(values)))
    return [r[0] for r in df.select(expression.alias("x"), "i").orderBy("i").collect()]


def test_english_dates(rows):
    given = ["5th May 1785", "12 July 1779", "May 1785", "31 Feb 1785", "3 About 1785", None, "", "July 4, 1776", "29 February 1784", "1 May 0000"]
    df = dates.add_english_date(rows("i int, c string", list(enumerate(given))), "c", "d", "why").orderBy("i").collect()
    assert [r["d"] for r in df] == ["1785-05-05", "1779-07-12", None, None, None, None, None, "1776-07-04", "1784-02-29", None]
    assert [r["why"] for r in df] == [
        None, None, "no day", "not a calendar date", "unknown month", None, None, None, None, "not a calendar date"]


def test_partial_english_dates(rows):
    given = ["5th May 1785", "May 1785", "1785", "3 About 1785", "5 May", None]
    df = dates.add_english_date(rows("i int, c string", list(enumerate(given))), "c", "d", partial=True).orderBy("i")
    assert [r["d"] for r in df.collect()] == ["1785-05-05", "1785-05-00", "1785-00-00", None, None, None]


def test_a_date_column_may_replace_its_cell(rows):
    df = dates.add_english_date(rows("c string, other int", [("12 July 1779", 1)]), "c", "c")
    assert df.collect()[0].asDict() == {"c": "1779-07-12", "other": 1}


def test_year_and_fuzzy_dates(rows):
    assert column(rows, ["1770", "", None], dates.year_to_partial("c")) == ["1770-00-00", None, None]
    assert column(rows, ["No date AVAILABLE", "1770", None], text.null_after("c", dates.NO_DATE)) == [None, "1770", None]
    assert column(rows, ["??/05/1770", "12/ 05/1770"], dates.fuzzy_slashed("c")) == ["1770-05-00", "1770-05-12"]


def test_slashed_date_lists(rows):
    df = rows("i int, c string", [(1, "3/5/1785; 14/12/1786"), (2, "1/2/3/4"), (3, "5/1785")])
    each = df.select("i", F.posexplode(dates.slashed_dates("c")).alias("p", "item")).orderBy("i", "p")
    assert [r[0] for r in each.select(dates.slashed_to_iso("item")).collect()] == ["1785-5-3", "1786-12-14", None, None]


def test_partial_date_parts(rows):
    given = ["1770-00-00", "1770-05-00", "1772-02-29", "1771-02-30", None, "1785-5-3", "0000-00-00"]
    df = dates.add_partial_date(rows("i int, c string", list(enumerate(given))), "c", "d").orderBy("i").collect()
    got = [(r["d"]["precision"], str(r["d"]["first"]), str(r["d"]["last"])) for r in df]
    assert got == [
        ("year", "1770-01-01", "1770-12-31"), ("month", "1770-05-01", "1770-05-31"), ("day", "1772-02-29", "1772-02-29"),
        ("day", "None", "None"), (None, "None", "None"), ("day", "1785-05-03", "1785-05-03"), (None, "None", "None")]


def test_numbers(rows):
    given = ["21,914", "abc", "", "12 vols", " 7 ", None]
    assert column(rows, given, text.thousands_to_int("c")) == [21914, None, None, None, 7, None]
    assert column(rows, given, text.unreadable_number("c")) == [False, True, False, True, False, False]
    assert column(rows, ["t8", "", "x", "17"], text.map_values("c", {"t8": 8}, text.to_int(text.empty_to_null("c")))) == [8, None, None, 17]
    assert column(rows, ["2", "2 vols", None], text.keep_if_int("c")) == ["2", None, None]


def test_flags(rows):
    assert column(rows, ["yes", "y", "no", "nope", None, "?"], text.yes_no("c")) == ["yes", "yes", "no", "no", None, None]
    assert column(rows, ["yes", "y", "no", "nope", None], text.yes_no("c", lose_yes=True)) == [None, None, "no", "no", None]
    assert column(rows, ["yes", "no", "Yes", None], text.yes_no_flag("c")) == [True, False, None, None]
    reduced = text.gender_initial("c")
    assert column(rows, ["mixed", "male", "Female", "?", None], text.gender(reduced)) == ["B", "M", "F", "?", None]


def test_text(rows):
    assert column(rows, ["null", "NULL", "x", None], predicates.not_null_word("c")) == [False, False, True, None]
    assert column(rows, ["Null text", "x"], predicates.not_null_prefix("c")) == [False, True]
    assert column(rows, ["pl002, pl001", None], text.first_code("c")) == ["pl002", None]
    assert column(rows, ["id0012", "cl1234567"], text.widen("c", "id00")) == ["id000012", "id004567"]
    assert column(rows, ["a"], text.labelled_append(F.lit(None).cast("string"), " L: ", F.col("c"))) == [" L: a"]
    assert column(rows, [None], text.labelled_append(F.lit("x"), " L: ", F.col("c"))) == [None]
    assert column(rows, ["b", None], text.trimmed_append(F.lit(None).cast("string"), F.col("c"))) == ["b", None]
    assert column(rows, ["7", "123"], text.padded_code("k", F.col("c").cast("long"), 2)) == ["k07", None]
    kept = text.null_words(rows("a string, b string, n int", [("null", "Null", 1)])).collect()[0]
    assert tuple(kept) == (None, "Null", 1)


def test_lists(rows):
    assert column(rows, ["k1, k2 ,k3"], text.comma_items("c")) == [["k1", "k2", "k3"]]
    assert column(rows, ["a, b;  c;d"], text.mixed_items("c")) == [["a", "b", "c", "d"]]
    df = rows("i int, a string, b string", [(1, "A; B; C", "c1;c2"), (2, "null", "c"), (3, None, "c"), (4, "A", None)])
    got = text.explode_pairs(df, "a", "b", "name", "code", ["i"])
    assert sorted(map(tuple, got.collect())) == [(1, "A", "c1"), (1, "B", "c2")]


def test_agents_with_roles(rows):
    df = rows("i int, c string", [(1, "cl0335 (Adjoint), cl1468, cl1203 (Évêque)")])
    got = text.agents_with_roles(df, "c", ["i"], "code", "role").collect()
    assert [tuple(r) for r in got] == [(1, "cl0335", "Adjoint"), (1, "cl1468", None), (1, "cl1203", "Évêque")]


def test_flag_predicates(rows):
    df = rows("f boolean", [(True,), (False,), (None,)])
    assert df.filter(predicates.is_true("f")).count() == 1
    assert df.filter(predicates.is_not_true("f")).count() == 2


def test_grid_stops_at_first_blank_key(rows):
    sheet = rows("_row bigint, k string, v string, extra string", [(1, "head", "", ""), (2, "a", "1", ""), (3, "b", "2", ""), (4, None, "3", ""), (5, "c", "4", "")])
    assert [r["k"] for r in scan_grid(sheet, 2, None, 2, "k").collect()] == ["a", "b"]
    assert scan_grid(sheet, 2, None, 2, "k").columns == ["_row", "k", "v"]
    assert scan_grid(sheet, 2, 3, None, "k").count() == 2
    assert scan_grid(sheet, 2, 4).count() == 3
    assert pick(sheet, {1: "x", 0: "y"}, keep=["_row"]).columns == ["_row", "x", "y"]


def test_sheet_extracts_are_read_from_csv(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text('_row,k,v\n2,a,"line one\nline two"\n3,b,\n')
    got = scan_sheet(spark, str(path), "_row bigint, k string, v string").orderBy("_row").collect()
    assert [tuple(r) for r in got] == [(2, "a", "line one\nline two"), (3, "b", None)]


def test_names_are_equal_without_case_accents_and_trailing_spaces(rows):
    assert column(rows, ["Étienne  ", "ÉVÊQUE", "Łódź", " a", None], text.fold_name("c")) == ["etienne", "eveque", "łodz", " a", None]
    assert column(rows, ["Rétiré "], text.fold_name("c", trim=False)) == ["retire "]
