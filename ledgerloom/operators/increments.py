"""The merge of registers, kept up to date by increments: only codes that new rows touch are merged again.

What a code needs from its past rows is little: the first, the last one that empties its text, and those after it.  That is
a state which any two sets of rows merge into, in any order, so increments may come in any order too and end in what
`merge.precedence_merge` makes of all rows at once.  State and result are published tables in files by code.  An increment
reads and writes those files that hold its codes, and one manifest makes both visible, together with the increment's number:
the same increment again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.joins import missing_from
from ledgerloom.operators.merge import Register, combined, heads_of, hot_codes, merged_texts, tagged_rows
from ledgerloom.operators.skew import HOT_ROWS, join_key, lookup_join
from ledgerloom.session import Stored, store, write_once
from ledgerloom.sources.snapshots import Updated, files_with, open_snapshot, publish_snapshot, replace_parts

STATE, RESULT, DONE = "state", "merged", "increments"


def needed_rows(rows: DataFrame, heads: Stored, key: str, keep_notes: bool, hot_rows: int) -> DataFrame:
    """Rows that later merges can need: all from the last emptying one on, and the first."""
    if keep_notes:
        return rows
    bounds = {"_f": F.col("_first_ord"), "_e": F.col("_empty_ord")}
    bound = lookup_join(rows, heads, join_key(key), join_key(key), bounds, hot=hot_codes(heads, key, hot_rows))
    return bound.filter(F.col("_e").isNull() | (F.col("_ord") >= F.col("_e")) | (F.col("_ord") == F.col("_f"))).drop("_f", "_e")


def merge_increment(
    spark: SparkSession,
    path: str,
    registers: list[Register],
    key: str,
    columns: list[str],
    increment: int,
    note: str = "notes",
    keep_notes: bool = False,
    hot_rows: int = HOT_ROWS,
) -> Updated:
    """Add the rows of one increment to the registers merged at `path`, and publish the next version of the result.

    Every increment names all registers in the same order and with the same columns, empty where nothing is new, and keeps
    to one way of treating notes.  Rows without a code belong to no entry and are left out.
    """
    arrived = write_once(tagged_rows(registers, key, columns, note).filter(F.col(key).isNotNull()), "arrived")
    codes = store(arrived.select(key).distinct(), "codes")
    last = open_snapshot(spark, path)
    if last is None:
        result = arrived.select(key, *columns, note)
        empty = {STATE: arrived.schema, RESULT: result.schema, DONE: "increment long"}
        last = publish_snapshot(spark, {n: spark.createDataFrame([], s) for n, s in empty.items()}, path, {STATE: key, RESULT: key})
    if not last.read(DONE).filter(F.col("increment") == increment).isEmpty():
        return Updated(last, 0, 0, len(last.files_of(STATE)) + len(last.files_of(RESULT)))

    state, result = files_with(last, STATE, key, codes), files_with(last, RESULT, key, codes)
    marked = lookup_join(state.df, codes, join_key(key), join_key(key), {}, matched="_met", hot_rows=hot_rows)
    known, others = marked.filter("_met").drop("_met"), marked.filter("not _met").drop("_met")
    rows = write_once(combined(known.unionByName(arrived), key, columns, note), "rows")
    heads = store(heads_of(rows, key, columns, note), "heads")
    fresh = merged_texts(rows, heads, key, columns, note, keep_notes, hot_rows)
    parts = {
        STATE: (state, others.unionByName(needed_rows(rows, heads, key, keep_notes, hot_rows)).select(*arrived.columns)),
        RESULT: (result, missing_from(result.df, codes, {key: key}, hot=None).unionByName(fresh)),
    }
    done = spark.createDataFrame([(increment,)], "increment long").coalesce(1)
    return replace_parts(last, key, parts, {DONE: done}, {STATE: "_ord"})


def merged_so_far(spark: SparkSession, path: str) -> DataFrame:
    """The result of all increments: one row per code."""
    return open_snapshot(spark, path).read(RESULT)
